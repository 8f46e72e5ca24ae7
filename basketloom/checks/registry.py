"""One query per operator over the star tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.checks import file_queries, model_queries
from basketloom.checks.file_queries import requests
from basketloom.checks.stages import CATALOG_K, LABEL_DAYS, MIN_COOC, REPORT_K, Stages
from basketloom.functions.durable import shared_folder
from basketloom.functions.scaling import minmax_scale_to_range, value_range
from basketloom.operators import baskets as bk
from basketloom.operators import calendar as cal
from basketloom.operators import candidates as cd
from basketloom.operators import catalog as ct
from basketloom.operators import changes as ch
from basketloom.operators import cleaning as cl
from basketloom.operators import features as ft
from basketloom.operators import labels as lb
from basketloom.operators import lookup as lk
from basketloom.operators import metrics as mt
from basketloom.operators import novelty as nv
from basketloom.operators import personalization as pz
from basketloom.operators import repurchase as rp
from basketloom.operators import sketches as sk
from basketloom.operators import splits as sp
from basketloom.operators import training_set as ts
from basketloom.plans.training import TrainingParams, build_labeled_split
from basketloom.schema import QUERY_KEYS, ROW_KEYS
from basketloom.sources import files

EVAL_KS = [5, 10, 20, 50]
SCORE_RANGE = (-8.0, 4.0)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a few digits and small integers as int, for comparison between engines."""
    out = []
    for name, kind in df.dtypes:
        if kind == "double":
            out.append(F.round(name, digits).alias(name))
        elif kind in ("tinyint", "smallint"):
            out.append(F.col(name).cast("int").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and -1000000 for missing numbers, for comparison between engines."""
    return df.select(*[F.col(n).cast("string").alias(n) if kind == "date" else F.coalesce(n, F.lit(-1_000_000).cast(kind)).alias(n)
                       if kind in ("int", "bigint", "double") else F.col(n) for n, kind in df.dtypes])


def joined(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.array_join(name, ","))


def _row_split(s: Stages) -> DataFrame:
    split = sp.split_orders_by_rows(s.orders, train_ratio=0.8, val_ratio=0.1, test_ratio=0.1)
    return split.tagged()


def _with_gaps(s: Stages) -> DataFrame:
    """Cleaned lines with missing times, products and stores."""
    return s.clean.select(
        "order_id", F.when(F.col("quantity") != 11, F.col("kiosk_id")).alias("kiosk_id"),
        F.when(F.col("quantity") != 7, F.col("product_id")).alias("product_id"),
        F.when(~F.col("kiosk_id").endswith("3"), F.col("order_dt")).alias("order_dt"), "quantity")


def _some_untimed(s: Stages) -> DataFrame:
    """Order lines, those of store ids ending in 3 without a time."""
    return s.orders.withColumn("order_dt", F.when(~F.col("kiosk_id").endswith("3"), F.col("order_dt")))


def _feature_label(s: Stages) -> DataFrame:
    early, late = sp.split_feature_label(s.train, 0.3)
    return early.withColumn("part", F.lit("feature")).unionByName(late.withColumn("part", F.lit("label")))


def _kiosk_candidates(s: Stages) -> DataFrame:
    """Candidates per store: those the store itself bought before."""
    bought = s.train.select("kiosk_id", F.col("product_id").alias("candidate_product_id")).distinct()
    return s.topk.join(bought, "candidate_product_id")


def _fallback_answers(s: Stages) -> DataFrame:
    return lk.recommend_with_fallback(
        requests(s), lk.build_lookup(s.catalog), ct.anchor_fallback(s.topk, s.info, SCORE_RANGE, CATALOG_K),
        ct.category_fallback(s.orders, s.info, SCORE_RANGE, CATALOG_K),
        ct.global_fallback(s.orders, s.info, SCORE_RANGE, CATALOG_K), ct.product_info(s.all_products))


def _bucketed_answers(s: Stages) -> DataFrame:
    """Requests answered from a catalog table that is laid out by their key."""
    name = f"lookup_{uuid.uuid4().hex}"
    table = lk.write_lookup(lk.build_lookup(s.catalog), name, f"{shared_folder(s.spark)}/basketloom/{name}", 8)
    return lk.recommend_requests(lk.valid_limits(requests(s)), table).drop("recommendation_date")


def _labeled_part(s: Stages) -> DataFrame:
    """Labels first, features last, for the queries with positives of the test period."""
    return build_labeled_split(
        query_orders=s.test, label_orders=s.test, topk=s.topk,
        facts=ft.feature_facts(s.train, s.products, s.active[1], durable=True), params=TrainingParams(), keep_good=True, draw_negatives=True, durable=True)


def _incomplete(s: Stages) -> DataFrame:
    """Feature rows with gaps: no product list was given for the category feature."""
    return s.features.withColumn("channel", F.when(F.col("channel") != "BUILDING", F.col("channel")))


#: Zones of the regions of the given tables.
ZONES = {"AFRICA": "Africa/Lagos", "AMERICA": "America/New_York", "ASIA": "Asia/Tokyo", "EUROPE": "Europe/Berlin"}
SHARES = {"median_size": 0.5, "p95_size": 0.95, "p99_size": 0.99}


def _zones(s: Stages) -> DataFrame:
    """Stores with their zones; those of other regions aren't listed."""
    zone = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])[F.col("region")]
    return s.commerces.select(F.col("userid").alias("kiosk_id"), zone.alias("zone")).where("zone IS NOT NULL")


def _other_catalog(s: Stages) -> DataFrame:
    """A second run's catalog, scored without popularity."""
    return ct.predictions_catalog(s.scored.withColumn("score", F.round("cooc_cosine_sim", 9)), s.info, CATALOG_K)


def _profile_errors(s: Stages) -> DataFrame:
    """The sketched profile of each split beside the exact one: exact counts, and whether the estimates are within their error."""
    sketches = files.materialize(sk.day_sketches(s.orders, s.split.part))
    exact = s.orders.withColumn("split", s.split.part).groupBy("split").agg(
        F.count_distinct("kiosk_id").alias("k"), F.count_distinct("product_id").alias("p"))
    both = sk.sketched_profile(sketches, "split").join(exact, "split")

    def near(estimate: str, exactly: str):
        return F.abs(F.col(estimate) - F.col(exactly)) <= F.lit(sk.HLL_ERROR) * F.col(exactly)
    return both.select("split", "n_rows", "min_dt", "max_dt", F.col("k").alias("n_kiosks"), near("n_kiosks", "k").alias("kiosks_ok"),
                       F.col("p").alias("n_products"), near("n_products", "p").alias("products_ok"))


def _size_errors(s: Stages) -> DataFrame:
    """Per year: exact count and mean of basket sizes, and whether the rank of each sketched quantile is within twice its error."""
    years = s.orders.select("kiosk_id", "order_id", F.year("order_dt").alias("year")).distinct()
    sized = files.materialize(bk.build_baskets(s.orders, 1, None).join(years, ["kiosk_id", "order_id"]))
    found = sk.sketched_sizes(files.materialize(sk.size_sketches(sized, "year")), SHARES, "year")
    ranks = sized.select("year", F.size("products").alias("n")).join(found.select("year", *SHARES), "year").groupBy("year").agg(
        *[(F.avg((F.col("n") < F.col(q)).cast("int")) <= share + 2 * sk.KLL_ERROR).alias(f"{q}_low") for q, share in SHARES.items()],
        *[(F.avg((F.col("n") <= F.col(q)).cast("int")) >= share - 2 * sk.KLL_ERROR).alias(f"{q}_high") for q, share in SHARES.items()])
    return rounded(found.join(ranks, "year").select("year", "n_baskets", "mean_size", *[
        (F.col(f"{q}_low") & F.col(f"{q}_high")).alias(f"{q}_ok") for q in SHARES]))


NUMBERS = ["cand_is_new", "cooc_cosine_sim", "kiosk_product_cnt", "pop_global", "pop_store", "same_category"]
KINDS = ["channel", "region"]


def _with_category(s: Stages) -> DataFrame:
    """Judged rows with the candidate's category, where it is known."""
    kinds = s.info.select(F.col("product_id").alias("candidate_product_id"),
                          F.col("category").alias("candidate_category"))
    return s.judged.join(kinds, "candidate_product_id", "left")


BUILDERS: dict[str, Callable[[Stages], DataFrame]] = {
    # beside the operators: sketches, catalog changes, repurchase, calendars
    "orders_profile_sketched": lambda s: _profile_errors(s),
    "basket_sizes_sketched": lambda s: _size_errors(s),
    "catalog_changes": lambda s: plain(ch.catalog_changes(s.catalog, _other_catalog(s))),
    "catalog_change_summary": lambda s: ch.change_summary(ch.catalog_changes(s.catalog, _other_catalog(s))),
    "catalog_rows_in_one": lambda s: ch.rows_in_one(s.catalog.select(*ROW_KEYS), _other_catalog(s).select(*ROW_KEYS)),
    "repurchase_gaps": lambda s: plain(rp.repurchase_gaps(rp.purchase_days(s.orders))),
    "repurchase_summary": lambda s: plain(rounded(rp.repurchase_summary(rp.repurchase_gaps(rp.purchase_days(s.orders))))),
    "local_daily_totals": lambda s: plain(cal.local_daily_totals(s.orders, _zones(s))),
    "inference_window_local": lambda s: cal.inference_window_local(s.orders, _zones(s), 90),
    "split_by_local_day": lambda s: cal.split_by_local_day(s.orders, _zones(s), "1997-03-30", "1998-01-01"),
    # sources
    "first_orders": lambda s: files.first_orders(s.raw, 1000),
    "last_orders": lambda s: files.last_orders(s.raw, 1000),
    "read_orders_parquet": lambda s: files.read_orders_parquet(s.spark, f"{s.tables.directory}/orders.parquet"),
    "star_products": lambda s: s.tables.products(),
    "star_commerces": lambda s: s.tables.commerces(),
    # cleaning
    "preprocess_orders": lambda s: s.clean,
    "assert_not_null": lambda s: cl.null_counts(_with_gaps(s)),
    "null_ratios": lambda s: rounded(cl.null_ratios(
        _with_gaps(s).withColumn("quantity", F.when(F.col("quantity") < 25, F.col("quantity"))),
        ["order_dt", "quantity"])),
    "filter_active_kiosks": lambda s: s.active[0],
    "blocked_product_ids": lambda s: cl.blocked_product_ids(s.tables.all_products()),
    "filter_blocked_products": lambda s: s.kept_orders,
    "inference_window": lambda s: cl.inference_window(s.orders, 90),
    "orders_profile": lambda s: cl.orders_profile(s.orders, s.split.part),
    # splits
    "split_orders_by_time": lambda s: s.split.tagged(),
    "split_orders_by_rows": _row_split,
    "split_orders_by_rows_radix": lambda s: sp.split_orders_by_rows(
        _some_untimed(s), train_ratio=0.8, val_ratio=0.1, test_ratio=0.1, leaf_rows=50).tagged(),
    "split_feature_label": _feature_label,
    # baskets and candidates
    "build_baskets": lambda s: joined(s.lazy_baskets, "products"),
    "basket_size_stats": lambda s: rounded(bk.basket_size_stats(s.lazy_baskets)),
    "basket_filter_counts": lambda s: bk.basket_filter_counts(s.train, 2, 5),
    "explode_baskets": lambda s: s.items,
    "product_basket_counts": lambda s: bk.product_basket_counts(s.items),
    "frequent_products": lambda s: bk.frequent_products(s.items, 40),
    "pair_cooccurrence": lambda s: cd.pair_cooccurrence(s.baskets, MIN_COOC),
    "pair_cooccurrence_shared": lambda s: cd.pair_cooccurrence(files.materialize(s.baskets.withColumn(
        "order_id", F.floor(F.col("order_id").cast("bigint") / 10).cast("string"))), MIN_COOC),
    "generate_candidates": lambda s: rounded(s.candidates, 9),
    "select_top_k_candidates": lambda s: rounded(s.lazy_topk, 9),
    "topk_candidate_stats": lambda s: rounded(cd.topk_candidate_stats(s.lazy_topk, 30)),
    # queries and features
    "kiosk_anchor_queries": lambda s: s.queries,
    "add_query_id": lambda s: ft.add_query_id(s.queries),
    "sample_queries": lambda s: ft.sample_queries(s.queries, 500),
    "sample_kiosks": lambda s: ft.sample_kiosks(s.queries, 100),
    "build_feature_table": lambda s: rounded(s.rows, 9),
    "build_feature_table_by_kiosk": lambda s: rounded(
        ft.build_feature_table_by_kiosk(None, _kiosk_candidates(s), s.queries), 9),
    "feat_pop_store": lambda s: rounded(s.popular_rows, 9),
    "feat_pop_global": lambda s: ft.feat_pop_global(s.rows.drop("cooc_cosine_sim"), s.train),
    "feat_kiosk_product_cnt": lambda s: ft.feat_kiosk_product_cnt(s.rows.drop("cooc_cosine_sim"), s.train),
    "feat_cand_is_new": lambda s: rounded(ft.feat_cand_is_new(s.popular_rows.drop("cooc_cosine_sim"))),
    "feat_same_category": lambda s: rounded(ft.feat_same_category(s.rows.drop("cooc_cosine_sim"), s.products)),
    "feat_kiosk_meta": lambda s: ft.feat_kiosk_meta(s.rows.drop("cooc_cosine_sim"), s.active[1]),
    "add_all_features": lambda s: rounded(s.features, 9),
    "feature_rows": lambda s: rounded(ft.feature_rows(
        s.queries, s.topk, ft.feature_facts(s.train, s.products, s.active[1], durable=True)), 9),
    "fill_missing_features": lambda s: rounded(ft.fill_missing_features(_incomplete(s), NUMBERS, KINDS), 9),
    "ensure_feature_columns": lambda s: rounded(ft.ensure_feature_columns(
        s.popular_rows, ["cooc_cosine_sim", "pop_store", "pop_global", "channel"], KINDS), 9),
    "encode_features": lambda s: rounded(_incomplete(s).select(
        *ROW_KEYS, *ft.encode_features(NUMBERS + KINDS, KINDS)), 9),
    "zero_only_features": lambda s: ft.zero_only_features(
        s.features.withColumn("never", F.lit(0)), NUMBERS + ["never"]),
    # labels and training set
    "label_pairs_same_order": lambda s: lb.label_pairs_same_order(s.test),
    "label_pairs_window": lambda s: lb.label_pairs_window(s.test, window_days=LABEL_DAYS),
    "label_pairs_same_order_large": lambda s: lb.label_pairs_same_order(s.test, array_items=2),
    "label_pairs_window_busy": lambda s: lb.label_pairs_window(s.test, window_days=LABEL_DAYS, busy_bucket=1),
    "build_label_pairs": lambda s: lb.build_label_pairs(s.orders, window_days=30, min_cooc_label=2),
    "build_labels": lambda s: rounded(s.lazy_labeled, 9),
    "queries_with_positives": lambda s: lb.queries_with_positives(s.queries, s.pairs),
    "filter_good_queries": lambda s: rounded(ts.filter_good_queries(s.labeled), 9),
    "sample_negatives": lambda s: rounded(ts.sample_negatives(s.labeled, 20), 9),
    "shuffle_within_query": lambda s: ts.shuffle_within_query(s.rows.select(*ROW_KEYS)),
    "label_stats": lambda s: rounded(ts.label_stats(s.lazy_labeled)),
    "split_summary": lambda s: rounded(ts.split_summary(
        {"good": ts.filter_good_queries(s.labeled), "test": s.labeled})),
    "build_labeled_split": lambda s: rounded(_labeled_part(s), 9),
    "query_group_sizes": lambda s: ts.query_group_sizes(s.rows),
    "candidate_recall": lambda s: rounded(lb.candidate_recall(s.rows.select(*QUERY_KEYS).distinct(), s.rows, s.pairs)),
    # metrics
    "hitrate_at_k": lambda s: rounded(mt.hitrate_at_k(s.judged, 20)),
    "ndcg_at_k": lambda s: rounded(mt.ndcg_at_k(s.judged, 20)),
    "positives_at_k": lambda s: rounded(mt.positives_at_k(s.judged, 20)),
    "recall_at_k": lambda s: rounded(mt.recall_at_k(s.judged, 20)),
    "precision_at_k": lambda s: rounded(mt.precision_at_k(s.judged, 20)),
    "mrr_at_k": lambda s: rounded(mt.mrr_at_k(s.judged, 20)),
    "quantity_captured_at_k": lambda s: rounded(mt.quantity_captured_at_k(s.judged, s.test, 20)),
    "quantity_captured_per_order_at_k": lambda s: rounded(
        mt.quantity_captured_per_order_at_k(s.judged, s.test, 20)),
    "category_coverage_lift_at_k": lambda s: rounded(mt.category_coverage_lift_at_k(_with_category(s), 20)),
    "metrics_table": lambda s: rounded(mt.metrics_table(s.judged, EVAL_KS)),
    "eval_query_coverage": lambda s: rounded(mt.eval_query_coverage(s.judged)),
    # catalog
    "product_info": lambda s: s.info,
    "score_stats": lambda s: rounded(ct.score_stats(s.scored)),
    "predictions_catalog": lambda s: rounded(s.catalog, 9),
    "catalog_coverage": lambda s: rounded(ct.catalog_coverage(s.catalog, cl.active_kiosk_ids(s.commerces))),
    "anchor_fallback": lambda s: rounded(
        ct.anchor_fallback(s.topk, s.info, value_range(s.scored, "score"), CATALOG_K)),
    "category_fallback": lambda s: rounded(ct.category_fallback(s.orders, s.info, SCORE_RANGE, CATALOG_K)),
    "global_fallback": lambda s: rounded(ct.global_fallback(s.orders, s.info, SCORE_RANGE, CATALOG_K)),
    "minmax_scale_to_range": lambda s: rounded(minmax_scale_to_range(s.topk, "cooc_cosine_sim", SCORE_RANGE)),
    # lookups
    "build_lookup": lambda s: joined(lk.build_lookup(s.catalog), "recs"),
    "recommend_requests": lambda s: lk.recommend_requests(
        lk.valid_limits(requests(s)), lk.build_lookup(s.catalog)).drop("recommendation_date"),
    "recommend_requests_bucketed": lambda s: _bucketed_answers(s),
    "recommend_multi": lambda s: joined(
        lk.recommend_multi(requests(s), lk.build_lookup(s.catalog)).drop("recommendation_date"), "recs"),
    "recommend_with_fallback": _fallback_answers,
    # reports
    "top_k_per_query": lambda s: rounded(pz.top_k_per_query(s.scored.select(*ROW_KEYS, "score"), REPORT_K), 9),
    "personalization_totals": lambda s: pz.personalization_totals(s.top),
    "kiosk_rec_sets": lambda s: pz.kiosk_rec_sets(s.top),
    "anchor_list_diversity": lambda s: rounded(
        pz.anchor_list_diversity(s.top, REPORT_K)),
    "anchor_diversity_summary": lambda s: rounded(pz.anchor_diversity_summary(
        pz.anchor_list_diversity(s.top, REPORT_K))),
    "global_baseline_topk": lambda s: pz.global_baseline_topk(s.top, REPORT_K),
    "baseline_overlap": lambda s: rounded(
        pz.baseline_overlap(s.top, REPORT_K)),
    "pairwise_jaccard": lambda s: rounded(pz.pairwise_jaccard(s.top, REPORT_K)),
    "sampled_jaccard": lambda s: rounded(pz.sampled_jaccard(s.top, REPORT_K)),
    "example_recs": lambda s: pz.example_recs(s.top, s.products, REPORT_K),
    "new_vs_repeat_totals": lambda s: rounded(nv.new_vs_repeat_totals(s.scored, REPORT_K)),
    "new_share_by_position": lambda s: rounded(nv.new_share_by_position(s.scored, REPORT_K)),
    "new_vs_repeat_pool": lambda s: rounded(nv.new_vs_repeat_pool(s.scored)),
    "avg_pop_store": lambda s: rounded(nv.avg_pop_store(s.scored, REPORT_K)),
    "mixed_queries": lambda s: nv.mixed_queries(s.scored, REPORT_K),
    "mixed_query_examples": lambda s: nv.mixed_query_examples(s.scored, s.products, REPORT_K),
    **{name: (lambda s, build=build: rounded(build(s), 9)) if name == "running_candidates" else build
       for name, build in file_queries.BUILDERS.items()},
    **model_queries.BUILDERS,
}


def _runner(build: Callable[[Stages], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, directory: build(Stages(spark, directory))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, build in BUILDERS.items()}
