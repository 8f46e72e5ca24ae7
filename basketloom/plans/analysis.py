"""Analysis plan: score stores of the test period and report on the lists, from tables or from files."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from basketloom.functions.durable import materialize, scratch
from basketloom.operators import novelty as nv
from basketloom.operators import personalization as pz
from basketloom.operators.baskets import build_baskets, kiosk_anchor_queries
from basketloom.operators.candidates import generate_candidates, select_top_k_candidates
from basketloom.operators.cleaning import blocked_product_ids, filter_active_kiosks, filter_blocked_products
from basketloom.operators.features import feature_facts, feature_rows, sample_kiosks
from basketloom.operators.ranker import Ranker, predict_scores
from basketloom.operators.splits import split_orders_by_time
from basketloom.plans.training import clean_order_files
from basketloom.schema import ROW_KEYS
from basketloom.sources.files import read_commerces, read_products, write_parquet


def score_test_period(orders: DataFrame, products: DataFrame, commerces: DataFrame, ranker: Ranker, *,
                      n_kiosks: int = 0, train_ratio: float = 0.6, val_ratio: float = 0.2,
                      test_ratio: float = 0.2, min_cooc: int = 2, min_lift: float = 1.2,
                      top_k: int = 100) -> DataFrame:
    """Scored rows of the test queries, with popularity and novelty (written once).

    All stores by default; ``n_kiosks`` above 0 draws so many.
    """
    orders, commerces = filter_active_kiosks(orders, commerces)
    split = split_orders_by_time(materialize(orders), train_ratio=train_ratio, val_ratio=val_ratio,
                                 test_ratio=test_ratio)
    # Neither candidates nor facts need the other, so the last tasks of one leave cores to the other.
    with ThreadPoolExecutor(1) as pool:
        known = pool.submit(feature_facts, split.train, products, commerces, durable=True)
        candidates = generate_candidates(materialize(build_baskets(split.train)), min_cooc)
        topk = materialize(select_top_k_candidates(candidates, top_k, min_lift))
        facts = known.result()
    queries = kiosk_anchor_queries(build_baskets(split.test))
    if n_kiosks > 0:
        queries = sample_kiosks(materialize(queries), n_kiosks)
    rows = feature_rows(queries, topk, facts)
    return materialize(predict_scores(rows, ranker).select(*ROW_KEYS, "cand_is_new", "pop_store", "score"))


def personalization_report(scored: DataFrame, products: DataFrame | None = None, k: int = 5) -> dict[str, DataFrame]:
    top = materialize(pz.top_k_per_query(scored.select(*ROW_KEYS, "score"), k))
    diversity = materialize(pz.anchor_list_diversity(top, k))
    return {"totals": pz.personalization_totals(top), "kiosk_products": pz.kiosk_rec_sets(top),
            "top_anchors": pz.top_anchors(diversity), "diversity": pz.anchor_diversity_summary(diversity),
            "baseline_overlap": pz.baseline_overlap(top, k), "jaccard": pz.pairwise_jaccard(top, k),
            "examples": pz.example_recs(top, products, k)}


def novelty_report(scored: DataFrame, products: DataFrame, k: int = 5) -> dict[str, DataFrame]:
    return {"totals": nv.new_vs_repeat_totals(scored, k), "by_position": nv.new_share_by_position(scored, k),
            "pool": nv.new_vs_repeat_pool(scored), "popularity": nv.avg_pop_store(scored, k),
            "mixed": nv.mixed_queries(scored, k), "examples": nv.mixed_query_examples(scored, products, k)}


@dataclass(frozen=True)
class ReportParams:
    """The defaults of the report runs, which keep order lines of blocked products."""

    k: int = 5
    n_kiosks: int = 0
    train_ratio: float = 0.6
    val_ratio: float = 0.2
    test_ratio: float = 0.2
    min_cooc: int = 2
    min_lift: float = 1.2
    top_k: int = 100
    drop_blocked: bool = False


#: Tables of a report written side by side: they are short, and the planning and last tasks of one leave cores to another.
WRITERS = 4

REPORTS = {"personalization": personalization_report, "novelty": novelty_report}


def reports_from_files(spark: SparkSession, *, raw_paths: list[str], interim_path: str, products_path: str,
                       commerces_path: str, model_path: str, out_folder: str, n_rows: int = 0,
                       sample_position: str = "head", reports: Sequence[str] = tuple(REPORTS),
                       params: ReportParams = ReportParams()) -> dict[str, DataFrame]:
    """From order, product and store files and a saved model to the report tables ``<out_folder>/<report>/<table>``.

    All rows and all stores by default; ``n_rows`` and ``n_kiosks`` above 0 ask for a sample. The stores are scored
    once for all reports. Returns the written tables by ``<report>/<table>``.
    """
    if unknown := set(reports) - set(REPORTS):
        raise ValueError(f"no such report: {', '.join(sorted(unknown))}")
    written = []
    with scratch(spark):
        orders = clean_order_files(spark, raw_paths, interim_path, n_rows, sample_position)
        if params.drop_blocked:
            catalog = read_products(spark, products_path, filter_blocked=False)
            orders = filter_blocked_products(orders, blocked_product_ids(catalog))
        products = read_products(spark, products_path)
        scored = score_test_period(
            orders, products, read_commerces(spark, commerces_path), Ranker.load(spark, model_path),
            n_kiosks=params.n_kiosks, train_ratio=params.train_ratio, val_ratio=params.val_ratio,
            test_ratio=params.test_ratio, min_cooc=params.min_cooc, min_lift=params.min_lift, top_k=params.top_k)
        for report in reports:
            tables = {f"{report}/{name}": table for name, table in REPORTS[report](scored, products, params.k).items()}
            with ThreadPoolExecutor(WRITERS) as pool:
                list(pool.map(lambda item: write_parquet(item[1], f"{out_folder}/{item[0]}"), tables.items()))
            written += tables
    return {name: spark.read.parquet(f"{out_folder}/{name}") for name in written}
