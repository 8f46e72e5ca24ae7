"""The (store, anchor, candidate) table and its model features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketloom.functions.durable import materialize
from basketloom.functions.hashing import category_code, draw_key, hex_digits
from basketloom.functions.ranking import cut_rows
from basketloom.operators.baskets import kiosk_anchor_queries
from basketloom.schema import MISSING_CATEGORY, QUERY_KEYS, ROW_KEYS, require_columns

CATEGORICAL_FEATURES = ["channel", "region"]


# ---- queries ---------------------------------------------------------------

def add_query_id(df: DataFrame) -> DataFrame:
    kiosk, anchor = (F.col(name).cast("string") for name in QUERY_KEYS)
    return df.withColumn("query_id", F.concat(kiosk, F.lit("::"), anchor))


def _sample_by_hash(df: DataFrame, keys: list[str], n: int, seed: int, leaf_rows: int) -> DataFrame:
    key = draw_key(seed, *keys)
    ties = [key] + [F.col(name) for name in keys]
    return cut_rows(df, hex_digits(key), ties, [0, n], df.count(), leaf_rows=leaf_rows)[0]


def sample_queries(queries: DataFrame, n: int, seed: int = 42, *, leaf_rows: int = 100_000) -> DataFrame:
    """``n`` queries in the order of a seeded hash; all of them where fewer exist."""
    return _sample_by_hash(queries, QUERY_KEYS, n, seed, leaf_rows)


def sample_kiosks(queries: DataFrame, n: int, seed: int = 42, *, leaf_rows: int = 100_000) -> DataFrame:
    """The queries of ``n`` sampled stores; ``n <= 0`` keeps all."""
    if n <= 0:
        return queries
    kiosks = _sample_by_hash(queries.select("kiosk_id").distinct(), ["kiosk_id"], n, seed, leaf_rows)
    return queries.join(kiosks, "kiosk_id", "left_semi").select(*queries.columns)


def build_feature_table(baskets: DataFrame | None, topk_candidates: DataFrame,
                        queries: DataFrame | None = None) -> DataFrame:
    """Queries (given, or those of the baskets) joined to the candidates of their anchor.

    Candidates that carry ``kiosk_id`` are joined on store and anchor.
    """
    require_columns(topk_candidates, ["anchor_product_id", "candidate_product_id"])
    if queries is None:
        require_columns(baskets, ["kiosk_id", "products"])
        wanted = kiosk_anchor_queries(baskets)
    else:
        require_columns(queries, QUERY_KEYS)
        wanted = queries.select(*QUERY_KEYS).distinct()
    on = [name for name in QUERY_KEYS if name in topk_candidates.columns]
    rest = [name for name in topk_candidates.columns if name not in QUERY_KEYS]
    return wanted.join(topk_candidates, on).select(*QUERY_KEYS, *rest)


build_feature_table_by_kiosk = build_feature_table


# ---- features --------------------------------------------------------------

def store_popularity(orders: DataFrame) -> DataFrame:
    """Order lines per (store, product); the other popularity counts are sums of these."""
    return orders.groupBy("kiosk_id", "product_id").agg(F.count("*").alias("pop_store"))


def _global_popularity(per_store: DataFrame) -> DataFrame:
    return per_store.groupBy("product_id").agg(F.sum("pop_store").alias("pop_global"))


def _kiosk_volume(per_store: DataFrame) -> DataFrame:
    return per_store.groupBy("kiosk_id").agg(F.sum("pop_store").alias("kiosk_product_cnt"))


def _zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)


def _add_counts(df: DataFrame, counts: DataFrame, name: str, on: list[str]) -> DataFrame:
    return df.join(counts, on, "left").select(*df.columns, _zero_if_null(name))


def feat_pop_store(df: DataFrame, orders: DataFrame) -> DataFrame:
    counts = store_popularity(orders).withColumnRenamed("product_id", "candidate_product_id")
    return _add_counts(df, counts, "pop_store", ["kiosk_id", "candidate_product_id"])


def feat_pop_global(df: DataFrame, orders: DataFrame) -> DataFrame:
    counts = _global_popularity(store_popularity(orders)).withColumnRenamed("product_id", "candidate_product_id")
    return _add_counts(df, counts, "pop_global", ["candidate_product_id"])


def feat_kiosk_product_cnt(df: DataFrame, orders: DataFrame) -> DataFrame:
    return _add_counts(df, _kiosk_volume(store_popularity(orders)), "kiosk_product_cnt", ["kiosk_id"])


def feat_cand_is_new(df: DataFrame) -> DataFrame:
    return df.withColumn("cand_is_new", (F.col("pop_store") == 0).cast("tinyint"))


def product_categories(products: DataFrame) -> DataFrame:
    """One row per product id; of several categories the smallest."""
    return (products.groupBy(F.col("productid").cast("string").alias("product_id"))
            .agg(F.min("category").alias("category")))


def has_categories(products: DataFrame | None) -> bool:
    return products is not None and {"productid", "category"} <= set(products.columns)


def feat_same_category(df: DataFrame, products: DataFrame) -> DataFrame:
    """1 if anchor and candidate share a category, NULL where either is unknown."""
    if not has_categories(products):
        return df
    known = product_categories(products)
    anchors = known.select(F.col("product_id").alias("anchor_product_id"), F.col("category").alias("_anchor_cat"))
    others = known.select(F.col("product_id").alias("candidate_product_id"), F.col("category").alias("_cand_cat"))
    same = (F.col("_anchor_cat") == F.col("_cand_cat")).cast("tinyint").alias("same_category")
    return (df.join(anchors, "anchor_product_id", "left").join(others, "candidate_product_id", "left")
            .select(*df.columns, same))


def kiosk_metadata(commerces: DataFrame) -> DataFrame:
    return commerces.select(F.col("userid").cast("string").alias("kiosk_id"), *CATEGORICAL_FEATURES)


def feat_kiosk_meta(df: DataFrame, commerces: DataFrame) -> DataFrame:
    """Channel and region; a store listed twice doubles its rows."""
    if "userid" not in commerces.columns:
        return df
    return df.join(kiosk_metadata(commerces), "kiosk_id", "left").select(*df.columns, *CATEGORICAL_FEATURES)


@dataclass(frozen=True)
class FeatureFacts:
    """What is known per (store, product), per product and per store; built once, joined often."""

    per_store: DataFrame
    per_candidate: DataFrame
    per_anchor: DataFrame | None
    per_kiosk: DataFrame
    extra: tuple[str, ...]


def feature_facts(orders: DataFrame, products: DataFrame | None = None, commerces: DataFrame | None = None,
                  durable: bool = False) -> FeatureFacts:
    """Merge the facts of each key before they meet the feature table, the largest table here.

    ``durable`` writes them: the popularity counts are then aggregated once,
    and the planner knows the true sizes. It broadcasts the product and store
    facts while they are small and falls back to a shuffle join beyond that.
    """
    keep = materialize if durable else (lambda df: df)
    per_store = keep(store_popularity(orders))
    by_product, by_kiosk, anchors = _global_popularity(per_store), _kiosk_volume(per_store), None
    extra: list[str] = []
    if has_categories(products):
        known = product_categories(products)
        anchors = known.select(F.col("product_id").alias("anchor_product_id"), F.col("category").alias("_anchor_cat"))
        by_product = by_product.join(known.withColumnRenamed("category", "_cand_cat"), "product_id", "full")
        extra.append("same_category")
    if commerces is not None and "userid" in commerces.columns:
        by_kiosk = by_kiosk.join(kiosk_metadata(commerces), "kiosk_id", "full")
        extra += CATEGORICAL_FEATURES
    return FeatureFacts(
        per_store.withColumnRenamed("product_id", "candidate_product_id"),
        keep(by_product).withColumnRenamed("product_id", "candidate_product_id"), anchors, keep(by_kiosk), tuple(extra))


def attach_features(df: DataFrame, facts: FeatureFacts) -> DataFrame:
    """All features, with one join per key."""
    columns = list(df.columns)
    df = df.join(facts.per_candidate, "candidate_product_id", "left")
    if facts.per_anchor is not None:
        df = df.join(facts.per_anchor, "anchor_product_id", "left")
        df = df.withColumn("same_category", (F.col("_anchor_cat") == F.col("_cand_cat")).cast("tinyint"))
    df = df.join(facts.per_kiosk, "kiosk_id", "left")
    return _finished(df.join(facts.per_store, ["kiosk_id", "candidate_product_id"], "left"), columns, facts)


def _finished(df: DataFrame, columns: list[str], facts: FeatureFacts) -> DataFrame:
    counts = [_zero_if_null(name) for name in ("pop_store", "pop_global", "kiosk_product_cnt")]
    is_new = F.coalesce(F.col("pop_store") == 0, F.lit(True)).cast("tinyint").alias("cand_is_new")
    return df.select(*columns, *counts, is_new, *facts.extra)


def feature_rows(queries: DataFrame, topk: DataFrame, facts: FeatureFacts) -> DataFrame:
    """Candidates of every query with all features, as from ``attach_features(build_feature_table(...))``.

    Store facts join the queries and product facts the candidate pairs, one row each, before queries and candidates
    meet; only the count per store and product has to join the many rows that come of it.
    """
    wanted = queries.select(*QUERY_KEYS).distinct().join(facts.per_kiosk, "kiosk_id", "left")
    offered = topk.join(facts.per_candidate, "candidate_product_id", "left")
    if facts.per_anchor is not None:
        offered = offered.join(facts.per_anchor, "anchor_product_id", "left").withColumn(
            "same_category", (F.col("_anchor_cat") == F.col("_cand_cat")).cast("tinyint"))
    on = [name for name in QUERY_KEYS if name in topk.columns]
    rows = wanted.join(offered, on).join(facts.per_store, ["kiosk_id", "candidate_product_id"], "left")
    return _finished(rows, [*QUERY_KEYS, *[name for name in topk.columns if name not in QUERY_KEYS]], facts)


def add_all_features(df: DataFrame, *, orders: DataFrame, products: DataFrame | None = None,
                     commerces: DataFrame | None = None, durable: bool = False) -> DataFrame:
    return attach_features(df, feature_facts(orders, products, commerces, durable))


# ---- feature columns of a model ---------------------------------------------

def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric, categorical) features of a labelled table, from its schema."""
    taken = {*ROW_KEYS, "label"}
    numbers = [f.name for f in df.schema.fields
               if f.name not in taken and isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    kinds = [name for name in CATEGORICAL_FEATURES if name in df.columns]
    return sorted(numbers), sorted(kinds)


def fill_missing_features(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    filled = {}
    for name in numeric:
        if name in types:
            zero = F.lit(False) if types[name] == "boolean" else F.lit(0)
            filled[name] = F.coalesce(F.col(name), zero.cast(types[name]))
    for name in categorical:
        if name in types:
            filled[name] = F.coalesce(F.col(name).cast("string"), F.lit(MISSING_CATEGORY))
    return df.withColumns(filled) if filled else df


def ensure_feature_columns(df: DataFrame, features: list[str], categorical: list[str]) -> DataFrame:
    absent = {name: F.lit(MISSING_CATEGORY if name in categorical else 0)
              for name in features if name not in df.columns}
    return df.withColumns(absent) if absent else df


def encode_features(features: list[str], categorical: list[str]) -> list[Column]:
    """Model inputs as doubles: hashed categories, numbers with NULL as 0."""
    def encoded(name: str) -> Column:
        if name in categorical:
            return category_code(F.coalesce(F.col(name).cast("string"), F.lit(MISSING_CATEGORY)))
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return [encoded(name).alias(name) for name in features]


def zero_only_features(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Names of the numeric features that are 0 or NULL in every row."""
    present = [name for name in numeric if name in df.columns]
    peaks = df.agg(*[F.max(F.abs(F.col(name).cast("double"))).alias(name) for name in present])
    long = peaks.unpivot([], present, "feature", "max_abs")
    return long.filter(F.col("max_abs").isNull() | (F.col("max_abs") == 0)).select("feature")
