"""Answering recommendation requests by joins; requests may be a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.schema import ROW_KEYS, require_columns

DEFAULT_LIMIT = 20
LOOKUP_KEYS = ["anchor_id", "kiosk_id"]


def _ranked_list() -> Column:
    """Product ids of a group by falling score, then id."""
    pairs = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("product_id").alias("p"))))
    return F.transform(pairs, lambda pair: pair["p"])


def build_lookup(predictions: DataFrame) -> DataFrame:
    """(anchor_id, kiosk_id) to its product list by falling score.

    A catalog holds at most its top-k rows per key, so the lists are short.
    """
    require_columns(predictions, [*ROW_KEYS, "score"])
    rows = predictions.select(
        F.col("anchor_product_id").cast("string").alias("anchor_id"), F.col("kiosk_id").cast("string"),
        F.col("candidate_product_id").cast("string").alias("product_id"), F.col("score").cast("double"))
    return rows.groupBy(*LOOKUP_KEYS).agg(_ranked_list().alias("recs"))


def write_lookup(lookup: DataFrame, table: str, path: str, buckets: int = 200) -> DataFrame:
    """The lookup as a table laid out by its key: requests of many rows join it without moving it.

    ``buckets``: about the catalog's size over 200 MB. Buckets hold their rows in key order.
    """
    (lookup.repartition(buckets, *LOOKUP_KEYS).write.mode("overwrite").option("path", path).bucketBy(buckets, *LOOKUP_KEYS)
     .sortBy(*LOOKUP_KEYS).saveAsTable(table))
    return lookup.sparkSession.table(table)


def _limit(requests: DataFrame) -> Column:
    wanted = F.coalesce(F.col("limit"), F.lit(DEFAULT_LIMIT)) if "limit" in requests.columns else F.lit(DEFAULT_LIMIT)
    return F.greatest(wanted, F.lit(0)).cast("int")


def _stamped(df: DataFrame, model_id: str) -> DataFrame:
    return df.select(*df.columns, F.lit(model_id).alias("model_id"),
                     F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                                   "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("recommendation_date"))


def valid_limits(requests: DataFrame, low: int = 1, high: int = 100) -> DataFrame:
    """Requests whose ``limit`` lies in the range the request interface accepts."""
    return requests.filter(F.col("limit").between(low, high))


def recommend_requests(requests: DataFrame, lookup: DataFrame, model_id: str = "ranker") -> DataFrame:
    """One row per recommended product, in list order; unknown keys give none."""
    joined = requests.withColumn("_limit", _limit(requests)).join(lookup, LOOKUP_KEYS)
    items = joined.select(*LOOKUP_KEYS, F.posexplode(F.slice("recs", F.lit(1), F.col("_limit"))).alias("at", "product_id"))
    return _stamped(items.select(*LOOKUP_KEYS, "product_id", (F.col("at") + 1).alias("position")), model_id)


def recommend_multi(requests: DataFrame, lookup: DataFrame, model_id: str = "ranker") -> DataFrame:
    """One row per request with its whole list; unknown keys give an empty one."""
    joined = requests.select(*LOOKUP_KEYS).join(lookup, LOOKUP_KEYS, "left")
    none = F.array().cast("array<string>")
    return _stamped(joined.select(*LOOKUP_KEYS, F.coalesce("recs", none).alias("recs")), model_id)


def recommend_with_fallback(requests: DataFrame, lookup: DataFrame, anchors: DataFrame, categories: DataFrame,
                            overall: DataFrame, info: DataFrame) -> DataFrame:
    """Four levels: store and anchor, anchor, the anchor's category, best sellers.

    The first level that knows the request answers it; ``level`` says which.
    Every fallback list holds at most the catalog's top-k products.
    """
    def lists(df: DataFrame, key: str, out_key: str, out: str) -> DataFrame:
        rows = df.select(F.col(key).alias(out_key), F.col("candidate_product_id").alias("product_id"), "score")
        return rows.groupBy(out_key).agg(_ranked_list().alias(out))

    asked = requests.withColumn("_limit", _limit(requests)).select(*LOOKUP_KEYS, "_limit")
    first = asked.join(lookup, LOOKUP_KEYS).select(*LOOKUP_KEYS, "_limit", F.lit(1).alias("level"), "recs")
    # Only what the first level doesn't know meets the other lists, the category's by its own id.
    rest = asked.join(lookup, LOOKUP_KEYS, "left_anti")
    by_anchor = lists(anchors, "anchor_product_id", "anchor_id", "recs2")
    kinds = info.filter(F.col("category").isNotNull()).select(F.col("product_id").alias("anchor_id"), "category")
    by_category = lists(categories, "category", "category", "recs3")
    best = overall.select(F.col("candidate_product_id").alias("product_id"), "score").agg(
        _ranked_list().alias("recs4")).scalar()
    rest = rest.join(by_anchor, "anchor_id", "left").join(kinds, "anchor_id", "left").join(by_category, "category", "left")
    level = F.when(F.col("recs2").isNotNull(), 2).when(F.col("recs3").isNotNull(), 3).otherwise(4)
    joined = first.unionByName(rest.select(*LOOKUP_KEYS, "_limit", level.alias("level"), F.coalesce("recs2", "recs3", best).alias("recs")))
    items = joined.select(*LOOKUP_KEYS, "level", F.posexplode(F.slice("recs", F.lit(1), F.col("_limit"))).alias("at", "product_id"))
    return items.select(*LOOKUP_KEYS, "level", (F.col("at") + 1).alias("position"), "product_id")
