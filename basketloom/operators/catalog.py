"""Recommendation catalog and its fallback tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.functions.ranking import top_rows
from basketloom.functions.scaling import minmax_scale_to_range
from basketloom.schema import QUERY_KEYS, ROW_KEYS

__all__ = ["product_info", "score_stats", "predictions_catalog", "catalog_coverage", "anchor_fallback",
           "category_fallback", "global_fallback", "minmax_scale_to_range"]


def product_info(products: DataFrame) -> DataFrame:
    """One (product_id, product_name, category) row per product id."""
    fields = F.struct(F.col("name").cast("string").alias("product_name"),
                      F.col("category").cast("string").alias("category"))
    one = products.groupBy(F.col("productid").cast("string").alias("product_id")).agg(F.min(fields).alias("f"))
    return one.select("product_id", "f.product_name", "f.category")


def _name_candidates(df: DataFrame, info: DataFrame, category: bool = True) -> DataFrame:
    names = info.select(F.col("product_id").alias("candidate_product_id"),
                        F.col("product_name").alias("candidate_name"), *(["category"] if category else []))
    return df.join(names, "candidate_product_id", "left")


def _name_anchors(df: DataFrame, info: DataFrame) -> DataFrame:
    names = info.select(F.col("product_id").alias("anchor_product_id"), F.col("product_name").alias("anchor_name"))
    return df.join(names, "anchor_product_id", "left")


def score_stats(scored: DataFrame) -> DataFrame:
    return scored.agg(F.min("score").alias("min_score"), F.max("score").alias("max_score"),
                      F.avg("score").alias("mean_score"))


def predictions_catalog(scored: DataFrame, info: DataFrame, top_k: int = 30) -> DataFrame:
    """Top rows per (store, anchor) by score, with product names. Names are joined after the cut."""
    rows = scored.select(*ROW_KEYS, "score")
    top = top_rows(rows, QUERY_KEYS, [F.desc("score"), F.asc("candidate_product_id")], top_k)
    named = _name_anchors(_name_candidates(top, info), info)
    return named.select("kiosk_id", "anchor_product_id", "anchor_name", "candidate_product_id",
                        "candidate_name", "category", "score")


def catalog_coverage(rows: DataFrame, active_kiosks: DataFrame | None = None, top_k: int | None = None) -> DataFrame:
    """One row: catalog rows, queries, stores, active stores and the share covered in percent.

    ``rows`` is the catalog, or the scored rows it is cut from with the ``top_k`` of the cut.
    """
    size = F.count("*") if top_k is None else F.least(F.count("*"), F.lit(top_k))
    counts = rows.groupBy(*QUERY_KEYS).agg(size.alias("n")).groupBy("kiosk_id").agg(
        F.sum("n").alias("n"), F.count("*").alias("q")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("q"), F.lit(0)).alias("n_queries"), F.count("*").alias("n_kiosks"))
    if active_kiosks is None:
        total = F.col("n_kiosks")
    else:
        known = active_kiosks.agg(F.count_distinct("kiosk_id").alias("n")).scalar()
        total = F.when(known > 0, known).otherwise(F.col("n_kiosks"))
    return counts.withColumn("n_active", total).withColumn(
        "coverage_pct", F.coalesce(F.try_divide(100.0 * F.col("n_kiosks"), "n_active"), F.lit(0.0)))


def anchor_fallback(topk: DataFrame, info: DataFrame, score_range: tuple, top_k: int = 30) -> DataFrame:
    """Per anchor the candidates of highest cosine, for stores without predictions."""
    top = top_rows(topk, ["anchor_product_id"], [F.desc("cooc_cosine_sim"), F.asc("candidate_product_id")], top_k)
    scaled = minmax_scale_to_range(top, "cooc_cosine_sim", score_range)
    named = _name_anchors(_name_candidates(scaled, info), info)
    return named.select("anchor_product_id", "anchor_name", "candidate_product_id", "candidate_name",
                        "category", "score")


def _sales(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_id").agg(F.count("*").alias("purchase_count"))


def category_fallback(orders: DataFrame, info: DataFrame, score_range: tuple, top_k: int = 30) -> DataFrame:
    """Per category the most bought products. Lines are counted per product before the join."""
    sold = _sales(orders).join(info, "product_id").filter(F.col("category").isNotNull())
    top = top_rows(sold, ["category"], [F.desc("purchase_count"), F.asc("product_id")], top_k)
    scaled = minmax_scale_to_range(top.withColumn("_pop", F.log1p("purchase_count")), "_pop", score_range)
    return scaled.select("category", F.col("product_id").alias("candidate_product_id"),
                         F.col("product_name").alias("candidate_name"), "score")


def global_fallback(orders: DataFrame, info: DataFrame, score_range: tuple, top_k: int = 30) -> DataFrame:
    """The most bought products overall."""
    top = _sales(orders).orderBy(F.desc("purchase_count"), F.asc("product_id")).limit(top_k)
    scaled = minmax_scale_to_range(top.withColumn("_pop", F.log1p("purchase_count")), "_pop", score_range)
    named = _name_candidates(scaled.withColumnRenamed("product_id", "candidate_product_id"), info)
    return named.select("candidate_product_id", "candidate_name", "category", "score")
