"""Order profiles and basket sizes from mergeable sketches per part and day.

A day's sketches are written once and merge into any longer range: distinct stores and products by HyperLogLog, basket
sizes by KLL. Line counts and time ranges stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base-2 logarithm of the HLL buckets, and the relative error that an estimate stays within (three standard deviations).
HLL_BITS, HLL_ERROR = 12, 0.05
#: Size of the KLL sketch, and the rank error that a quantile stays within in 99 of 100 cases.
KLL_K, KLL_ERROR = 400, 0.0068


def day_sketches(orders: DataFrame, part: Column) -> DataFrame:
    """(split, day, n_rows, kiosks, products, min_dt, max_dt), one row per part and day; lines without a time have a null day."""
    lines = orders.withColumn("split", part).withColumn("day", F.col("order_dt").cast("date"))
    return lines.groupBy("split", "day").agg(
        F.count("*").alias("n_rows"), F.hll_sketch_agg("kiosk_id", HLL_BITS).alias("kiosks"),
        F.hll_sketch_agg("product_id", HLL_BITS).alias("products"), F.min("order_dt").alias("min_dt"), F.max("order_dt").alias("max_dt"))


def sketched_profile(sketches: DataFrame, *by: str) -> DataFrame:
    """Lines, estimated stores and products, and time range of all days of each group; merges sketches, reads no orders."""
    return sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("kiosks")).alias("n_kiosks"),
        F.hll_sketch_estimate(F.hll_union_agg("products")).alias("n_products"), F.min("min_dt").alias("min_dt"), F.max("max_dt").alias("max_dt"))


def size_sketches(baskets: DataFrame, *by: str) -> DataFrame:
    """(by..., n_baskets, items, sizes): the sizes of ``products`` as a KLL sketch."""
    size = F.size("products").cast("bigint")
    return baskets.groupBy(*by).agg(F.count("*").alias("n_baskets"), F.sum(size).alias("items"),
                                    F.kll_sketch_agg_bigint(size, KLL_K).alias("sizes"))


def sketched_sizes(sketches: DataFrame, shares: dict[str, float], *by: str) -> DataFrame:
    """Baskets, mean size and estimated quantiles (one column per name in ``shares``) of each group of merged sketches."""
    merged = sketches.groupBy(*by).agg(F.sum("n_baskets").alias("n_baskets"), F.sum("items").alias("items"),
                                       F.kll_merge_agg_bigint("sizes").alias("sizes"))
    quantiles = [F.kll_sketch_get_quantile_bigint("sizes", F.lit(share)).alias(name) for name, share in shares.items()]
    return merged.select(*by, "n_baskets", F.try_divide("items", "n_baskets").alias("mean_size"), *quantiles)
