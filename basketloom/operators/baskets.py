"""Baskets: the distinct products of one order of one store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.functions.ranking import top_lists
from basketloom.schema import require_columns

BASKET_KEYS = ["kiosk_id", "order_id"]


def _basket_lines(orders: DataFrame) -> DataFrame:
    require_columns(orders, [*BASKET_KEYS, "product_id"])
    return orders.select(*BASKET_KEYS, "product_id").distinct()


def _in_range(size: Column, min_items: int, max_items: int | None) -> Column:
    return size >= min_items if max_items is None else size.between(min_items, max_items)


def build_baskets(orders: DataFrame, min_items: int = 2, max_items: int | None = 200) -> DataFrame:
    """Sorted product arrays of the orders with ``min_items .. max_items`` distinct products; None keeps orders of any size.

    Distinct lines are spread over three keys first, and at most
    ``max_items + 1`` of an order reach its array: one more than allowed is
    enough to drop an oversized order, so no array grows beyond that.
    """
    lines = _basket_lines(orders)
    if max_items is None:
        baskets = lines.groupBy(*BASKET_KEYS).agg(F.sort_array(F.collect_list("product_id")).alias("products"))
    else:
        baskets = top_lists(lines, BASKET_KEYS, [F.col("product_id")], max_items + 1, "product_id", "products")
    return baskets.filter(_in_range(F.size("products"), min_items, max_items))


def basket_filter_counts(orders: DataFrame, min_items: int = 2, max_items: int | None = 200) -> DataFrame:
    """One row: baskets before the size filter, too small, too large, kept."""
    sizes = _basket_lines(orders).groupBy(*BASKET_KEYS).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("total_before"),
                     F.count_if(F.col("n") < min_items).alias("too_small"),
                     F.count_if(F.lit(False) if max_items is None else F.col("n") > max_items).alias("too_large"),
                     F.count_if(_in_range(F.col("n"), min_items, max_items)).alias("kept"))


def basket_size_stats(baskets: DataFrame) -> DataFrame:
    """One row of size statistics; sizes are counted first, so the quantiles see one row per size."""
    sizes = (baskets.groupBy(F.size("products").alias("n")).agg(F.count("*").alias("times")))
    return sizes.agg(
        F.min("n").cast("bigint").alias("min_size"),
        F.try_divide(F.sum(F.col("n") * F.col("times")), F.sum("times")).alias("mean_size"),
        *[F.percentile("n", share, F.col("times")).alias(name)
          for name, share in (("median_size", 0.5), ("p95_size", 0.95), ("p99_size", 0.99))],
        F.max("n").cast("bigint").alias("max_size"))


def explode_baskets(baskets: DataFrame) -> DataFrame:
    require_columns(baskets, ["order_id", "products"])
    return baskets.select("order_id", F.explode("products").alias("product_id"))


def product_basket_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(F.count("*").alias("product_count"))


def frequent_products(items: DataFrame, min_cooc: int = 2) -> DataFrame:
    """Basket items whose product lies in at least ``min_cooc`` baskets."""
    common = product_basket_counts(items).filter(F.col("product_count") >= min_cooc)
    return items.join(common.select("product_id"), "product_id", "left_semi").select(*items.columns)


def kiosk_anchor_queries(baskets: DataFrame) -> DataFrame:
    """Distinct (store, product in a kept basket): the queries."""
    return baskets.select("kiosk_id", F.explode("products").alias("anchor_product_id")).distinct()
