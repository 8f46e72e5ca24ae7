"""Cleaning of raw order lines, store and product filters, and data checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.schema import ORDER_KEY_COLUMNS, RAW_ORDER_COLUMNS, require_columns
from basketloom.sources.files import last_orders


def preprocess_orders(raw: DataFrame, *, strict: bool = True, check: bool = False) -> DataFrame:
    """Raw order lines to canonical ones: real orders with a positive quantity.

    Text dates that cannot be read become NULL. ``check`` runs the not-NULL
    test at once (a pass over the data); plans run it on the written table.
    Lines are not deduplicated.
    """
    if strict:
        require_columns(raw, RAW_ORDER_COLUMNS)
    clean = (
        raw.filter(F.col("documenttype") == "order")
        .filter(F.col("quantity").cast("double") > 0)
        .select(
            F.col("orderid").cast("string").alias("order_id"),
            F.col("userid").cast("string").alias("kiosk_id"),
            F.col("productid").cast("string").alias("product_id"),
            F.col("orderdt").try_cast("timestamp_ntz").alias("order_dt"),
            F.col("quantity").cast("double").alias("quantity"),
        )
    )
    if check:
        assert_not_null(clean)
    return clean


def null_counts(df: DataFrame, columns: Iterable[str] = tuple(ORDER_KEY_COLUMNS)) -> DataFrame:
    """One row: NULLs per column, all columns in one pass."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])


def assert_not_null(df: DataFrame, columns: Iterable[str] = tuple(ORDER_KEY_COLUMNS)) -> None:
    found = {name: n for name, n in null_counts(df, columns).first().asDict().items() if n}
    if found:
        raise ValueError(f"NULL values found: {found}")


def null_ratios(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: share of NULLs per column."""
    return df.agg(*[F.avg(F.col(name).isNull().cast("double")).alias(name) for name in columns])


def active_kiosk_ids(commerces: DataFrame) -> DataFrame:
    """Ids of active stores; a store listed twice appears twice."""
    return (commerces.filter(F.col("active"))
            .select(F.col("userid").cast("string").alias("kiosk_id"))
            .filter(F.col("kiosk_id").isNotNull()))


def filter_active_kiosks(orders: DataFrame, commerces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders and stores of active stores; both unchanged where no flag exists."""
    if "active" not in commerces.columns:
        return orders, commerces
    kept = orders.join(active_kiosk_ids(commerces), "kiosk_id", "left_semi")
    return kept, commerces.filter(F.col("active"))


def blocked_product_ids(products: DataFrame) -> DataFrame:
    ids = products.select(F.col("productid").cast("string").alias("product_id"))
    if "blocked" not in products.columns:
        return ids.limit(0)
    flag = F.lower(F.col("blocked").cast("string")) == "true"
    return products.filter(flag).select(F.col("productid").cast("string").alias("product_id")).distinct()


def filter_blocked_products(orders: DataFrame, blocked: DataFrame) -> DataFrame:
    """Drop the order lines (not the orders) of blocked products."""
    return orders.join(blocked, "product_id", "left_anti").select(*orders.columns)


def inference_window(orders: DataFrame, last_n_days: int = 90, max_rows: int = 0,
                     *, leaf_rows: int = 100_000) -> DataFrame:
    """The last ``last_n_days`` before the newest order, then at most the newest ``max_rows`` lines."""
    recent = orders
    if last_n_days > 0:
        newest = orders.agg(F.max("order_dt").alias("newest")).scalar()
        recent = orders.filter(F.col("order_dt") >= newest - F.make_dt_interval(F.lit(last_n_days)))
    if max_rows > 0:
        recent = last_orders(recent, max_rows, leaf_rows=leaf_rows)
    return recent


def orders_profile(orders: DataFrame, part: Column, whole: str = "all") -> DataFrame:
    """One row per part and one for all orders: lines, stores and time range, from one scan with grouping sets.

    ``part`` names the part of a line; lines that it leaves without one count in the whole only.
    """
    rolled = orders.withColumn("split", part).rollup("split").agg(
        F.grouping("split").alias("_whole"), F.count("*").alias("n_rows"), F.count_distinct("kiosk_id").alias("n_kiosks"),
        F.min("order_dt").alias("min_dt"), F.max("order_dt").alias("max_dt"))
    name = F.when(F.col("_whole") == 1, F.lit(whole)).otherwise(F.col("split"))
    return rolled.withColumn("split", name).where("split IS NOT NULL").drop("_whole")
