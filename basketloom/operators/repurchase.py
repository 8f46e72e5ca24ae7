"""How often stores come back for a product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["kiosk_id", "product_id"]


def purchase_days(orders: DataFrame) -> DataFrame:
    """(store, product, day, lines, quantity) of each day with a purchase; lines without a time are left out.

    Counted before any window, so that a window's group holds at most a row a day however busy the store is, and a store is
    spread over its products.
    """
    return (orders.where(F.col("order_dt").isNotNull()).groupBy(*KEYS, F.col("order_dt").cast("date").alias("day"))
            .agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity")))


def repurchase_gaps(days: DataFrame, within: int = 30) -> DataFrame:
    """Purchase days with the days since the last and until the next one (null at the ends), and the lines of the ``within`` days to it."""
    order = Window.partitionBy(*KEYS).orderBy("day")
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    recent = Window.partitionBy(*KEYS).orderBy(number).rangeBetween(1 - within, Window.currentRow)
    return days.select("*", F.datediff("day", F.lag("day").over(order)).alias("gap_days"),
                       F.datediff(F.lead("day").over(order), F.col("day")).alias("next_gap_days"),
                       F.sum("lines").over(recent).alias("recent_lines"))


def repurchase_summary(gaps: DataFrame) -> DataFrame:
    """Per store and product: purchase days, least, mean and largest gap, last day; one purchase has no gap."""
    return gaps.groupBy(*KEYS).agg(
        F.count("*").alias("n_days"), F.min("gap_days").alias("min_gap"), F.avg("gap_days").alias("mean_gap"),
        F.max("gap_days").alias("max_gap"), F.max("day").alias("last_day"))
