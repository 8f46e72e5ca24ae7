"""Candidates over a moving window of days, from stored counts per day.

The baskets of a day are counted once: how often each pair and each product occurs and how many baskets there are, in one
table (left, right, n) where a product has no right and the basket count neither. Counts of days add up, so a
window's counts are the sum of its days, and a window that moves on gets the new days and gives the old ones back.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.functions.durable import materialize
from basketloom.operators.baskets import build_baskets
from basketloom.operators.candidates import with_measures
from basketloom.operators.pairs import half_pairs, half_pairs_of_large_groups, mirrored

COUNT_KEYS = ["left", "right"]


def day_counts(orders: DataFrame, min_items: int = 2, max_items: int | None = 200) -> DataFrame:
    """(day, left, right, n) of all days in ``orders``; lines without a time belong to no day.

    An order counts on the days of its lines; its lines are expected to have one time. As in ``pair_cooccurrence``, an order id used by
    several stores on one day counts the pairs between them, too.
    """
    day = F.col("order_dt").cast("date")
    lines = orders.where(F.col("order_dt").isNotNull()).withColumn("day", day)
    # A basket of a day is that of the order id within the day.
    dated = lines.withColumn("order_id", F.concat_ws("|", F.col("day").cast("string"), "order_id"))
    baskets = materialize(build_baskets(dated, min_items, max_items).withColumn("day", F.substring("order_id", 1, 10).cast("date")))
    shared = materialize(baskets.groupBy("order_id").agg(F.count("*").alias("times")).where("times > 1").select("order_id"))
    pairs = half_pairs(baskets.join(shared, "order_id", "left_anti"), ["day"]).groupBy("day", *COUNT_KEYS).agg(F.count("*").alias("n"))
    if not shared.isEmpty():
        items = baskets.join(shared, "order_id", "left_semi").select("day", "order_id", F.explode("products").alias("product_id"))
        items = items.groupBy("day", "order_id", "product_id").agg(F.count("*").alias("times"))
        several = half_pairs_of_large_groups(items, ["day", "order_id"], "product_id", "times")
        pairs = pairs.unionByName(several.groupBy("day", *COUNT_KEYS).agg(F.sum("weight").alias("n")))
    none = F.lit(None).cast("string")
    single = (baskets.select("day", F.explode("products").alias("left")).groupBy("day", "left")
              .agg(F.count("*").alias("n")).withColumn("right", none))
    total = baskets.groupBy("day").agg(F.count("*").alias("n")).select("day", none.alias("left"), none.alias("right"), "n")
    return pairs.unionByName(single).unionByName(total).groupBy("day", *COUNT_KEYS).agg(F.sum("n").alias("n"))


def store_days(orders: DataFrame, path: str, **sizes) -> None:
    """Writes the counts of the days in ``orders``, a folder for each month; a day written again replaces the month's folder only.

    Days must come whole, and those of one month that are to stay must be given again.
    """
    counts = day_counts(orders, **sizes).withColumn("month", F.date_format("day", "yyyy-MM"))
    (counts.repartition("month", F.pmod(F.xxhash64("left"), F.lit(16))).sortWithinPartitions("month", "day")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))


def append_days(orders: DataFrame, path: str, **sizes) -> None:
    """Adds the counts of days that the store doesn't have yet."""
    counts = day_counts(orders, **sizes).withColumn("month", F.date_format("day", "yyyy-MM"))
    counts.sortWithinPartitions("month", "day").write.mode("append").partitionBy("month").parquet(path)


def stored_days(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """Stored counts of the days from ``first`` to ``last``; only their months are listed, only their rows read."""
    days = F.col("day").between(F.lit(first), F.lit(last))
    months = F.col("month").between(first.strftime("%Y-%m"), last.strftime("%Y-%m"))
    return spark.read.option("basePath", path).parquet(path).where(months & days).select("day", *COUNT_KEYS, "n")


def window_counts(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """(left, right, n) of a window, merged from its days."""
    return stored_days(spark, path, first, last).groupBy(*COUNT_KEYS).agg(F.sum("n").alias("n"))


def moved_counts(spark: SparkSession, counts: DataFrame, path: str, window: tuple[date, date], to: tuple[date, date]) -> DataFrame:
    """The counts of the window ``to`` from those of ``window``: days that come in are added, days that go out taken off.

    Only these days are read, whatever the length of the window. The windows must move forward and overlap or touch.
    """
    (first, last), (new_first, new_last) = window, to
    day = timedelta(days=1)
    if not (first <= new_first <= last + day and last <= new_last):
        raise ValueError("a window moves forward, and starts no later than the day after its end")
    parts = counts.select(*COUNT_KEYS, "n")
    if new_last > last:
        parts = parts.unionByName(stored_days(spark, path, last + day, new_last).select(*COUNT_KEYS, "n"))
    if new_first > first:
        gone = stored_days(spark, path, first, new_first - day)
        parts = parts.unionByName(gone.select(*COUNT_KEYS, (-F.col("n")).alias("n")))
    return parts.groupBy(*COUNT_KEYS).agg(F.sum("n").alias("n")).where("n <> 0")


def candidates_of_counts(counts: DataFrame, min_cooc: int = 2) -> DataFrame:
    """What ``generate_candidates`` gives for the baskets behind the counts."""
    products = materialize(counts.where(F.col("right").isNull() & F.col("left").isNotNull() & (F.col("n") >= min_cooc)).select(
        F.col("left").alias("product_id"), F.col("n").alias("product_count")))
    total = counts.where(F.col("left").isNull()).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n")).scalar()
    often = counts.where(F.col("right").isNotNull() & (F.col("n") >= min_cooc)).withColumnRenamed("n", "cooc_count")
    return with_measures(mirrored(often, []), products, total)
