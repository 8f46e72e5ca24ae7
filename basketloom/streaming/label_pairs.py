"""Label pairs of a stream of order lines, in event time.

The stream meets itself: each line waits as an anchor for the window after it and as a candidate for anchors that come
late. The watermark bounds both waits. Matches are counted per day of the candidate line; a day is written when
the watermark has passed it, so that the result is a table of partial counts which are summed when read.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.functions.times import DAY_MICROS, micros
from basketloom.schema import ROW_KEYS

#: Store and product of a mark; lines without a store are filtered out before they can move the watermark.
MARK = "__mark__"
LINES = "kiosk_id string, product_id string, order_dt timestamp_ntz"


def _lines(spark: SparkSession, folder: str, files_per_batch: int, delay: str) -> DataFrame:
    raw = spark.readStream.schema(LINES).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    # The instant of the zone-less time as if in UTC: no gap or repeated hour, whatever the session's zone.
    return raw.select("kiosk_id", "product_id", F.timestamp_micros(micros(F.col("order_dt"))).alias("at")).withWatermark("at", delay)


def matched_lines(spark: SparkSession, folder: str, *, window_days: int, delay: str, files_per_batch: int) -> DataFrame:
    """Stream of (store, anchor, candidate, at): each candidate line with each anchor line of the window before it."""
    anchors, others = (_lines(spark, folder, files_per_batch, delay).alias(name) for name in ("a", "c"))
    width = F.expr(f"INTERVAL '{window_days * 86_400}' SECOND")
    meets = ((F.col("a.kiosk_id") == F.col("c.kiosk_id")) & (F.col("a.product_id") != F.col("c.product_id"))
             & (F.col("c.at") >= F.col("a.at")) & (F.col("c.at") <= F.col("a.at") + width))
    return anchors.join(others, meets).select(
        F.col("a.kiosk_id").alias("kiosk_id"), F.col("a.product_id").alias("anchor_product_id"),
        F.col("c.product_id").alias("candidate_product_id"), F.col("c.at").alias("at"))


def state_partitions(spark: SparkSession) -> int:
    """Two for each core, at most what the session asks for.

    Every partition of the state has five stores that are committed in every batch, whether lines came or not, and
    adaptive execution doesn't merge them.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def stream_label_pairs(spark: SparkSession, folder: str, out_path: str, checkpoint_path: str, *, window_days: int = 7,
                       delay: str = "1 day", files_per_batch: int = 1000) -> int:
    """Takes all new files of ``folder`` (parquet lines of store, product and ``order_dt``), appends partial counts to ``out_path`` and
    returns the number of late lines of this run: those older than the watermark when their file was read.

    Late lines are in no pair. Lines of unknown store, product or time are in none either. The checkpoint holds the waiting
    lines and the days that are still open, so a call after a failure or for new files goes on where the last one ended.
    The first call fixes the number of state partitions, see ``state_partitions``.
    """
    pairs = matched_lines(spark, folder, window_days=window_days, delay=delay, files_per_batch=files_per_batch)
    days = pairs.groupBy(F.window("at", "1 day").alias("day"), *ROW_KEYS).agg(F.count("*").alias("n"))
    out = days.select(F.col("day.start").cast("date").alias("day"), *ROW_KEYS, "n")
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    # The stream keeps the settings that it starts with; the session gets its own back.
    spark.conf.set("spark.sql.shuffle.partitions", state_partitions(spark))
    try:
        query = (out.writeStream.format("parquet").outputMode("append").option("path", out_path)
                 .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
    dropped: dict[int, int] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(5)
        for progress in query.recentProgress:
            joins = [s for s in progress.stateOperators if s.operatorName == "symmetricHashJoin"]
            dropped[progress.batchId] = max(dropped.get(progress.batchId, 0), sum(s.numRowsDroppedByWatermark for s in joins))
    # A late line is turned away twice, as anchor and as candidate.
    return sum(dropped.values()) // 2


def close_days(spark: SparkSession, folder: str, after: datetime) -> None:
    """Adds a mark at ``after``, a line in no pair that moves the watermark on, so that the days before are written."""
    text = after.isoformat(sep=" ")
    mark = spark.range(1).selectExpr(f"'{MARK}' kiosk_id", f"'{MARK}' product_id", f"timestamp_ntz '{text}' order_dt")
    mark.coalesce(1).write.mode("append").parquet(folder)


def streamed_pairs(spark: SparkSession, out_path: str, min_cooc: int = 1) -> DataFrame:
    """(store, anchor, candidate, cooc_count) of all days written so far, as ``label_pairs_window`` gives them."""
    partial = spark.read.parquet(out_path)
    return partial.groupBy(*ROW_KEYS).agg(F.sum("n").alias("cooc_count")).where(F.col("cooc_count") >= min_cooc)
