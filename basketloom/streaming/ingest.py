"""Incremental ingestion of order files and answers to streamed requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketloom.operators.cleaning import preprocess_orders
from basketloom.operators.lookup import recommend_requests
from basketloom.sources.files import order_file_schema


def ingest_orders_incremental(spark: SparkSession, folder: str, out_path: str, checkpoint_path: str, *,
                              files_per_batch: int = 1000) -> DataFrame:
    """Clean the order files of a folder that were not seen before into one zstd parquet table.

    Each call takes all new files and stops. The checkpoint remembers which
    files were taken, so a call repeated after a failure adds nothing twice.
    """
    raw = (spark.readStream.schema(order_file_schema(spark, folder)).option("header", True)
           .option("maxFilesPerTrigger", files_per_batch).csv(folder))
    query = (preprocess_orders(raw).writeStream.format("parquet").option("compression", "zstd")
             .option("path", out_path).option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out_path)


def answer_stream(requests: DataFrame, lookup: DataFrame, out_path: str, checkpoint_path: str,
                  model_id: str = "ranker") -> StreamingQuery:
    """Answer a stream of (anchor_id, kiosk_id[, limit]) requests from a catalog lookup."""
    return (recommend_requests(requests, lookup, model_id).writeStream.format("parquet")
            .option("path", out_path).option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())
