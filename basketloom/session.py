"""A local session for tests, benchmarks and small runs; clusters bring their own."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, memory: str = "4g", shared: str | None = None) -> SparkSession:
    """All cores busy on small data: shuffles and scans are not merged into a few large tasks.

    ``shared``: folder of intermediates, by default one below the machine's temporary folder.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("basketloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", shared or f"{tempfile.gettempdir()}/checkpoints/basketloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.files.openCostInBytes", "128k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
