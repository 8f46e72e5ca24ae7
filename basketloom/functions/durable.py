"""Written intermediate tables in the cluster's shared folder: they survive executor loss."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths written inside the open ``scratch`` blocks, innermost last.
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only a session in one process may do without and gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.gettempdir()}/checkpoints/{spark.sparkContext.applicationId}"


def delete(spark: SparkSession, path: str) -> None:
    """Removes a written intermediate, wherever the shared folder is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def forget(df: DataFrame) -> None:
    """Removes the table that ``materialize`` returned, once nothing reads it any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        delete(df.sparkSession, folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediates written inside the block are removed at its end; results must be written or collected before."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


def collected(df: DataFrame) -> DataFrame:
    """A small report as a table that needs no intermediate any more."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet and read it back.

    Cuts the lineage like a checkpoint, but keeps column pruning and filter
    pushdown, and gives the planner the true size for its join choices.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/basketloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)
