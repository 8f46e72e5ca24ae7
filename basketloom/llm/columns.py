"""Small shared pieces: written intermediates that can be dropped again, text as bytes, input columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.functions.durable import materialize

#: White space of the contracts: blank, tab, newline, vertical tab, form feed, carriage return. ``bytes.split`` uses the same.
WHITE = r"[\x20\x09-\x0D]+"


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the UTF-8 bytes of the text, whatever other columns there are; a null text is null bytes."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("binary").alias("text"))


def remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % divisor


def written(df: DataFrame) -> DataFrame:
    """``df`` as a parquet table in the shared folder; survives lost executors and cuts the lineage."""
    return materialize(df)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a table made by ``written`` that nothing reads any more."""
    jvm, hadoop = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)
