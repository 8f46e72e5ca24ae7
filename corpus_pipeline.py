"""The corpus pipeline: quality rules, near-duplicates, long repeats, benchmark passages, tokens."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.llm import bpe, decontaminate, quality_rules, simhash, suffix_dedup
from basketloom.llm.columns import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; rows of equal id are judged each by its own text."""
    kept = quality_rules.quality_rules(docs).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]) & (own == kept["_hash"]), "left_semi")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that with the smallest id; a row without an id stays only where no row of its group has one."""
    groups = simhash.near_duplicates(docs, shingle=3, distance=3)
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    first = written(groups.groupBy("group").agg(F.min(own).alias("own")).select(F.col("own.doc_id").alias("_id"), F.col("own.text_hash").alias("_hash")))
    text_hash = F.xxhash64(F.coalesce(docs["text"].cast("binary"), F.lit(b"")))
    one = docs.join(first, docs["doc_id"].eqNullSafe(first["_id"]) & (text_hash == first["_hash"]), "left_semi")
    # Rows equal in id and text can't be told apart by the join; texts are only moved where there are such rows.
    if groups.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        return one
    return one.withColumn("_hash", F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))).dropDuplicates(["doc_id", "_hash"]).drop("_hash")


#: Shortest repeat in bytes that goes; 51 words of the given tables span 285 bytes and more.
REPEAT = 250


def long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that are part of a long repeat; a character that is cut through becomes U+FFFD."""
    cut = suffix_dedup.remove_repeats(docs, length=REPEAT, carry=("lang", "source"))
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return cut.select("doc_id", text.alias("text"), "lang", "source").withColumn("n_chars", F.length("text").cast("long")).select(
        "doc_id", "text", "lang", "source", "n_chars")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = found.select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, docs["doc_id"] == leaks["_leak"], "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256); ids are packed little-endian unsigned 32-bit integers."""
    vocabulary = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN)
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality), ("near_dedup", near_dedup), ("suffix_dedup", long_repeats),
    ("decontaminate", benchmark_passages), ("byte_bpe", tokens)]

#: Fingerprints, byte ranges, alignments and token ids are outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each stage's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
