"""The registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.llm import bpe, collocations, decontaminate, fast_minhash, langid, lattice_lm, licenses, mil_quality, quality_rules, runs, simhash, suffix_dedup, url_filter
from basketloom.llm.columns import remainder

#: Fixed values of the contract: verdict and host/path of each URL rule.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Host labels of known spam sites; their pages make the list of the URL filter.
SPAM_LABELS = ["spam-farm", "cheap-pills"]
#: Rounds of fitting the weights of the lattice's pieces; held-out texts gain less than 0.002 a token from further ones.
LATTICE_ROUNDS = 4


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, distance=3)
    return found.select("doc_id", "fingerprint", "component_id")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of the contract, then what was removed (``spans``, byte ranges) and the ``text`` that stays."""
    cut = suffix_dedup.remove_repeats(table(spark, folder, "documents"), length=400)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return cut.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), "spans", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def with_paths(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source, thousand of the id, language. Every tenth document is the licence file of
    its thousand, every hundredth that of its source; which of them give a license is up to their texts."""
    top, middle = F.col("source"), F.concat(F.lit("d"), F.floor(F.col("doc_id") / 1000).cast("string"))
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    path = F.when(F.col("doc_id") % 100 == 0, F.concat_ws("/", top, F.lit("LICENSE"))).when(
        F.col("doc_id") % 10 == 0, F.concat_ws("/", top, middle, F.lit("LICENSE"))).otherwise(F.concat_ws("/", top, middle, "lang", name))
    return docs.select("doc_id", "text", path.alias("path"))


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(with_paths(table(spark, folder, "documents")))


def held_out(divisor: int, value: int):
    return F.coalesce(remainder(F.col("doc_id"), divisor) == value, F.lit(True)).alias("held_out")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    predicted = langid.predict(docs, langid.train(docs))
    return predicted.select("doc_id", held_out(3, 1), "lang_pred", "score")


def op7_lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    scores = lattice_lm.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return lattice_lm.lattice_scores(table(spark, folder, "documents"), scores, rounds=LATTICE_ROUNDS)


def op8_mil_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = mil_quality.score(docs, mil_quality.train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", held_out(3, 1), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(table(spark, folder, "documents"), tokens, public_tokenizers.PATTERN)
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    spam = [host.contains(f"{label}.") for label in SPAM_LABELS]
    listed = pages.where(spam[0] | spam[1]).select(url_filter.canonical_url(host, path).alias("canonical"))
    judged = url_filter.filter_urls(pages, listed, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), least=30, longest=4, top=2000)


def op12_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return fast_minhash.near_duplicates(table(spark, folder, "documents"), shingle=4, percent=80)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.word_runs(table(spark, folder, "documents"), change=runs.looped)
    # Longest, then first, then of the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash_near_dedup, op2_quality_rules, op3_suffix_dedup, op4_decontaminate, op5_license_scan,
        op6_language_id, op7_lattice_lm, op8_mil_quality, op9_byte_bpe, op10_url_filter, op11_collocations, op12_minhash_near_dedup, op13_periodic_runs)}
