"""URL filter: a blocked Bloom filter of listed URLs, then an exact join; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.llm.columns import written

#: Blocks of the filter, of eight 64-bit words each: 2^16 blocks are at most 5 MB, whatever the list's size. Beyond some
#: three million URLs more of the others pass the filter; the join that follows stays exact.
MAX_BLOCKS = 1 << 16
KEYS_PER_BLOCK = 48
WORDS = 8


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) text between the first ``://`` and the next of ``/?#``; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical_url(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without an ending ``/`` or ``.html``; scheme, query and fragment are left out."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(\.html|/+)$", ""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bit(key: Column, word: int) -> Column:
    """The one bit that a key sets in a word of its block."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.lit(word), key), F.lit(64)).cast("int"))


def blocked_bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w7): a row for each block that has a key; ORs are combined before they are shuffled."""
    rows = listed.select(_block(F.col(key), blocks).alias("block"), *[_bit(F.col(key), i).alias(f"w{i}") for i in range(WORDS)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possibly_listed(rows: DataFrame, key: str, keys: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``rows`` with a boolean ``possible``: true for every row whose ``key`` is one of ``keys``, and for few others."""
    blocks = min(max_blocks, 1 << max(4, (keys.count() // KEYS_PER_BLOCK).bit_length()))
    bloom = blocked_bloom(keys, key, blocks)
    tested = rows.withColumn("block", _block(F.col(key), blocks)).join(F.broadcast(bloom), "block", "left")
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.coalesce(F.col(f"w{i}"), F.lit(0)).bitwiseAND(_bit(F.col(key), i)) != 0)
    return tested.withColumn("possible", hit & F.col(key).isNotNull()).drop("block", *[f"w{i}" for i in range(WORDS)])


def listed_urls(rows: DataFrame, key: str, listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``rows`` with a boolean ``listed``: whether ``key`` is a value of the column of the same name in ``listed``.

    Rows that the filter turns away are never shuffled. Null keys are not listed.
    """
    keys = written(listed.where(F.col(key).isNotNull()).select(key).distinct())
    tested = possibly_listed(rows, key, keys, max_blocks)
    turned_away = tested.where(~F.col("possible")).withColumn("listed", F.lit(False))
    exact = tested.where("possible").join(keys.select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left")
    return turned_away.union(exact.withColumn("listed", F.col("_key").isNotNull()).drop("_key")).drop("possible")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule (verdict, host/path) that fits: same host or a subdomain, path begins like the rule's."""
    chosen = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{rest}")
        chosen = F.when(fits, F.lit(rule)).otherwise(chosen)
    return chosen


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id",
                url_col: str = "url", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(page_id, host, path, rule, listed, verdict) for every page; ``listed`` has a column ``canonical``.

    The verdict is the rule's; without one it is block for listed canonical URLs and allow for others. A null URL or
    one without ``://`` has an empty host and path, fits no rule and is allowed. Repeated rows are judged each;
    an empty list blocks nothing.
    """
    rows = pages.select(pages[id_col].alias("page_id"), host_of(pages[url_col]).alias("host"), path_of(pages[url_col]).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "canonical", F.nullif(canonical_url(F.col("host"), F.col("path")), F.lit("")))
    known = listed_urls(rows, "canonical", listed, max_blocks)
    verdict = F.when(F.col("listed"), "block").otherwise("allow")
    for way in ("allow", "block"):
        verdict = F.when(F.col("rule").isin([r for v, r in rules if v == way]), way).otherwise(verdict)
    return known.select("page_id", "host", "path", "rule", "listed", verdict.alias("verdict"))
