"""SimHash near-duplicates by multi-index hashing.

The 64-bit fingerprints are cut into two segments of 32 bits. Of two fingerprints that differ in at most three
bits, one segment differs in at most one. So every fingerprint is entered in a table under each of its segments,
and probes the table with all segments of the Hamming ball of radius one; of the two flips that would find
the same pair only the one from 1 to 0 is made. Members of a bucket are compared by their complete distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from basketloom.llm.columns import id_and_bytes, written
from basketloom.llm.components import components

SEED = 42
#: Hashes whose bits are counted at once.
CHUNK = 1 << 16
#: Members that a bucket may have to be compared in one place.
LEAF = 4096


def text_fingerprint(text: bytes | None, shingle: int) -> int:
    """Majority of the bits of all shingle hashes, repeats included; 0 without a word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) > shingle:
        starts = np.concatenate(([0], ends[: len(words) - shingle] + 1)).tolist()
        pieces = [line[s:e] for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    else:
        pieces = [line]
    hashed = np.fromiter(map(partial(xxh64_intdigest, seed=SEED), pieces), np.uint64, len(pieces))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashed), CHUNK):
        part = hashed[i : i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(hashed)).tolist())


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, text_hash) with the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([text_fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)], ["doc_id", "fp", "text_hash"])

    rows = id_and_bytes(docs).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(b""))))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long, text_hash long")


def _bucket_rows(prints: DataFrame, radius: int) -> DataFrame:
    """(bucket, rest, fp, rep, probe): table entries, and those probes that meet an entry.

    ``rest``: the bits that tell the members of a bucket apart, those of the other segment.
    """
    low = F.lit(0xFFFFFFFF)
    sides = prints.select("fp", "rep", F.posexplode(F.array(
        F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(low))).alias("side", "segment"))
    sides = sides.select("fp", "rep", "segment", (F.col("side").cast("long") * F.lit(1 << 32)).alias("base"),
                         F.when(F.col("side") == 0, low).otherwise(F.lit(-1 << 32)).alias("rest"))
    table = sides.select((F.col("base") + F.col("segment")).alias("bucket"), "rest", "fp", "rep", F.lit(False).alias("probe"))
    if not radius:
        return table
    flips = F.array(*[F.lit(1 << i) for i in range(32)])
    probes = sides.select("base", "rest", "fp", "rep", F.explode(F.filter(
        flips, lambda bit: F.col("segment").bitwiseAND(bit) != 0)).alias("bit"), "segment")
    probes = probes.select((F.col("base") + F.col("segment").bitwiseXOR(F.col("bit"))).alias("bucket"), "rest", "fp",
                           "rep", F.lit(True).alias("probe"))
    return table.union(probes.join(table.select("bucket").distinct(), "bucket", "left_semi"))


def _ball(radius: int) -> np.ndarray:
    """All 32-bit masks with at most ``radius`` bits."""
    return np.array([sum(1 << i for i in bits) for n in range(radius + 1) for bits in combinations(range(32), n)], np.uint64)


def _crowded_edges(rows: DataFrame, distance: int) -> DataFrame:
    """Edges with the components of all links of crowded buckets, by points that lie between the linked.

    Members of a bucket agree in one segment (probes differ from entries in one bit of it). In the other segment each
    entry names the points around it at ``distance // 2`` bits (near) and at the bits left of the distance (far), a
    probe those at one bit less (far). Whoever names a point that is near to an entry is linked with that entry, and
    two that are linked name a common point. A point is named by few fingerprints, however crowded the bucket.
    """
    near, far = distance // 2, distance - distance // 2
    balls = [(_ball(near), True, False), (_ball(far), False, False), (_ball(max(0, far - 1)), False, True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, rest, fp, rep, probe = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            for begin in range(0, len(fp), 512):
                part = slice(begin, begin + 512)
                own, free = fp[part].view(np.uint64), rest[part].view(np.uint64)
                shift = np.where(free >> np.uint64(63) == 1, 32, 0).astype(np.uint64)
                for ball, is_near, of_probes in balls:
                    at = np.flatnonzero(probe[part].astype(bool) == of_probes)
                    points = (own & free)[at, None] ^ (ball[None, :] << shift[at, None])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(bucket[part][at], len(ball))), pa.array(points.ravel().view(np.int64)),
                        pa.array(np.repeat(rep[part][at], len(ball))), pa.array(np.full(points.size, is_near))], ["bucket", "point", "rep", "near"])

    named = written(rows.select("bucket", "rest", "fp", "rep", "probe").mapInArrow(run, "bucket long, point long, rep long, near boolean"))
    first = named.groupBy("bucket", "point").agg(F.min("rep").alias("b"), F.max("near").alias("near")).where("near")
    return named.join(first.select("bucket", "point", "b"), ["bucket", "point"]).select(F.col("rep").alias("a"), "b").where("a <> b").distinct()


def _linked(fp: np.ndarray, probe: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges (member, first member) of a forest with the same components as all links of one bucket."""
    entries = np.flatnonzero(~probe)
    free, edges = np.ones(len(fp), bool), []
    for start in entries.tolist():
        if not free[start]:
            continue
        free[start], front = False, [start]
        while front:
            at = front.pop()
            # Two probes of one bucket needn't be near in this segment; they are compared where one is an entry.
            others = np.flatnonzero(free) if not probe[at] else entries[free[entries]]
            near = others[np.bitwise_count(fp[others] ^ fp[at]) <= distance]
            free[near] = False
            edges += [(x, start) for x in near.tolist()]
            front += near.tolist()
    return edges


def _edges(rows: DataFrame, distance: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch.column(0):
                fields = members.values
                fp = fields.field("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                rep, probe = (fields.field(n).to_numpy(zero_copy_only=False) for n in ("rep", "probe"))
                found = _linked(fp, probe.astype(bool), distance)
                a += [rep[x] for x, _ in found]
                b += [rep[y] for _, y in found]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    groups = rows.groupBy("bucket").agg(F.collect_list(F.struct("fp", "rep", "probe")).alias("members"))
    return groups.where(F.size("members") > 1).select("members").mapInArrow(run, "a long, b long")


def links(prints: DataFrame, distance: int = 3, leaf: int = LEAF) -> DataFrame:
    """Edges (a, b) between the ``rep`` of distinct fingerprints (fp, rep), with the components of all links.

    Links at ``distance`` or fewer bits (0 to 3). Members of a bucket are compared in one place up to ``leaf`` members;
    links of a bucket with more are found from points between them, so that no bucket is too large for a task.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two segments with balls of radius one find distances from 0 to 3")
    rows = written(_bucket_rows(prints, distance // 2))
    crowded = rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > leaf).select("bucket")
    if crowded.isEmpty():
        return _edges(rows, distance)
    return _edges(rows.join(crowded, "bucket", "left_anti"), distance).union(
        _crowded_edges(rows.join(crowded, "bucket", "left_semi"), distance))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, leaf: int = LEAF) -> DataFrame:
    """(doc_id, fingerprint, component_id, text_hash, group) for every row.

    ``fingerprint``: 16 lowercase hex digits; ``component_id``: the smallest doc_id reachable over links; ``text_hash``: xxhash64 of
    the text, an empty one for null; ``group``: a number of the component. A null or wordless text has fingerprint zero and is
    linked like any other. Fewer words than ``shingle`` make one shingle. Rows of one id are linked each by its own text;
    rows without an id are linked, too, and a component of such rows only has a null component_id; an empty table gives no
    rows. Exact copies and equal fingerprints meet in one row before any pair is formed.
    """
    each = written(fingerprints(docs, shingle))
    # Fingerprints are the vertices, so that rows of one id are linked by their own texts only.
    distinct = written(each.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(distinct.select("fp", F.col("fp").alias("rep")), distance, leaf))
    named = distinct.join(found, distinct["fp"] == found["id"], "left").select("fp", "least", F.coalesce("component", "fp").alias("group"))
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = written(named.join(smallest, "group").select("fp", "group", "component_id"))
    return each.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_hash", "group")
