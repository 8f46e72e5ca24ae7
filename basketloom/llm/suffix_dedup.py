"""Removal of long repeated byte strings with a logarithmic family of sparse suffix arrays.

A string of ``length`` bytes counts as repeated if it starts at another place too. Only some suffixes are sorted:
of the GRAM-byte strings inside every window of ``length`` bytes, the one with the smallest hash is the window's
anchor. Equal windows have equal anchors at equal offsets, so every repeat shows as a repeated anchor.

The suffixes at the anchors, in the order of their first bytes, make a batch's suffix array. It is merge-scanned
(a sort-merge join) against the arrays of all existing levels; then arrays of equal level merge to one of the next.

What matched is judged exactly, coarse to fine. The windows of one anchor are a block. Equal hulls (all bytes of the
block's windows) settle a block, equal cores (the bytes that all of them share) with different hulls send one block
of each hull on, to be judged by parts of GRID windows and then by single windows. Strings of equal 64-bit core
and 64-bit hull, or of two equal 64-bit hashes, count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.llm.columns import dropped, written

LENGTH = 400
GRAM = 101
#: Windows of a part of a block.
GRID = 32
#: Slices of the hulls of a core, so that a core with a large part of all hulls is not one task.
SLICES = 8
#: Windows of a text that are hashed at once.
CHUNK = 1 << 19
#: Batches of one run; a stored index gets a batch for each delivery.
BATCHES = 3
_PLACE = np.uint64((1 << 31) - 1)


class Hasher:
    """Polynomial hashes modulo 2^64 of any byte range of a buffer, from running sums."""

    def __init__(self, base: int, size: int):
        ones = np.full(size + 1, base, np.uint64)
        back = np.full(size + 1, pow(base, -1, 1 << 64), np.uint64)
        ones[0] = back[0] = 1
        self.up, self.down = np.multiply.accumulate(ones), np.multiply.accumulate(back)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (sums[end] - sums[begin]) * self.down[begin]
        return (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


_hashers: dict[tuple[int, int], Hasher] = {}
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _hasher(which: int, size: int) -> Hasher:
    room = max(CHUNK + 2 * LENGTH, 1 << (size - 1).bit_length() if size else 1)
    if (which, room) not in _hashers:
        _hashers[which, room] = Hasher(BASES[which], room)
    return _hashers[which, room]


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(rows, axis=1).ravel()
    n = len(values) - width + 1
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def blocks(text: bytes, length: int) -> dict[str, np.ndarray]:
    """Anchor place p, first and last window lo and hi, first bytes, hash of the anchor and of the hull, per block."""
    data, hashed = np.frombuffer(text, np.uint8), None
    n, parts = len(data) - length + 1, []
    for first in range(0, max(0, n), CHUNK):
        part = data[first : min(len(data), first + CHUNK + length - 1)]
        hashed = _hasher(0, len(part))
        sums, at = hashed.sums(part), np.arange(len(part) - GRAM + 1)
        grams = hashed.of(sums, at, at + GRAM)
        # The leftmost of equal hashes wins.
        owner = (_sliding_minimum((grams & ~_PLACE) | at.astype(np.uint64), length - GRAM + 1) & _PLACE).astype(np.int64)
        edges = np.flatnonzero(owner[1:] != owner[:-1]) + 1
        lo, hi = np.concatenate(([0], edges)), np.append(edges - 1, len(owner) - 1)
        p = owner[lo]
        parts.append((p + first, lo + first, hi + first, grams[p], hashed.of(sums, lo, hi + length)))
    if not parts:
        return {}
    p, lo, hi, gram, hull = (np.concatenate(x) for x in zip(*parts, strict=True))
    # A block that goes on in the next chunk is one block.
    start = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
    end = np.append(start[1:], len(p)) - 1
    p, lo, hi, gram, hull = p[start], lo[start], hi[end], gram[start], hull[start]
    for i in np.flatnonzero(end > start).tolist():
        piece = data[lo[i] : hi[i] + length]
        hashed = _hasher(0, len(piece))
        hull[i] = hashed.of(hashed.sums(piece), np.array([0]), np.array([len(piece)]))[0]
    head = data[p[:, None] + np.arange(4)].astype(np.int64) @ np.array([1 << 24, 1 << 16, 1 << 8, 1])
    return {"p": p, "lo": lo, "hi": hi, "head": head, "gram": gram.view(np.int64), "hull": hull.view(np.int64)}


def _rows(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``row`` tells rows of equal id apart; rows equal in both are copies, and whatever is removed is so from both."""
    text = F.coalesce(docs[text_col].cast("binary"), F.lit(b""))
    return docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[id_col].cast("string"), text).alias("row"), text.alias("text"),
                       *[docs[c].alias(f"with_{c}") for c in carry])


def _key_type(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()


def anchor_suffixes(rows: DataFrame, length: int) -> DataFrame:
    """(doc_id, row, p, lo, hi, head, gram, hull) of all blocks of all texts."""
    names = ["p", "lo", "hi", "head", "gram", "hull"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for begin in range(0, len(texts), 256):
                found = [blocks(t, length) for t in texts[begin : begin + 256]]
                sizes = [len(f.get("p", ())) for f in found]
                if not sum(sizes):
                    continue
                at = pa.array(np.repeat(np.arange(begin, begin + len(sizes)), sizes))
                columns = [np.concatenate([f[n] for f in found if f]) for n in names]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *map(pa.array, columns)],
                                                 ["doc_id", "row", *names])

    fields = ", ".join(f"{n} long" for n in names)
    return rows.mapInArrow(run, f"doc_id {_key_type(rows)}, row long, {fields}").select(
        "doc_id", "row", *[F.col(n).cast("int") for n in names[:3]], "head", "gram", "hull")


class SuffixIndex:
    """Levels of suffix arrays. A level is a table of (head, gram, n), in suffix order inside each range of it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[tuple[int, DataFrame]] = []

    @staticmethod
    def _array(suffixes: DataFrame, count: Column) -> DataFrame:
        return written(suffixes.groupBy("head", "gram").agg(count.alias("n")).sortWithinPartitions("head", "gram"))

    def add(self, suffixes: DataFrame, last: bool = False) -> DataFrame:
        """Enters a batch; returns the distinct (head, gram) that it repeats, of its own or of a level."""
        fresh = self._array(suffixes, F.count("*"))
        repeated = fresh.where("n > 1").select("head", "gram")
        for _, array in self.levels:
            repeated = repeated.union(fresh.join(array.select("head", "gram"), ["head", "gram"], "left_semi").select("head", "gram"))
        repeated = written(repeated.distinct())
        level = 0
        while not last and self.levels and self.levels[-1][0] == level:
            other, old = self.levels.pop()[1], fresh
            fresh = self._array(other.union(fresh), F.sum("n"))
            dropped(other)
            dropped(old)
            level += 1
        self.levels.append((level, fresh))
        return repeated


def repeated_anchors(spark: SparkSession, anchors: DataFrame, batches: int) -> DataFrame:
    index, found = SuffixIndex(spark), None
    for i in range(batches):
        part = anchors.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == i)
        repeated = index.add(part, last=i + 1 == batches)
        found = repeated if found is None else found.union(repeated)
    # A table of its own, so that the planner can split a hot anchor in the join with it.
    return written(found.distinct())


def _judged(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repeated (core, hull), and one piece of each hull of those cores that have an unsettled hull beside others."""
    classes = written(pieces.groupBy("core", "hull").agg(F.count("*").alias("n"), F.min("piece").alias("piece")))
    mixed = classes.groupBy("core").agg(F.count("*").alias("hulls"), F.min("n").alias("least"))
    mixed = mixed.where("hulls > 1 and least = 1").select("core", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"))
    sliced = classes.withColumn("slice", F.pmod(F.xxhash64("hull"), F.lit(SLICES)).cast("int"))
    return classes.where("n > 1").select("core", "hull"), sliced.join(mixed, ["core", "slice"], "left_semi").select("piece.*")


def _regions(rows: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """(region, doc_id, row, p, lo, hi, begin, size, bytes) for each chosen block: its windows and GRID bytes around."""
    names = ["region", "doc_id", "row", "p", "lo", "hi", "begin", "size", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        region = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for i, (text, found) in enumerate(zip(texts, batch.column(3).to_pylist(), strict=True)):
                p, lo, hi = ([f[n] for f in found] for n in ("p", "lo", "hi"))
                begin = [max(0, x - GRID) for x in lo]
                cut = [text[b : h + length + GRID] for b, h in zip(begin, hi, strict=True)]
                at = pa.array([i] * len(found))
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(region, region + len(found)), pa.int64()), batch.column(0).take(at), batch.column(1).take(at),
                    *(pa.array(x, pa.int32()) for x in (p, lo, hi, begin, [len(text)] * len(found))), pa.array(cut, pa.binary())], names)
                region += len(found)

    per_text = chosen.groupBy("doc_id", "row").agg(F.collect_set(F.struct("p", "lo", "hi")).alias("found"))
    per_text = per_text.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "found")
    joined = rows.join(per_text, rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["row"] == F.col("_row")))
    return joined.select("doc_id", "row", "text", "found").mapInArrow(
        run, f"region long, doc_id {_key_type(rows)}, row long, p int, lo int, hi int, begin int, size int, bytes binary")


def _parts(region: tuple, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(lo, hi, core, hull) of the parts of a block that lie on a grid before its anchor."""
    _, p, lo, hi, begin, size, data = region
    hashed, other = _hasher(0, len(data)), _hasher(1, len(data))
    bytes_ = np.frombuffer(data, np.uint8)
    sums, more = hashed.sums(bytes_), other.sums(bytes_)
    part = np.arange((p - hi) // GRID, (p - lo) // GRID + 1)
    last = p - part * GRID  # the part's windows start from last - GRID + 1 to last
    first = last - GRID + 1
    core = hashed.of(sums, last - begin, first + length - begin) ^ (part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    inside = (first >= 0) & (last + length <= size)
    hull = np.where(inside, other.of(more, np.maximum(first, begin) - begin, np.minimum(last + length, begin + len(data)) - begin), np.uint64(0))
    yield from zip(np.maximum(first, lo).tolist(), np.minimum(last, hi).tolist(), core.view(np.int64).tolist(),
                   hull.view(np.int64).tolist(), inside.tolist(), strict=True)


def _fine(regions: DataFrame, length: int) -> DataFrame:
    """(core, hull, piece) of the parts; a hull that would pass an end of the text is like no other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(n).to_pylist() for n in ("region", "p", "lo", "hi", "begin", "size", "bytes")]
            for region in zip(*columns, strict=True):
                for lo, hi, core, hull, inside in _parts(region, length):
                    out.append((core, hull if inside else region[0] * 4099 + lo, {"region": region[0], "lo": lo, "hi": hi, "open": not inside}))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], ["core", "hull", "piece"])

    piece = pa.struct([("region", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("open", pa.bool_())])
    types = [pa.int64(), pa.int64(), piece]
    return regions.select("region", "p", "lo", "hi", "begin", "size", "bytes").mapInArrow(
        run, "core long, hull long, piece struct<region: long, lo: int, hi: int, open: boolean>")


def _single(regions: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """(core, hull, piece) of the single windows of chosen parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for region, begin, data, found in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                bytes_ = np.frombuffer(data, np.uint8)
                at = np.concatenate([np.arange(f["lo"], f["hi"] + 1) for f in found]) - begin
                core, hull = (h.of(h.sums(bytes_), at, at + length).view(np.int64) for h in (_hasher(0, len(data)), _hasher(1, len(data))))
                place = pa.array(at + begin, pa.int32())
                piece = pa.StructArray.from_arrays([pa.array([region] * len(at), pa.int64()), place, place], ["region", "lo", "hi"])
                yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(hull), piece], ["core", "hull", "piece"])

    per_region = chosen.groupBy("region").agg(F.collect_set(F.struct("lo", "hi")).alias("found"))
    return regions.join(per_region, "region").select("region", "begin", "bytes", "found").mapInArrow(
        run, "core long, hull long, piece struct<region: long, lo: int, hi: int>")


def repeated_spans(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, lo, hi): ranges of places at which a repeated string of ``length`` bytes starts."""
    if length < GRAM + GRID:
        raise ValueError(f"repeats must have {GRAM + GRID} bytes or more")
    spark, rows = docs.sparkSession, _rows(docs, id_col, text_col)
    anchors = written(anchor_suffixes(rows, length))
    again = repeated_anchors(spark, anchors, batches)
    found = written(anchors.join(again, ["head", "gram"], "left_semi").select(
        "doc_id", "row", "lo", "hi", F.col("gram").alias("core"), "hull", "p"))
    dropped(anchors)
    whole, chosen = _judged(found.withColumn("piece", F.struct("doc_id", "row", "p", "lo", "hi")))
    regions = written(_regions(rows, chosen, length))
    parts = written(_fine(regions, length))
    settled, unsettled = _judged(parts)
    windows = written(_single(regions, unsettled, length))
    place = regions.select("region", "doc_id", "row")
    alike = written(windows.groupBy("core", "hull").agg(F.count("*").alias("n")).where("n > 1").select("core", "hull"))
    fine = [p.join(keys, ["core", "hull"], "left_semi").select("piece.region", "piece.lo", "piece.hi")
            for p, keys in ((parts, settled), (windows, alike))]
    fine = place.join(fine[0].union(fine[1]), "region").select("doc_id", "row", "lo", "hi")
    return found.join(whole, ["core", "hull"], "left_semi").select("doc_id", "row", "lo", "hi").union(fine)


def _merged(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by strings that start in the given ranges."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(starts):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi + length))
        else:
            out.append((lo, hi + length))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, row, n_bytes, kept, spans) for every row: the bytes that stay, and the removed [begin, end) ranges.

    Columns named in ``carry`` come along unchanged.

    Every byte covered by a string of ``length`` bytes that starts anywhere else too is removed, in every document
    and judged on the input. Null texts are empty. Texts shorter than ``length`` stay whole. Repeated rows
    of ``length`` bytes or more lose everything; an empty table gives no rows.
    """
    rows = _rows(docs, id_col, text_col, carry)
    spans = repeated_spans(docs, length, batches, id_col, text_col).groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
    spans = spans.agg(F.collect_set(F.struct("lo", "hi")).alias("starts"))
    joined = rows.join(spans, rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["row"] == F.col("_row")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            sizes, kept, spans = [], [], []
            for text, found in zip(texts, starts, strict=True):
                cut = _merged([(f["lo"], f["hi"]) for f in found or []], length)
                ends = [0, *(e for _, e in cut)]
                sizes.append(len(text))
                kept.append(b"".join(text[e:b] for e, b in zip(ends, [*(b for b, _ in cut), len(text)], strict=True)))
                spans.append([{"begin": b, "end": e} for b, e in cut])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()),
                                              pa.array(spans, span), *batch.columns[4:]], names)

    names = ["doc_id", "row", "n_bytes", "kept", "spans", *carry]
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return joined.select("doc_id", "row", "text", "starts", *[f"with_{c}" for c in carry]).mapInArrow(
        run, f"doc_id {_key_type(rows)}, row long, n_bytes long, kept binary, spans array<struct<begin: long, end: long>>{kinds}")
