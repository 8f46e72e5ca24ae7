"""Near-duplicates by fast similarity sketching.

A sketch has SIZE coordinates. In each round every shingle of the set is thrown into one coordinate by the round's hash,
with the round's number and a hash as its value; a coordinate keeps its least value. Rounds go on until every
coordinate is filled, which takes about SIZE * ln(SIZE) / n of them. Round SIZE + i throws all shingles into
coordinate i, so 2 * SIZE rounds fill a sketch of any set that isn't empty. Sets of similarity s agree in a coordinate
with probability s, and the count of agreements is concentrated as if coordinates were independent.

BANDS bands of ROWS coordinates name the buckets. Sets that meet in a bucket are compared by their full shingle sets, first
each with the member that it meets most often, then, between groups that are not linked yet, all that could
reach the threshold by their sketches, block against block, the likely ones first. Only sets that have such a pair travel,
once for each cell of blocks; the pairs themselves are never rows.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from basketloom.llm.columns import dropped, written
from basketloom.llm.components import components
from basketloom.llm.url_filter import possibly_listed

SHINGLE = 4
PERCENT = 80
SIZE = 512
#: The first coordinates make the bands. A pair at a similarity of 0.8 shares no bucket with probability (1 - 0.8^4)^32, 5 in 100 million.
ROWS, BANDS = 4, 32
#: Standard deviations below the mean of the equal coordinates of a pair at the threshold from which pairs are not
#: compared by their full sets; so few are equal in 3 of 10 million such pairs.
DEVIATIONS = 5
#: Members of a block in the comparison of sketches.
BLOCK = 512
#: Shingles of a block, 2 MB of hashes; a longer text is a block of few.
BLOCK_SHINGLES = 1 << 18
#: Words whose hashes a worker remembers.
MEMO = 1 << 19
#: Hashed shingles of texts that are sketched at once.
SLICE = 1 << 18
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class WordHashes(dict):
    """64-bit hashes of words, each worked out once while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = value = xxh64_intdigest(word)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: bytes | None, hashes: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words make one shingle, no word makes none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(words) < shingle:
        return np.array([xxh64_intdigest(b" ".join(words), len(words))], np.uint64)
    mixed = np.zeros(len(words) - shingle + 1, np.uint64)
    for k in range(shingle):
        # The order of the words counts: every place has its own factor and the sum is mixed again.
        mixed = _mixed(mixed + each[k : k + len(mixed)] * _ODD[k % len(_ODD)])
    return np.unique(mixed)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of SIZE values for each set that isn't empty; equal values stand for the same shingle in the same round."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full(len(sets) * SIZE, np.iinfo(np.uint64).max, np.uint64)
    owner, items = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    for turn in range(2 * SIZE):
        if not len(items):
            break
        mixed = _mixed(items + _ODD[:1] * np.uint64(turn + 1))
        bins = (mixed & np.uint64(SIZE - 1)).astype(np.int64) if turn < SIZE else np.full(len(items), turn - SIZE)
        value = (np.uint64(turn) << np.uint64(56)) | (mixed >> np.uint64(8))
        np.minimum.at(out, owner * SIZE + bins, value)
        open_ = (out.reshape(-1, SIZE) == np.iinfo(np.uint64).max).any(axis=1)
        left = open_[owner]
        owner, items = owner[left], items[left]
    return out.reshape(-1, SIZE)


def fewest_equal(percent: int) -> int:
    """Equal coordinates that a pair must have to be compared by its full sets."""
    return int(SIZE * percent / 100 - DEVIATIONS * math.sqrt(SIZE * percent / 100 * (1 - percent / 100)))


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """(sets, BANDS) bucket names: the hash of a band's values and its number."""
    rows, keys = sketch[:, : ROWS * BANDS].reshape(-1, BANDS, ROWS), np.zeros((len(sketch), BANDS), np.uint64)
    for k in range(ROWS):
        keys = _mixed(keys * _ODD[1] + rows[:, :, k] + _ODD[2])
    return _mixed(keys + np.arange(BANDS, dtype=np.uint64) * _ODD[3])


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col].cast("binary"), F.lit(b""))
    return docs.select(docs[id_col].alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def signatures(rows: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_key, bands, bytes): 128 bits of the whole set, its buckets and a byte a coordinate.

    An empty set has null key, buckets and bytes.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            part, size, begin = [], 0, 0
            texts = batch.column(2)
            for i in range(len(texts)):
                part.append(shingle_set(texts[i].as_py(), hashes, shingle))
                size += len(part[-1])
                if size >= SLICE or i + 1 == len(texts):
                    yield _signed(batch.slice(begin, len(part)), part)
                    part, size, begin = [], 0, i + 1

    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, n_shingles long, set_key binary, bands array<long>, bytes binary")


def _signed(batch: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
    full = [s for s in sets if len(s)]
    made = sketches(full)
    bands = iter(band_keys(made).view(np.int64).tolist())
    low = _mixed(made).astype(np.uint8)
    low = iter([row.tobytes() for row in low])
    keys = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
    return pa.RecordBatch.from_arrays([
        batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
        pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
        pa.array([next(low) if len(s) else None for s in sets], pa.binary())],
        ["doc_id", "text_hash", "n_shingles", "set_key", "bands", "bytes"])


def _possible_rows(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose text has a wanted hash, and few others: a Bloom filter goes to the texts, so that no other text is shuffled."""
    keys = wanted.select(F.col("_hash").alias("text_hash"))
    return possibly_listed(rows, "text_hash", keys).where("possible").drop("possible")


def _wanted_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(vertex, text) of the wanted rows (vertex, _id, _hash)."""
    near = _possible_rows(rows, wanted)
    return near.join(wanted, (near["text_hash"] == wanted["_hash"]) & near["doc_id"].eqNullSafe(wanted["_id"])).select("vertex", "text")


def _confirmed(edges: DataFrame, sets: DataFrame, rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of the edges (a, b) whose full sets are similar enough."""
    ends = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct()
    wanted = written(sets.join(ends, sets["vertex"] == ends["v"], "left_semi").select(
        "vertex", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))
    # A set stands for one of its texts; rows of the same id and text are one.
    texts = written(_wanted_texts(rows, wanted).dropDuplicates(["vertex"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, recent = WordHashes(), OrderedDict()
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ok = []
            for i in range(len(a)):
                if b[i] not in recent:
                    if len(recent) >= 64:
                        recent.popitem(last=False)
                    recent[b[i]] = shingle_set(batch.column(3)[i].as_py(), hashes, shingle)
                one, other = shingle_set(batch.column(2)[i].as_py(), hashes, shingle), recent[b[i]]
                both = len(np.intersect1d(one, other, assume_unique=True))
                ok.append(100 * both >= percent * (len(one) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    first = edges.join(texts.select(F.col("vertex").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(texts.select(F.col("vertex").alias("b"), F.col("text").alias("text_b")), "b")
    out = written(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"))
    dropped(wanted)
    dropped(texts)
    return out


def _shared_buckets(sets: DataFrame) -> DataFrame:
    """(bucket, vertex, n_shingles) of the buckets with more than one member; the others, nearly all, link nothing."""
    every = sets.select("vertex", "n_shingles", F.explode("bands").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return written(every.join(shared, "bucket", "left_semi"))


def _first_edges(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each member of a bucket with the bucket's smallest member; of several, the one that it meets most often.

    Pairs whose sketches exclude a link are left out.
    """
    centres = buckets.groupBy("bucket").agg(F.min("vertex").alias("b"))
    met = buckets.join(centres, "bucket").where("vertex <> b").groupBy(F.col("vertex").alias("a"), "b").agg(F.count("*").alias("n"))
    best = met.groupBy("a").agg(F.max(F.struct("n", (-F.col("b")).alias("b"))).alias("best"))
    edges = written(best.select("a", (-F.col("best.b")).alias("b")))
    ends = written(edges.select(F.col("a").alias("vertex")).union(edges.select("b")).distinct())
    sketched = written(sets.join(ends, "vertex", "left_semi").select("vertex", "bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SIZE) for i in (2, 3))
            open_ = np.count_nonzero(one == two, axis=1) >= fewest
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(open_))

    fewest = fewest_equal(percent)
    both = edges.join(sketched.toDF("a", "bytes_a"), "a").join(sketched.toDF("b", "bytes_b"), "b")
    out = written(both.select("a", "b", "bytes_a", "bytes_b").mapInArrow(run, "a long, b long"))
    for table in (edges, ends, sketched):
        dropped(table)
    return out


def _cells(buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """(bucket, low, high, block, grp, vertex): members of buckets of several groups, cut into blocks; each block meets each in a cell of its own."""
    named = buckets.join(groups, "vertex")
    mixed = named.groupBy("bucket").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"), F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    blocks = mixed.where("lo <> hi").select("bucket", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = written(named.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int")))
    around = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return around.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "grp", "vertex")


def _together(cells: DataFrame) -> DataFrame:
    """Rows of a cell one after the other in one partition."""
    return cells.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "vertex")


def _each_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of one cell at a time; a cell may go on over batches."""
    rest: dict[str, np.ndarray] = {}
    for batch in batches:
        new = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            if name == "bytes":
                new[name] = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SIZE)
            elif name == "bands":
                new[name] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
            else:
                new[name] = column.to_numpy(zero_copy_only=False)
        if rest:
            new = {name: np.concatenate((rest[name], new[name])) for name in new}
        keys = [new[name] for name in ("bucket", "low", "high")]
        starts = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]) if len(keys[0]) else np.zeros(1, np.int64)
        for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            yield {name: values[begin:end] for name, values in new.items()}
        rest = {name: values[starts[-1] :] for name, values in new.items()}
    if rest and len(rest["bucket"]):
        yield rest


def _open_pairs(cell: dict[str, np.ndarray], grp: np.ndarray, least: int, most: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each member with those of other groups that sizes and sketches (least <= equal coordinates < most) leave open.

    A pair belongs to the first bucket that it shares, so that no other cell has it. ``grp`` may change between the members.
    """
    low, high, bucket = cell["low"][0], cell["high"][0], cell["bucket"][0]
    vertex, n, sketch, bands = cell["vertex"], cell["n_shingles"], cell["bytes"], cell["bands"]
    two = np.flatnonzero(cell["block"] == high)
    for i in np.flatnonzero(cell["block"] == low).tolist():
        js = two[(grp[two] != grp[i]) & ((vertex[two] > vertex[i]) | (low != high))]
        js = js[100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i])]
        if len(js):
            equal = np.count_nonzero(sketch[js] == sketch[i], axis=1)
            js = js[(equal >= least) & (equal < most)]
            js = js[bands[i][(bands[js] == bands[i]).argmax(axis=1)] == bucket]
        if len(js):
            yield i, js


def shared_counts(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of a sorted set with each of the others; none is empty."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    return np.add.reduceat((one[at] == flat).astype(np.int64), np.cumsum([0, *map(len, others[:-1])]))


def _links(buckets: DataFrame, sets: DataFrame, groups: DataFrame, rows: DataFrame, shingle: int, percent: int, least: int, most: int) -> DataFrame:
    """(a, b): links between groups among the pairs of a bucket with ``least`` to ``most`` - 1 equal coordinates, by full sets.

    Enough of them to connect all that are linked. Pairs are never rows: a first pass over sketches names the members of
    each cell that have an open pair, a second one has their full sets beside them and gives links only.
    """
    sketched = sets.select("vertex", "n_shingles", "bytes", "bands")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _each_cell(batches):
            found = [np.append(js, i) for i, js in _open_pairs(cell, cell["grp"], least, most, percent)]
            if found:
                at = np.unique(np.concatenate(found))
                yield pa.RecordBatch.from_arrays([pa.array(cell[name][at]) for name in names], names)

    names = ["bucket", "low", "high", "block", "grp", "vertex"]
    wanted = written(_together(_cells(buckets, groups).join(sketched, "vertex")).select(*names, "n_shingles", "bytes", "bands").mapInArrow(
        members, "bucket long, low int, high int, block int, grp long, vertex long"))
    full = _full_sets(wanted.select("vertex").distinct(), sets, rows, shingle)

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _each_cell(batches):
            grp, a, b = cell["grp"].copy(), [], []
            each = [np.frombuffer(s, np.uint64) for s in cell["hashes"]]
            for i, js in _open_pairs(cell, grp, least, most, percent):
                both = shared_counts(each[i], [each[j] for j in js])
                for j in js[100 * both >= percent * (len(each[i]) + cell["n_shingles"][js] - both)].tolist():
                    # What a link of this cell has brought together needs no other link.
                    if grp[j] != grp[i]:
                        grp[grp == grp[j]] = grp[i]
                        a.append(max(cell["vertex"][i], cell["vertex"][j]))
                        b.append(min(cell["vertex"][i], cell["vertex"][j]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    cells = _together(wanted.join(sketched, "vertex").join(full, "vertex"))
    out = written(cells.select(*names, "n_shingles", "bytes", "bands", "hashes").mapInArrow(confirmed, "a long, b long"))
    dropped(wanted)
    dropped(full)
    return out


def _full_sets(ends: DataFrame, sets: DataFrame, rows: DataFrame, shingle: int) -> DataFrame:
    """(vertex, hashes): the sorted shingle hashes of the wanted sets."""
    wanted = written(sets.join(ends, "vertex", "left_semi").select(
        "vertex", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            made = pa.array([shingle_set(t.as_py(), hashes, shingle).tobytes() for t in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["vertex", "hashes"])

    return written(_wanted_texts(rows, wanted).mapInArrow(run, "vertex long, hashes binary").dropDuplicates(["vertex"]))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. Sets of distinct ``shingle``-word shingles are linked if
    100 * intersection >= ``percent`` * union. ``component_id`` is the smallest doc_id reachable, ``kept`` whether it is the row's own.
    Fewer words make one shingle; null, empty and blank texts have no set and are linked with nothing. Rows of equal id are
    judged each by its own text; a row without an id is linked like any other but names no component: its component_id
    is null if no linked row has an id, and it is kept then. Extra columns are ignored; an empty table gives no
    rows. Shingles count as equal by 64-bit hashes.
    """
    if percent < 50:
        raise ValueError("the bands are made for a similarity of one half or more")
    rows = _documents(docs, id_col, text_col)
    each = written(signatures(rows, shingle))
    full = each.where("set_key is not null")
    sets = full.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("own"), F.min("doc_id").alias("least"),
                                       F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("bytes").alias("bytes"))
    sets = written(sets.select(F.monotonically_increasing_id().alias("vertex"), "set_key", "own.doc_id", "own.text_hash", "least",
                               "n_shingles", "bands", "bytes"))
    buckets = _shared_buckets(sets)
    linked = _confirmed(_first_edges(buckets, sets, percent), sets, rows, shingle, percent)
    groups = _groups(sets, linked)
    # Pairs that are likely links come first; most of the others lie inside the groups that these make.
    likely = SIZE * percent // 100
    for least, most in ((likely, SIZE + 1), (fewest_equal(percent), likely)):
        more = _links(buckets, sets, groups, rows, shingle, percent, least, most)
        if not more.isEmpty():
            linked = linked.union(more)
            groups = _groups(sets, linked)
    dropped(buckets)
    smallest = groups.join(sets.select("vertex", "least"), "vertex")
    smallest = smallest.groupBy("grp").agg(F.min("least").alias("component_id"))
    named = written(sets.join(groups.join(smallest, "grp"), "vertex").select(F.col("set_key").alias("_key"), "component_id"))
    found = each.join(named, each["set_key"] == named["_key"], "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = found.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def _groups(sets: DataFrame, linked: DataFrame) -> DataFrame:
    """(vertex, grp): the smallest vertex reachable."""
    found = components(linked)
    return written(sets.select("vertex").join(found, sets["vertex"] == found["id"], "left").select(
        "vertex", F.coalesce("component", "vertex").alias("grp")))
