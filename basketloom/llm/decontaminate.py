"""Benchmark decontamination by the q-gram lemma and banded alignment.

Benchmark items are cut into overlapping windows of characters. If a region of a document is within ``edits`` of a
window of m characters, it shares at least m + 1 - q * (edits + 1) of its q-grams, all on neighbouring diagonals
(place in the document less place in the window). Shared q-grams are counted in overlapping bands of diagonals;
bands that reach the bound are verified by an alignment inside the band. Case and white space don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.columns import id_and_bytes, written

Q = 12
WINDOW = 96
STEP = 32
#: One edit is allowed for so many characters of a window.
CHARS_PER_EDIT = 19
#: Shorter items have no q-gram and are no passages.
MIN_CHARS = Q
#: Items of fewer characters are looked for word for word, without edits.
EXACT_BELOW = 24
#: Windows that are searched for at once: the index of a block takes about 30 MB in each worker.
BLOCK_WINDOWS = 50_000
BASE = np.uint64(0x9E3779B97F4A7C15)
POWERS = [np.uint64(pow(int(BASE), i, 1 << 64)) for i in range(Q)]
#: Characters of text that are searched at once, and what stands between two texts: more than any edit budget.
SLICE = 1 << 20
BETWEEN = "\0" * 16
BITMAP_BITS = 22


def normal(text: bytes | None) -> str:
    return " ".join((text or b"").decode("utf-8", "replace").lower().split())


def edit_budget(size: int) -> int:
    return size // CHARS_PER_EDIT if size >= EXACT_BELOW else 0


def _between_words(text: str, begin: int, end: int) -> bool:
    """Whether the part neither begins nor ends inside a word."""
    return not (text[max(0, begin - 1) : begin].isalnum() and text[begin].isalnum()) and not (
        text[end : end + 1].isalnum() and text[end - 1].isalnum())


def needed(size: int) -> int:
    """Shared q-grams that a region within the edit budget must have; at least one."""
    return max(1, size + 1 - Q * (edit_budget(size) + 1))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def _grams(points: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the Q characters from each place on, put together from those of 2 and 4."""
    if len(points) < Q:
        return np.zeros(0, np.uint64)
    single = points.astype(np.uint64)
    two = single[:-1] * BASE + single[1:]
    four = two[:-2] * POWERS[2] + two[2:]
    value = four[:-8] * POWERS[8] + four[4:-4] * POWERS[4] + four[8:]
    return value ^ (value >> np.uint64(29))


def banded_distance(pattern: np.ndarray, text: np.ndarray, limit: int) -> tuple[int, int, int] | None:
    """(edits, begin, end) of the part of ``text`` nearest to ``pattern``; None beyond ``limit``.

    Row by row over the pattern, on all diagonals of the region, which is a band's width longer than the pattern.
    The earliest end of the fewest edits is taken.
    """
    width = len(text) - len(pattern) + 2 * limit + 1  # diagonals -limit .. len(text) - len(pattern) + limit
    far, steps = len(pattern) + limit + 1, np.arange(max(1, width))
    if width < 1:
        return None
    shift = steps - limit
    cost, begin = np.where(shift >= 0, 0, far), np.maximum(shift, 0)
    for i, char in enumerate(pattern):
        at = shift + i
        inside = (at >= 0) & (at < len(text))
        same = inside & (text[np.clip(at, 0, len(text) - 1)] == char)
        # A pattern character is met, replaced or left out.
        met = np.where(inside, cost + ~same, far)
        out = np.append(cost[1:] + 1, far)
        new_begin = np.where(out < met, np.append(begin[1:], 0), begin)
        new = np.where(at < len(text), np.minimum(met, out), far)
        # Text characters are left out: the best of the diagonals before, one edit for each step.
        best = np.minimum.accumulate(new - steps)
        moved = best + steps
        source = np.maximum.accumulate(np.where(new - steps == best, steps, 0))
        begin = np.where(moved < new, new_begin[source], new_begin)
        cost = np.where(at < len(text), np.minimum(new, moved), far)
    best = int(cost.argmin())
    end = best - limit + len(pattern)
    return (int(cost[best]), int(begin[best]), end) if cost[best] <= limit else None


@dataclass
class WindowIndex:
    """q-grams of a block of windows: sorted hashes and, for each, the windows and places where they stand."""

    windows: list[tuple]

    def start(self) -> None:
        self.points = [_points(w[-1]) for w in self.windows]
        grams = [_grams(p) for p in self.points]
        window = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, np.int64)])
        flat = np.concatenate(grams or [np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.window, self.place = window[order], place[order]
        self.keys, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.needed = np.array([needed(len(p)) for p in self.points])
        self.bitmap = np.zeros(1 << BITMAP_BITS, bool)
        self.bitmap[(self.keys >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)] = True
        self.least, self.longest = int(self.needed.min(initial=1)), max(map(len, self.points), default=0)

    def _hits(self, grams: np.ndarray) -> np.ndarray:
        """Places of the grams that are in the index and lie as densely as the smallest bound asks."""
        at = np.flatnonzero(self.bitmap[(grams >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)])
        at = at[self.keys[np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)] == grams[at]] if len(at) else at
        if len(at) < self.least:
            return at[:0]
        reach = self.longest + edit_budget(self.longest)
        dense = np.flatnonzero(at[self.least - 1 :] - at[: len(at) - self.least + 1] <= reach)
        change = np.zeros(len(at) + 1, np.int64)
        np.add.at(change, dense, 1)
        np.add.at(change, dense + self.least, -1)
        return at[np.cumsum(change)[:-1] > 0]

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(window, begin, end, edits) of the best region of each band that holds."""
        points = _points(text)
        grams = _grams(points)
        at = self._hits(grams)
        if not len(at):
            return []
        key = np.searchsorted(self.keys, grams[at])
        count = self.count[key]
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        occurrence = np.repeat(self.first[key], count) + inner
        window, place = self.window[occurrence], self.place[occurrence]
        diagonal = np.repeat(at, count) - place
        return self._verified(text, points, window, place, np.repeat(at, count) - place)

    def _verified(self, text: str, points: np.ndarray, window: np.ndarray, place: np.ndarray, diagonal: np.ndarray):
        half, found = edit_budget(self.longest) + 1, {}
        # Two rows of bands, each band two halves wide, one row half a band beside the other: the diagonals of a match
        # span less than a half, so one band has them all.
        for shift in (0, half):
            band = (diagonal + self.longest + shift) // (2 * half)
            shared = np.unique(np.stack((window, band, place)), axis=1)
            pairs, sizes = np.unique(shared[:2], axis=1, return_counts=True)
            for w, b in pairs[:, sizes >= self.needed[pairs[0]]].T.tolist():
                first = b * 2 * half - self.longest - shift
                limit, pattern = edit_budget(len(self.points[w])), self.points[w]
                begin, end = max(0, first - limit), first + 2 * half + len(pattern) + limit
                if len(pattern) < EXACT_BELOW:
                    at = text.find(self.windows[w][-1], begin, end)
                    while at >= 0:
                        if _between_words(text, at, at + len(pattern)):
                            found[w, at] = (at, at + len(pattern), 0)
                        at = text.find(self.windows[w][-1], at + 1, end)
                elif (at := text.find(self.windows[w][-1], begin, end)) >= 0:
                    found[w, at] = (at, at + len(pattern), 0)
                elif near := banded_distance(pattern, points[begin:end], limit):
                    found[w, begin + near[1]] = (begin + near[1], begin + near[2], near[0])
        return [(w, *v) for (w, _), v in found.items()]


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, at, text): windows of WINDOW characters every STEP characters, the last one at the item's end."""
    rows = id_and_bytes(benchmark, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(map(normal, batch.column(1).to_pylist())):
                if len(text) < MIN_CHARS:
                    continue
                last = max(0, len(text) - WINDOW)
                at = [*range(0, last, STEP), last]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(at))), pa.array(at, pa.int32()),
                                                  pa.array([text[x : x + WINDOW] for x in at], pa.string())], ["item_id", "at", "text"])

    return rows.mapInArrow(run, f"item_id {rows.schema['doc_id'].dataType.simpleString()}, at int, text string")


def _slices(texts: list[bytes | None]) -> Iterator[tuple[int, list[str]]]:
    part, size = [], 0
    for i, text in enumerate(texts):
        part.append(normal(text))
        size += len(part[-1])
        if size >= SLICE or i + 1 == len(texts):
            yield i + 1 - len(part), part
            part, size = [], 0


def _found(docs: DataFrame, block: list[tuple], item_type: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(WindowIndex(block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        if not hasattr(index, "keys"):
            index.start()
        for batch in batches:
            out, at = [], []
            for first, texts in _slices(batch.column(1).to_pylist()):
                starts = np.cumsum([0] + [len(t) + len(BETWEEN) for t in texts])
                for w, begin, end, edits in index.search(BETWEEN.join(texts)):
                    # Edits at an end of a text may reach into what stands between two texts; the middle of a region never does.
                    i = int(np.searchsorted(starts, (begin + end) // 2, "right")) - 1
                    at.append(first + i)
                    begin, end = max(0, begin - int(starts[i])), min(len(texts[i]), end - int(starts[i]))
                    out.append((*index.windows[w][:2], begin, end, edits))
            columns = [pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 5, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns],
                                             ["doc_id", "item_id", "at", "begin", "end", "edits"])

    types = [{"bigint": pa.int64(), "int": pa.int32()}.get(item_type, pa.string()), *[pa.int32()] * 4]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, item_id {item_type}, at int, begin int, end int, edits int")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, item_id, n_windows, begin, end, edits) for each pair of a document and an item that it has a passage of.

    ``n_windows``: windows of the item that were found; ``begin`` and ``end``: the first and last character of found
    regions in the lower-cased text with single blanks; ``edits``: the fewest of a window. Items below EXACT_BELOW
    characters are found as whole words without edits. Null and empty texts and items below MIN_CHARS characters have no passages; equal ids are reported as one; an empty table gives no rows.
    The benchmark is the query set: it is searched for in blocks of bounded size, whatever its own size.
    """
    windows = written(benchmark_windows(benchmark, item_col, item_text_col))
    blocks = max(1, -(-windows.count() // block_windows))
    number, rows, found = F.pmod(F.xxhash64("item_id", "at"), F.lit(blocks)), id_and_bytes(docs, id_col, text_col), None
    item_type = windows.schema["item_id"].dataType.simpleString()
    for i in range(blocks):
        # About ``block_windows`` rows of at most WINDOW characters.
        block = [tuple(r) for r in windows.where(number == i).orderBy("item_id", "at").collect()]
        part = _found(rows, block, item_type)
        found = part if found is None else found.union(part)
    return found.groupBy("doc_id", "item_id").agg(
        F.countDistinct("at").alias("n_windows"), F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("edits").alias("edits"))
