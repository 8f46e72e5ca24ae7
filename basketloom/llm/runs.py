"""Periodic runs of words by recompression.

Runs are looked for on a harmonic grid: a run of period q that goes on for four periods or more has the same word at four
successive multiples of q, so for every q only the places 0, q, 2q, ... are compared, n + n/2 + n/3 + ... in all.
Texts with such a place are compressed to a run-length grammar: rounds of block compression (equal neighbours become
one symbol) alternate with rounds of pair compression (neighbours of two halves of the alphabet become one). Both
depend on the symbols alone, so equal stretches are parsed alike but for their ends, and a common extension is found by
going up the grammar while symbols agree and down where they differ, a few steps a level. The extensions of a
candidate to both sides are exact; no suffix array is built.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from basketloom.llm.columns import id_and_bytes

MIN_LENGTH = 6
MIN_PERIODS = 4
#: Words that are searched at once; a longer text is searched by itself.
SLICE = 1 << 19
#: Candidates that are extended at once.
CHUNK = 1 << 18
#: Symbols at which compression ends.
FEW = 64

Run = tuple[int, int, int]


@dataclass
class Level:
    """One row of the grammar: symbols, how far the same symbol goes on to the right and to the left (itself included;
    1 where pairs are formed), the parent of every symbol and the first and last child of every parent."""

    symbols: np.ndarray
    right: np.ndarray
    left: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _blocks(symbols: np.ndarray) -> tuple[Level, np.ndarray]:
    """Equal neighbours become one symbol for (symbol, length)."""
    n = len(symbols)
    first = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
    last = np.append(first[1:], n) - 1
    size = last - first + 1
    parent = np.repeat(np.arange(len(first)), size)
    at = np.arange(n)
    level = Level(symbols, last[parent] - at + 1, at - first[parent] + 1, parent, first, last)
    return level, _named(symbols[first], size)


def _pairs(symbols: np.ndarray, seed: int) -> tuple[Level, np.ndarray]:
    """A symbol of one half of the alphabet and a right neighbour of the other half become one symbol.

    Halves come from a hash of the symbol and the round; of the two directions that with more pairs is taken.
    """
    n = len(symbols)
    mixed = (symbols.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    half = (mixed >> np.uint64(63)).astype(bool)
    ways = [half[:-1] & ~half[1:], ~half[:-1] & half[1:]]
    joined = ways[0] if ways[0].sum() >= ways[1].sum() else ways[1]
    first = np.flatnonzero(np.append(True, ~joined))
    last = np.append(first[1:], n) - 1
    parent = np.repeat(np.arange(len(first)), last - first + 1)
    one = np.ones(n, np.int64)
    second = np.where(last > first, symbols[last] + 1, 0)
    return Level(symbols, one, one, parent, first, last), _named(symbols[first], second)


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense names; equal names are equal (a, b)."""
    return pd.factorize(a * (int(b.max(initial=0)) + 1) + b)[0].astype(np.int64)


def grammar(words: np.ndarray) -> list[Level]:
    """Levels from the words up, blocks and pairs in turn; the last level has at most FEW symbols and no parents."""
    levels, symbols = [], words.astype(np.int64)
    while len(symbols) > FEW:
        level, symbols = _pairs(symbols, len(levels)) if len(levels) % 2 else _blocks(symbols)
        levels.append(level)
    none = np.zeros(0, np.int64)
    one = np.ones(len(symbols), np.int64)
    return [*levels, Level(symbols, one, one, none, none, none)]


def extensions(levels: list[Level], x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
    """Length of the longest common extension of the places x and y (x < y), to the right or to the left.

    The words must begin and end with symbols that occur nowhere else, so that no extension leaves them.
    """
    x, y, start = x.astype(np.int64), y.astype(np.int64), x.astype(np.int64)
    stopped = np.full(len(x), len(levels) - 1)
    going = np.arange(len(x))
    for at, level in enumerate(levels):
        top, climbed = at == len(levels) - 1, []
        edge, step = (level.first, level.right) if forward else (level.last, level.left)
        while len(going):
            if not top:
                up = (edge[level.parent[x[going]]] == x[going]) & (edge[level.parent[y[going]]] == y[going])
                climbed.append(going[up])
                going = going[~up]
            same = level.symbols[x[going]] == level.symbols[y[going]]
            stopped[going[~same]] = at
            going = going[same]
            _advance(x, y, going, step, forward)
        if climbed:
            going = np.concatenate(climbed)
            x[going], y[going] = level.parent[x[going]], level.parent[y[going]]
    for at in range(len(levels) - 1, -1, -1):
        level = levels[at]
        here = np.flatnonzero(stopped >= at)
        if at < len(levels) - 1:
            down = here[stopped[here] > at]
            edge = level.first if forward else level.last
            x[down], y[down] = edge[x[down]], edge[y[down]]
            stopped[down] = at
        while len(here):
            here = here[level.symbols[x[here]] == level.symbols[y[here]]]
            _advance(x, y, here, level.right if forward else level.left, forward)
    return x - start if forward else start - x


def _advance(x: np.ndarray, y: np.ndarray, at: np.ndarray, step: np.ndarray, forward: bool) -> None:
    by = np.minimum(step[x[at]], step[y[at]])
    x[at] += by if forward else -by
    y[at] += by if forward else -by


def _grid(words: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(q, places i) whose words at i, i + q, i + 2q, i + 3q are equal, i a multiple of q.

    ``sizes``: lengths of the texts in ``words``, the longest first; only those of four periods are compared.
    """
    ends = np.cumsum(sizes)
    for q in range(1, int(sizes.max(initial=0)) // MIN_PERIODS + 1):
        grid = words[: ends[np.searchsorted(-sizes, -MIN_PERIODS * q, side="right") - 1] : q]
        again = grid[1:] == grid[:-1]
        j = np.flatnonzero(again[2:] & again[1:-1] & again[:-2])
        if len(j):
            yield q, j * q


def _extended(levels: list[Level], at: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the longest stretch of period q around the places ``at``, which equal those at at + q."""
    starts, sizes = [], []
    for k in range(0, len(at), CHUNK):
        here, period = at[k : k + CHUNK], q[k : k + CHUNK]
        back = extensions(levels, here - 1, here + period - 1, False)
        starts.append(here - back)
        sizes.append(back + period + extensions(levels, here, here + period, True))
    return np.concatenate(starts), np.concatenate(sizes)


def _stretches(levels: list[Level], doc: np.ndarray, at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Rows (doc, start, length, q) of the stretches around the candidates, by q, that are long enough for a run.

    Successive places of the grid mostly lie in one stretch: the first is extended, and those inside its stretch are done.
    """
    order = np.lexsort((at, q))
    doc, at, q = doc[order], at[order], q[order]
    rows = []
    for heads_only in (True, True, False):
        if not len(at):
            break
        chain = np.append(True, (q[1:] != q[:-1]) | (at[1:] != at[:-1] + q[1:])) if heads_only else np.ones(len(at), bool)
        start, size = _extended(levels, at[chain], q[chain])
        own = q[chain]
        ok = size >= np.maximum(MIN_LENGTH, MIN_PERIODS * own)
        rows.append(np.stack([doc[chain][ok], start[ok], size[ok], own[ok]], 1))
        inside = at < (start + size)[np.cumsum(chain) - 1] - q
        doc, at, q = doc[~inside], at[~inside], q[~inside]
    found = np.unique(np.concatenate(rows), axis=0)
    return found[np.argsort(found[:, 3], kind="stable")]


def find_runs(texts: list[np.ndarray]) -> list[list[Run]]:
    """(start, length, period) of the runs of each text, by start and period; texts are arrays of word numbers.

    A run is a longest stretch of smallest period q with at least MIN_LENGTH words and MIN_PERIODS periods.
    """
    out: list[list[Run]] = [[] for _ in texts]
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    order = [i for i in order if len(texts[i]) >= MIN_LENGTH]
    if not order:
        return out
    sizes = np.array([len(texts[i]) for i in order])
    words = np.concatenate([texts[i] for i in order])
    begin = np.cumsum(sizes) - sizes
    found = [(q, i, np.searchsorted(begin, i, side="right") - 1) for q, i in _grid(words, sizes)]
    # The four places must lie in one text.
    found = [(q, i[ok], d[ok]) for q, i, d in found for ok in [i + (MIN_PERIODS - 1) * q < begin[d] + sizes[d]] if ok.any()]
    if not found:
        return out
    # Only texts with candidates are compressed, each between symbols of its own.
    chosen = np.unique(np.concatenate([d for _, _, d in found]))
    slot = np.zeros(len(order), np.int64)
    slot[chosen] = np.arange(len(chosen))
    top = int(words.max()) + 1
    parts = [x for k, d in enumerate(chosen) for x in ([top + k], words[begin[d] : begin[d] + sizes[d]])]
    levels = grammar(np.concatenate([*parts, [top + len(chosen)]]))
    shift = np.cumsum(sizes[chosen] + 1) - sizes[chosen]
    q = np.concatenate([np.full(len(i), q) for q, i, _ in found])
    doc = np.concatenate([slot[d] for _, _, d in found])
    at = np.concatenate([i for _, i, _ in found]) - begin[chosen[doc]] + shift[doc]
    runs: dict[tuple[int, int, int], int] = {}
    for o, start, size, p in _stretches(levels, doc, at, q).tolist():
        # Ascending periods: the first of a stretch is its smallest, the others are multiples.
        runs.setdefault((o, start, size), p)
    for (o, start, size), p in runs.items():
        out[order[chosen[o]]].append((start - int(shift[o]), size, p))
    for found_runs in out:
        found_runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that stay when each run keeps its first period only."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def looped(words: list[bytes], doc_id: object) -> list[bytes]:
    """The words with the repetitions that a document's id asks for: every tenth crc32 repeats a part of its words to the end."""
    g, rest = divmod(crc32(str(doc_id).encode()), 10)
    n = len(words)
    if rest or not n or doc_id is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def _batches(texts: list[bytes | None], ids: list[object], change: Callable[[list[bytes], object], list[bytes]] | None,
             ) -> Iterator[list[list[bytes]]]:
    """Words of successive texts, about SLICE at once."""
    part, size = [], 0
    for text, key in zip(texts, ids, strict=True):
        words = (text or b"").split()
        part.append(change(words, key) if change else words)
        size += len(words)
        if size >= SLICE:
            yield part
            part, size = [], 0
    yield part


def word_runs(docs: DataFrame, change: Callable[[list[bytes], object], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row; ``runs``: start, length and period of all runs, ``collapsed``:
    the words that stay, joined by blanks.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0 and compared as bytes. A null, empty or blank text has no words and no
    runs. Repeated rows and ids, also missing ones, stay rows; extra columns are ignored; an empty table gives no rows.
    ``change`` may replace the words of a document (words, doc_id) before.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for part in _batches(batch.column(1).to_pylist(), batch.column(0).to_pylist(), change):
                names: defaultdict[bytes, int] = defaultdict(count().__next__)
                numbers = [np.fromiter(map(names.__getitem__, w), np.int64, len(w)) for w in part]
                runs = find_runs(numbers)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, len(part)), pa.array(map(len, part), pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs], pa.list_(run)),
                    pa.array([b" ".join(collapsed(w, r)) for w, r in zip(part, runs, strict=True)], pa.binary())],
                    ["doc_id", "n_words", "runs", "collapsed"])
                begin += len(part)

    rows = id_and_bytes(docs)
    return rows.mapInArrow(search, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, "
                                   "runs array<struct<start: long, length: long, period: long>>, collapsed binary")

