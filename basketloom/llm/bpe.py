"""Byte-level BPE in two tiers: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import heapq
import itertools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from xxhash import xxh64_intdigest

from basketloom.llm.columns import id_and_bytes

#: Pre-tokens that a worker remembers; beyond that it forgets all and starts again, so its memory is bounded.
MEMO = 1_000_000
#: Bytes of text that are split at once.
SLICE = 1 << 20
#: Texts with characters below this are split by explicit character classes, others by Unicode properties.
SIMPLE = 0x250
#: Seeds of a bucket that are tried at once.
TRIALS = 64


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file in the order of their ids."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """Each of n keys has its own of n slots: a key's bucket holds either a seed for the slot or the slot itself."""

    def __init__(self, keys: list[bytes]):
        n, self.n_buckets = len(keys), max(1, len(keys) // 2)
        prints = np.array([xxh64_intdigest(k) for k in keys], np.uint64)
        if len(np.unique(prints)) != n:
            raise ValueError("keys must differ in their hashes")
        self.seeds = np.zeros(self.n_buckets, np.int64)
        self.ids = np.full(n, -1, np.int64)
        buckets = (prints % np.uint64(self.n_buckets)).astype(np.int64)
        order, sizes = np.argsort(buckets, kind="stable"), np.bincount(buckets, minlength=self.n_buckets)
        ends = np.cumsum(sizes)
        singles = []
        for bucket in np.argsort(-sizes, kind="stable").tolist():
            members = order[ends[bucket] - sizes[bucket] : ends[bucket]]
            if len(members) < 2:
                singles += [(bucket, x) for x in members.tolist()]
                continue
            for first in itertools.count(0, TRIALS):
                slots = np.sort(self._slots(prints[members][None, :], np.arange(first, first + TRIALS)[:, None], n), axis=1)
                fits = np.flatnonzero((self.ids[slots] < 0).all(axis=1) & (slots[:, 1:] != slots[:, :-1]).all(axis=1))
                if len(fits):
                    break
            seed = first + int(fits[0])
            self.seeds[bucket], self.ids[self._slots(prints[members], seed, n)] = seed, members
        for (bucket, key), slot in zip(singles, np.flatnonzero(self.ids < 0).tolist(), strict=True):
            self.seeds[bucket], self.ids[slot] = -1 - slot, key

    @staticmethod
    def _slots(prints: np.ndarray, seeds: np.ndarray | int, n: int) -> np.ndarray:
        mixed = (prints ^ (prints >> np.uint64(29))) * (np.uint64(2) * np.asarray(seeds).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The id in whose slot each key would be; the caller compares the key."""
        prints = np.fromiter(map(xxh64_intdigest, keys), np.uint64, len(keys))
        seeds = self.seeds[(prints % np.uint64(self.n_buckets)).astype(np.int64)]
        return self.ids[np.where(seeds < 0, -1 - seeds, self._slots(prints, np.maximum(seeds, 0), len(self.ids)))]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of ``piece``: the adjacent pair of lowest rank is joined first, the leftmost of equal ones."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or after[after[i]] != end:
            continue
        gone = after[i]
        alive[gone], after[i] = False, end
        if end < n:
            before[end] = i
            if (rank := ranks.get(piece[i : after[end]])) is not None:
                heapq.heappush(heap, (rank, i, after[end]))
        if (left := before[i]) >= 0 and (rank := ranks.get(piece[left:end])) is not None:
            heapq.heappush(heap, (rank, left, end))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


def _splitters(pattern: str):
    """The pattern over explicit classes for texts of simple characters, and over properties for all."""
    chars = [chr(i) for i in range(SIMPLE)]
    kinds = {k: "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == k) for k in "LN"}
    kinds["s"] = "".join(re.escape(c) for c in chars if regex.match(r"\p{White_Space}", c))
    simple = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{kinds['s']}{kinds['L']}{kinds['N']}]")
    simple = simple.replace(r"\p{L}", f"[{kinds['L']}]").replace(r"\p{N}", f"[{kinds['N']}]")
    simple = simple.replace(r"\S", f"[^{kinds['s']}]").replace(r"\s", f"[{kinds['s']}]")
    whole = pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
    return re.compile(simple).findall, regex.compile(whole).findall, re.compile(f"[^\\x00-{chr(SIMPLE - 1)}]").search


@dataclass
class Coder:
    """Encoder and decoder over one vocabulary; travels to the workers as arrays and byte strings."""

    tokens: list[bytes]
    pattern: str
    perfect: PerfectHash = field(init=False)

    def __post_init__(self) -> None:
        self.perfect = PerfectHash(self.tokens)

    def start(self) -> None:
        self.ranks = {t: i for i, t in enumerate(self.tokens)}
        self.memo: dict[str, bytes] = {}
        self.simple, self.whole, self.odd = _splitters(self.pattern)

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("tokens", "pattern", "perfect")}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def _learn(self, fresh: list[str]) -> None:
        keys = [x.encode() for x in fresh]
        for text, key, i in zip(fresh, keys, self.perfect.find(keys).tolist(), strict=True):
            ids = [i] if self.tokens[i] == key else merge(key, self.ranks)
            self.memo[text] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        split = [(self.whole if self.odd(t) else self.simple)(t) for t in texts]
        fresh = set().union(*split).difference(self.memo)
        if len(self.memo) + len(fresh) > MEMO:
            self.memo.clear()
            fresh = set().union(*split)
        if fresh:
            self._learn(list(fresh))
        return [b"".join(map(self.memo.__getitem__, parts)) for parts in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _slices(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= SLICE or i + 1 == len(texts):
            yield begin, i + 1
            begin, size = i + 1, 0


def encode(docs: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """(doc_id, ids, decoded) for every row: token ids as packed little-endian unsigned 32-bit integers, and the
    bytes that these ids decode to.

    Null and empty texts have no ids. Equal to ordinary encoding of each match of ``pattern`` without special tokens.
    Whole texts are encoded in one row each; repeated rows are encoded each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Coder(tokens, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        if not hasattr(coder, "memo"):
            coder.start()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in _slices(texts):
                ids = coder.encode([(t or b"").decode("utf-8", "replace") for t in texts[begin:end]])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin), pa.array(ids, pa.binary()),
                    pa.array(map(coder.decode, ids), pa.binary())], ["doc_id", "ids", "decoded"])

    rows = id_and_bytes(docs)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary")
