"""Document likelihood over a subword lattice, beside smoothed word counts.

An existing vocabulary gives the pieces, and their weights to begin with. The probability of a text is the sum over all
ways to cut it into pieces; pieces don't cross words, so it is a product over words, each found by a forward recursion
in log space and computed once per distinct word. Word counts come from the training documents. A learned model fits
the weights to all training words by expectation and maximization, and every training word is an arc across its lattice.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.columns import dropped, remainder, written

#: Words that every worker knows: at most so many, each of at most so many bytes (about 15 MB). All others are joined.
HOT_WORDS = 100_000
HOT_BYTES = 64
#: Bytes of text whose words are counted at once, and of words whose lattices are.
SLICE = 16 << 20
WORDS_SLICE = 4 << 20
SPACE = "▁"
#: What every piece and byte has besides its expected count.
PRIOR = 0.1


@dataclass(frozen=True)
class Pieces:
    """Natural log weights of the pieces; ``byte``: of one byte of a character that no piece covers."""

    weights: dict[str, float]
    byte: float
    longest: int


def pieces_from_scores(scores: dict[str, float]) -> Pieces:
    """Weights from the scores of an existing vocabulary.

    A vocabulary of merges scores its pieces by minus their rank, which is no log probability; the weight of a piece
    is 1 / (rank + 2.7), Zipf's law with Mandelbrot's shift, and all weights with those of 256 bytes of the
    last rank sum to 1.
    """
    ranks = {p: i for i, p in enumerate(sorted(scores, key=lambda p: (-scores[p], p)))}
    raw = {p: 1 / (r + 2.7) for p, r in ranks.items()}
    last = 1 / (len(ranks) + 2.7)
    whole = math.log(sum(raw.values()) + 256 * last)
    return Pieces({p: math.log(w) - whole for p, w in raw.items()}, math.log(last) - whole, max(map(len, raw), default=1))


def read_pieces(path: str) -> dict[str, float]:
    """Scores of the ordinary pieces of a vocabulary file; control, unknown and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


def word_log(word: str, pieces: Pieces) -> float:
    """Natural log of the summed weight of all segmentations of a word with its leading space mark."""
    marked, weight, n = SPACE + word, pieces.weights.get, len(word) + 1
    reach = [0.0]
    for end in range(1, n + 1):
        terms = [reach[begin] + w for begin in range(max(0, end - pieces.longest), end)
                 if (w := weight(marked[begin:end])) is not None]
        last = marked[end - 1]
        if last not in pieces.weights:
            terms.append(reach[end - 1] + len(last.encode("utf-8", "replace")) * pieces.byte)
        top = max(terms)
        reach.append(top + math.log(sum([math.exp(t - top) for t in terms])) if len(terms) > 1 else top)
    return reach[n]


def pieces_from_counts(names: list[str], counts: np.ndarray) -> Pieces:
    """Weights from the expected counts of the pieces, the last count being that of all bytes."""
    raw = counts + np.r_[np.full(len(names), PRIOR), 256 * PRIOR]
    logs = np.log(raw) - math.log(raw.sum())
    return Pieces(dict(zip(names, logs[:-1].tolist(), strict=True)), float(logs[-1]) - math.log(256), max(map(len, names), default=1))


@dataclass(frozen=True)
class Arcs:
    """Arcs of whole training words: a word seen c times has (c - discount) / words, its pieces have what is taken away."""

    discount: float
    words: int
    distinct: int

    def logs(self, c: np.ndarray, lattice: np.ndarray) -> np.ndarray:
        """Natural log of the probability of words that occur ``c`` times, from that of their pieces."""
        with np.errstate(divide="ignore"):
            whole = np.where(c > 0, np.log(np.maximum(c - self.discount, 0)) - math.log(max(self.words, 1)), -np.inf)
        return np.logaddexp(whole, lattice + (math.log(self.discount * self.distinct / self.words) if self.words else 0.0))


class Lattice:
    """The forward recursion for many words at once, from character to character of all of them.

    Words with the same beginning share its nodes. A node is one beginning; arcs, one for each piece, end in it and come
    from the nodes of shorter beginnings.
    """

    BASE = np.uint64(0x9E3779B97F4A7C15)
    BITS = 20
    #: Words beyond this length are taken one by one where at most ``ALONE`` of a block are as long.
    LONGEST = 64
    ALONE = 16
    #: Characters of a block, whose words go side by side.
    BLOCK = 1 << 19

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.names = list(pieces.weights)
        # Numbers after those of the pieces: the one to four bytes of a character that no piece covers.
        self.weights = np.array([*(pieces.weights[n] for n in self.names), *(width * pieces.byte for width in range(1, 5))])
        hashes = np.array([self._hash(n) for n in self.names], np.uint64)
        self.keys, self.at = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, -1, np.int32)
        self.probes = 1
        for i, (h, slot) in enumerate(zip(hashes, self._slot(hashes).tolist(), strict=True)):
            step = 0
            while self.at[slot + step & (1 << self.BITS) - 1] >= 0:
                step += 1
            self.keys[slot + step & (1 << self.BITS) - 1], self.at[slot + step & (1 << self.BITS) - 1] = h, i
            self.probes = max(self.probes, step + 1)
        self.used = self.at >= 0
        width = max(1, pieces.longest)
        self.powers = np.array([pow(int(self.BASE), i, 1 << 64) for i in range(1, width + 1)], np.uint64)

    @classmethod
    def _hash(cls, text: str) -> int:
        value = 0
        for char in text:
            value = (value * int(cls.BASE) + ord(char) + 1) % (1 << 64)
        return value

    @classmethod
    def _slot(cls, hashes: np.ndarray) -> np.ndarray:
        mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(64 - cls.BITS)).astype(np.int64)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces, -1 for none."""
        slot, found = self._slot(hashes), np.full(hashes.shape, -1, np.int32)
        left = np.flatnonzero(self.used[slot])
        keys, slot = hashes[left], slot[left]
        for step in range(self.probes):
            at = slot + step & (1 << self.BITS) - 1
            hit = (self.keys[at] == keys) & self.used[at]
            found[left[hit]] = self.at[at[hit]]
        return found

    def _side_by_side(self, words: list[str], counts: np.ndarray | None) -> np.ndarray:
        """Log weight of each word, in code point order; adds the expected counts of all arcs to ``counts``."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        codes = np.frombuffer("".join([SPACE + w for w in words]).encode("utf-32-le", "replace"), "<u4")
        first = np.cumsum(lengths) - lengths
        # Of all nodes: hash of the beginning and log weight to get there. Node 0 is the empty beginning.
        prefix, reach = np.zeros(len(codes) + 1, np.uint64), np.zeros(len(codes) + 1)
        ends, nodes, levels = np.empty(len(words), np.int64), 1, []
        # Words that go on, and the node of each among those of the last level; ``back``: the nodes before each of these, nearest first.
        words_on, node, back = np.arange(len(words)), np.zeros(len(words), np.int64), np.empty((1, 0), np.int64)
        last = 0
        for depth in range(1, int(lengths.max(initial=0)) + 1):
            on = lengths[words_on] >= depth
            words_on, node = words_on[on], node[on]
            code = codes[first[words_on] + depth - 1]
            new = np.r_[True, (node[1:] != node[:-1]) | (code[1:] != code[:-1])]
            parent, code, node = node[new], code[new].astype(np.uint64), np.cumsum(new) - 1
            size, width = len(parent), min(depth, len(self.powers))
            back, shorter = np.empty((size, width), np.int64), back
            back[:, 0] = last + parent
            back[:, 1:] = shorter[parent, :width - 1]
            last, nodes = nodes, nodes + size
            prefix[last:nodes] = prefix[back[:, 0]] * self.BASE + code + np.uint64(1)
            piece = self._places((prefix[last:nodes, None] - prefix[back] * self.powers[:width]).ravel())
            rare = np.flatnonzero(piece[::width] < 0)
            piece[rare * width] = len(self.names) + (code[rare] > 0x7F).astype(int) + (code[rare] > 0x7FF) + (code[rare] > 0xFFFF)
            arcs = np.flatnonzero(piece >= 0)
            begin, piece, end = back.ravel()[arcs], piece[arcs], arcs // width
            starts = np.flatnonzero(np.r_[True, end[1:] != end[:-1]])
            logs = reach[begin] + self.weights[piece]
            top = np.maximum.reduceat(logs, starts)
            shares = np.exp(logs - top[end])
            sums = np.add.reduceat(shares, starts)
            reach[last:nodes] = top + np.log(sums)
            done = lengths[words_on] == depth
            ends[words_on[done]] = last + node[done]
            if counts is not None:
                levels.append((last + end, begin, piece, shares / sums[end]))
        if counts is not None:
            # Backwards: how many words' segmentations come through each node, and what each arc has of them.
            through = np.bincount(ends, minlength=nodes).astype(float)
            for end, begin, piece, share in reversed(levels):
                share = share * through[end]
                np.add.at(through, begin, share)
                np.add.at(counts, piece, share)
        return reach[ends]

    def _alone(self, word: str, counts: np.ndarray) -> None:
        """The expected counts of one word, however long."""
        marked, numbers, weights = SPACE + word, self.numbers, self.logs_of
        reach, many, begins, numbered, shares = array("d", [0.0]), array("i"), array("i"), array("i"), array("d")
        for end in range(1, len(marked) + 1):
            arcs = [(begin, i) for begin in range(max(0, end - len(self.powers)), end) if (i := numbers.get(marked[begin:end])) is not None]
            if marked[end - 1] not in numbers:
                arcs.append((end - 1, len(self.names) + len(marked[end - 1].encode("utf-8", "replace")) - 1))
            logs = [reach[begin] + weights[i] for begin, i in arcs]
            top = max(logs)
            parts = [math.exp(x - top) for x in logs]
            whole = sum(parts)
            reach.append(top + math.log(whole))
            many.append(len(arcs))
            begins.extend([begin for begin, _ in arcs])
            numbered.extend([i for _, i in arcs])
            shares.extend([x / whole for x in parts])
        through, k = array("d", bytes(8 * len(many))) + array("d", [1.0]), len(shares)
        for end in range(len(many), 0, -1):
            for k in range(k - 1, k - 1 - many[end - 1], -1):
                through[begins[k]] += (share := shares[k] * through[end])
                shares[k] = share
        np.add.at(counts, np.frombuffer(numbered, np.int32), np.frombuffer(shares))

    @cached_property
    def numbers(self) -> dict[str, int]:
        return {n: i for i, n in enumerate(self.names)}

    @cached_property
    def logs_of(self) -> list[float]:
        return self.weights.tolist()

    def _blocks(self, words: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Places of the words in code point order, by blocks: those that go side by side, and those taken one by one."""
        order = sorted(range(len(words)), key=words.__getitem__)
        lengths = np.array([len(words[i]) + 1 for i in order], np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // self.BLOCK)) + 1
        for block in np.split(np.arange(len(order)), cuts):
            of = lengths[block] - 1
            longest = max(self.LONGEST, int(np.sort(of)[-self.ALONE - 1]) if len(of) > self.ALONE else 0)
            yield [order[i] for i in block[of <= longest].tolist()], [order[i] for i in block[of > longest].tolist()]

    def logs(self, words: list[str]) -> np.ndarray:
        """``word_log`` of every word."""
        out = np.empty(len(words))
        for together, alone in self._blocks(words):
            out[together] = self._side_by_side([words[i] for i in together], None)
            out[alone] = [word_log(words[i], self.pieces) for i in alone]
        return out

    def expected_counts(self, words: list[str], longest: int | None = LONGEST) -> np.ndarray:
        """Expected occurrences of every piece and, last, of bytes in the words, each taken once.

        Words of more than ``longest`` characters are left out; with None all words count, as the fit asks for.
        """
        counts = np.zeros(len(self.weights))
        words = words if longest is None else [w for w in words if len(w) <= longest]
        for together, alone in self._blocks(words):
            self._side_by_side([words[i] for i in together], counts)
            for i in alone:
                self._alone(words[i], counts)
        return np.r_[counts[:-4], counts[-4:] @ np.arange(1, 5)]


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n, c): every distinct word of (text, training), its count over all rows and over the training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            words = list(counts[0] | counts[1])
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([counts[0][w] + counts[1][w] for w in words], pa.int64()),
                 pa.array([counts[1][w] for w in words], pa.int64())], ["word", "n", "c"])

        counts, size = (Counter(), Counter()), 0
        for batch in batches:
            for text, training in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[training].update(_words(text))
                size += len(text or b"")
                if size >= SLICE:
                    yield out()
                    counts, size = (Counter(), Counter()), 0
        if size:
            yield out()

    partial = rows.select("text", "training").mapInArrow(run, "word binary, n long, c long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of ``WORDS_SLICE`` bytes or a little more: the more words, the more beginnings they share."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= WORDS_SLICE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def fitted_pieces(vocabulary: DataFrame, pieces: Pieces, rounds: int, fit_words: int | None = None) -> Pieces:
    """The pieces with weights fitted to the distinct training words of ``vocabulary``.

    A word counts once however frequent it is, since frequent words have arcs of their own and the pieces are for new
    ones. Every round takes all training words, however many and however long. ``fit_words`` asks for a rough fit instead:
    words of at most ``HOT_BYTES`` bytes, and before the last round about so many of them, drawn by a hash. A round sums
    the expected counts over Spark's tasks; the driver gets one row per piece.
    """
    spark = vocabulary.sparkSession
    words = vocabulary.where("c > 0").select("word")
    if fit_words is not None:
        words = words.where(F.octet_length("word") <= HOT_BYTES)
    total, names = words.count(), list(pieces.weights)
    drawn = words if fit_words is None else words.where(F.pmod(F.xxhash64("word"), F.lit(max(total, 1))) < fit_words)
    for left in reversed(range(rounds if total else 0)):
        shared = spark.sparkContext.broadcast(pieces)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice, sums = Lattice(shared.value), np.zeros(len(names) + 1)
            for batch in _slices(batches):
                sums += lattice.expected_counts([w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()], None)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], ["piece", "n"])

        counts = np.zeros(len(names) + 1)
        for row in (drawn if left else words).mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():
            counts[row["piece"]] = row["n"]
        pieces = pieces_from_counts(names, counts)
        shared.destroy()
    return pieces


def _arcs(vocabulary: DataFrame) -> Arcs:
    """Absolute discounting by Ney's estimate; kept above 0, so that new words have a probability."""
    once, twice, words, distinct = vocabulary.where("c > 0").agg(
        F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2), F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    return Arcs(min(0.9, max(0.1, once / max(1, once + 2 * twice))), words, distinct)


def _with_lattice(vocabulary: DataFrame, pieces, arcs: Arcs | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces.value)
        for batch in _slices(batches):
            logs = lattice.logs([w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()])
            if arcs:
                logs = arcs.logs(batch.column(2).to_numpy(), logs)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs / math.log(10))], [*batch.schema.names, "lattice"])

    return vocabulary.mapInArrow(run, "word binary, n long, c long, lattice double")


def _frequent(vocabulary: DataFrame, limit: int) -> dict[bytes, tuple[int, float]]:
    """(c, lattice) of at most ``limit`` short words, the most frequent ones.

    A histogram of counts (eight steps to a doubling, so a few hundred rows) tells where to cut; only words
    above the cut leave the executors.
    """
    short = vocabulary.where(F.octet_length("word") <= HOT_BYTES).withColumn("level", F.floor(8 * F.log2("n")))
    cut, total = None, 0
    for row in short.groupBy("level").agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        total += row["words"]
        if total > limit:
            break
        cut = row["level"]
    if cut is None:
        return {}
    return {bytes(r["word"]): (r["c"], r["lattice"]) for r in short.where(F.col("level") >= cut).select("word", "c", "lattice").collect()}


def _local_scores(rows: DataFrame, hot) -> DataFrame:
    """Per row, the sums over words that the workers know, and the other words with their counts.

    ``row`` tells rows with equal ids apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, row = hot.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                counts, row = Counter(_words(text)), row + 1
                n_known, base, score, rest = 0, 0.0, 0.0, []
                for word, n in counts.items():
                    if (entry := known.get(word)) is None:
                        rest.append((word, n))
                    else:
                        n_known += n * (entry[0] > 0)
                        base += n * math.log10(entry[0] + 0.1)
                        score += n * entry[1]
                out.append((row, counts.total(), n_known, base, score, rest))
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *arrays], names)

    pair = pa.struct([("word", pa.binary()), ("n", pa.int64())])
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pair)]
    names = ["doc_id", "held_out", "row", "n_words", "n_known", "base", "score", "rest"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "held_out").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, row long, n_words long, n_known long, base double, score double, "
             "rest array<struct<word: binary, n: long>>")


def lattice_scores(docs: DataFrame, scores: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
                   held_every: int = 10, hot_words: int = HOT_WORDS, rounds: int = 0, fit_words: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Held out: rows whose crc32 of the id as text is divisible by ``held_every``; the others are learned from.
    Tokens are the words of the text (A-Z lower-cased) and one end. ``score`` is the log10 of the summed weight of all
    segmentations of all words, times the end's share of the training tokens (pieces share the rest).
    A null or empty text is only an end. Rows without an id are held out. With nothing to learn from, the end's
    share is taken as one half. With ``rounds`` above 0 the weights are fitted to all training words so many times (to some
    with ``fit_words``, see ``fitted_pieces``) and training words are arcs of their own; with 0 the weights of ``scores`` stay as they are.
    Repeated rows count and are scored each; an empty table gives no rows.

    Frequent words travel to the workers, bounded in number and length; all others are counted per document and
    joined with the vocabulary on the word, so that no frequent word makes a hot join key.
    """
    spark = docs.sparkSession
    held = F.coalesce(remainder(docs[id_col], held_every) == 0, F.lit(True))
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("binary").alias("text"), held.alias("held_out"))
    pieces, arcs = pieces_from_scores(scores), None
    counted = word_counts(rows.withColumn("training", ~F.col("held_out")))
    if rounds:
        counted = written(counted)
        pieces, arcs = fitted_pieces(counted, pieces, rounds, fit_words), _arcs(counted)
    vocabulary = written(_with_lattice(counted, spark.sparkContext.broadcast(pieces), arcs))
    if rounds:
        dropped(counted)
    known = vocabulary.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = rows.where(~F.col("held_out")).count()
    n, v = known[0] + ends, known[1] + (ends > 0)
    hot = _frequent(vocabulary, hot_words)
    local = written(_local_scores(rows, spark.sparkContext.broadcast(hot)))
    rest = local.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.n")
    joined = rest.join(vocabulary.select("word", "c", "lattice"), "word")
    sums = joined.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("k"), F.sum(F.expr("n * log10(c + 0.1D)")).alias("b"),
        F.sum(F.expr("n * lattice")).alias("s"))
    end = ends / n if n and ends < n else 0.5
    none, n_tokens = F.lit(0), F.col("n_words") + 1
    return local.drop("rest").join(sums, "row", "left").select(
        "doc_id", "held_out", n_tokens.cast("long").alias("n_tokens"),
        (F.col("n_known") + F.coalesce("k", none) + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", F.lit(0.0)) + math.log10(ends + 0.1)
         - n_tokens * math.log10(n + 0.1 * (v + 1))).alias("base_score"),
        (F.col("score") + F.coalesce("s", F.lit(0.0)) + F.col("n_words") * math.log10(1 - end) + math.log10(end)).alias("score"))
