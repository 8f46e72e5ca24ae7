"""Language ID by prediction by partial matching over bytes.

For each language a context tree of order 0 to 3 is counted on training texts. A byte's probability is that of the
longest context that was seen; a byte that was never seen there costs the context's escape (method C: as many
escapes as different bytes) and is looked up one order below, down to a uniform choice. The statistics are frozen
after training, so the whole recursion is worked out once per (context, byte) into one table, and the code length
of a text is the sum of its entries.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.columns import remainder

#: Byte classes: the most frequent bytes of the training texts and one class for all others.
CLASSES = 48
ORDER = 3
#: Training texts per language at most, chosen by the hash of their id.
MAX_TRAIN_DOCS = 2000
#: Languages of one table; it has CLASSES**(ORDER + 1) entries of four bytes for each (21 MB). More languages take turns.
BLOCK_LANGS = 8
#: Bytes of texts, and code lengths, that are held while the tables of more languages than that take turns.
GROUP_BYTES = 1 << 26
#: Bytes of text that are scored at once.
SLICE = 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class ContextTrees:
    """Counts of the (order + 1)-byte strings, as sorted codes, for each language, over byte classes."""

    langs: list[str]
    classes: np.ndarray
    codes: list[np.ndarray]
    counts: list[np.ndarray]
    #: Tells the tables of several models in one worker apart.
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def table(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Bits of each byte class after each context, (context and byte, language), of the languages from ``begin`` to ``end``."""
        own = list(zip(self.codes, self.counts, strict=True))[begin:end]
        out = np.empty((CLASSES ** (ORDER + 1), len(own)), np.float32)
        others = np.count_nonzero(self.classes == CLASSES - 1)
        for lang, (codes, counts) in enumerate(own):
            # The last class shares its code among its bytes.
            below = np.full((1, CLASSES), 8.0, np.float32)
            below[0, -1] -= np.log2(max(1, others))
            for order in range(ORDER + 1):
                contexts, where = np.unique(codes % CLASSES ** (order + 1) // CLASSES, return_inverse=True)
                own = np.zeros((len(contexts), CLASSES))
                np.add.at(own, (where, codes % CLASSES), counts)
                total, kinds = own.sum(axis=1, keepdims=True), (own > 0).sum(axis=1, keepdims=True)
                below = np.tile(below, (CLASSES**order // below.shape[0], 1))
                with np.errstate(divide="ignore"):
                    escaped = np.log2(total + kinds) - np.log2(kinds) + below[contexts]
                    below[contexts] = np.where(own > 0, np.log2(total + kinds) - np.log2(own), escaped)
            out[:, lang] = below.reshape(-1)
        return out


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rest = remainder(docs[id_col], 3)
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"),
                       F.coalesce(rest == 1, F.lit(True)).alias("held_out"))


def _bytes_and_codes(text: bytes, classes: np.ndarray) -> np.ndarray:
    """The code of each byte with the three before it; before the text stand zeros of the last class."""
    own = np.concatenate((np.full(ORDER, CLASSES - 1, np.int32), classes[np.frombuffer(text, np.uint8)]))
    code = own[ORDER:].copy()
    for back in range(1, ORDER + 1):
        code += own[ORDER - back : len(own) - back] * np.int32(CLASSES**back)
    return code


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_docs: int = MAX_TRAIN_DOCS) -> ContextTrees:
    """Context trees from rows with a language and a text whose crc32 of the id modulo 3 isn't 1.

    A language with more rows than ``max_docs`` gives about so many, by the hash of the id; their texts are whole. Every
    value of the language column is a language, however many there are.
    """
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col, lang_col).where("not held_out and lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return ContextTrees([], np.zeros(256, np.int32), [], [])
    # Only languages with too many rows need their share.
    large = [F.lit(x) for lang in langs if sizes[lang] > max_docs for x in (lang, max_docs / sizes[lang])]
    share = F.coalesce(F.create_map(*large)[F.col("lang")], F.lit(1.0)) if large else F.lit(1.0)
    chosen = rows.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < share * 1_000_000)
    chosen = chosen.select("lang", F.col("text").cast("binary").alias("text"))

    def count_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            for text in batch.column(1).to_pylist():
                total += np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], ["byte", "n"])

    frequent = chosen.mapInArrow(count_bytes, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n"))
    order = [r["byte"] for r in frequent.where("n > 0").orderBy(F.desc("n"), "byte").limit(CLASSES - 1).collect()]
    classes = np.full(256, CLASSES - 1, np.int32)
    classes[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(classes)

    def count_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(_bytes_and_codes(text, shared.value))
            for lang, parts in texts.items():
                codes, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int32()), pa.array(counts, pa.int64())],
                    ["lang", "code", "n"])

    # At most CLASSES**(ORDER + 1) rows for each language, whatever the input.
    found = chosen.mapInArrow(count_codes, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    table = found.toArrow()
    place = pc.index_in(table.column("lang"), pa.array(langs, pa.string())).to_numpy()
    code, n = table.column("code").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange(1, len(langs)))
    return ContextTrees(langs, classes, np.split(code[order], cuts), np.split(n[order].astype(np.float64), cuts))


#: The last table of this worker.
_tables: dict[tuple[str, int], np.ndarray] = {}


def _table(known: ContextTrees, begin: int) -> np.ndarray:
    key = (known.name, begin)
    if key not in _tables:
        _tables.clear()
        _tables[key] = known.table(begin, begin + BLOCK_LANGS)
    return _tables[key]


def _code_lengths(texts: list[bytes], known: ContextTrees) -> np.ndarray:
    """Bits of each text in each language, (text, language)."""
    bits = np.zeros((len(texts), len(known.langs)))
    begins = range(0, len(known.langs), BLOCK_LANGS)
    # First the block whose table is there.
    for begin in sorted(begins, key=lambda b: (known.name, b) not in _tables):
        table = _table(known, begin)
        for row, text in zip(bits, texts, strict=True):
            for i in range(0, len(text), SLICE):
                codes = _bytes_and_codes(text[max(0, i - ORDER) : i + SLICE], known.classes)[min(i, ORDER) :]
                row[begin : begin + BLOCK_LANGS] += np.ones(len(codes), np.float32) @ table.take(codes, axis=0)
    return bits


def _groups(batches: Iterator[pa.RecordBatch], known: ContextTrees) -> Iterator[pa.RecordBatch]:
    """The batches; with several tables, joined to groups of about ``GROUP_BYTES``, so that each table is made once a group."""
    if len(known.langs) <= BLOCK_LANGS:
        yield from batches
        return
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes + 8 * batch.num_rows * len(known.langs)
        if size >= GROUP_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def predict(docs: DataFrame, trees: ContextTrees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, bits) for every row: the language of the shortest code, its share of the
    probability of the text, and its code length.

    Texts that are null or have no letter are ``und`` with score 0 and no bits, as are all texts without a trained
    language. Of equal code lengths the first language by name wins. Each table covers ``BLOCK_LANGS`` languages;
    more languages take turns over groups of texts, so a worker holds one table at a time. Repeated rows are predicted each; an empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in _groups(batches, known):
            texts = [text if lettered and known.langs else None
                     for text, lettered in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            rows = iter(_code_lengths([t for t in texts if t is not None], known))
            langs, scores, lengths = [], [], []
            for text in texts:
                if text is None:
                    langs, scores, lengths = [*langs, UNKNOWN], [*scores, 0.0], [*lengths, None]
                    continue
                bits = next(rows)
                best = int(bits.argmin())
                langs.append(known.langs[best])
                scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
                lengths.append(float(bits[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(lengths, pa.float64())],
                ["doc_id", "lang_pred", "score", "bits"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("binary").alias("text"),
                       F.coalesce(docs[text_col].rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, bits double")
