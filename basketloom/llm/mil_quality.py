"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded, gated attention weighs the passages, and the weighted
sum of the encodings gives the document's score. Encoder, attention and output are learned together from
document labels alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.columns import id_and_bytes, remainder

#: Bytes of a passage; the passages of a text cover it whole.
PASSAGE = 512
# Character groups of the passage features; all other bytes make one more group.
GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".", b",", b"!?",
          b":;'\"()-", b"|", b"#*$%&", b"<>=+@/\\_~^[]{}`", bytes(range(128, 256))]
N_GROUPS = len(GROUPS) + 1
#: Shares of all pairs of groups, share of the passage in lines that stood in the text before, and its length.
N_FEATURES = N_GROUPS * N_GROUPS + 2
#: Labelled documents that the model is fitted on at most, and their longest text; about 14 MB of passages per thousand at most.
MAX_TRAIN_DOCS = 4000
MAX_TRAIN_BYTES = 16 << 10
#: Bytes of text that are encoded at once.
SLICE = 1 << 20

_GROUP_OF = np.full(256, N_GROUPS - 1, np.int32)
for _i, _bytes in enumerate(GROUPS):
    _GROUP_OF[list(_bytes)] = _i


def _repeated(text: bytes) -> np.ndarray:
    """For every byte, whether it is in a line equal to an earlier one."""
    lines, seen, flags = text.split(b"\n"), set(), []
    for line in lines:
        flags.append(line in seen and bool(line))
        seen.add(line)
    return np.repeat(flags, [len(x) + 1 for x in lines])[: len(text)]


def passages(text: bytes | None) -> np.ndarray:
    """Features of the passages of a text, one row each; a text without bytes is one passage of zeros."""
    data = np.frombuffer(text or b"", np.uint8)
    n = max(1, -(-len(data) // PASSAGE))
    out = np.zeros((n, N_FEATURES), np.float32)
    if not len(data):
        return out
    repeated = _repeated(text)
    step = SLICE // PASSAGE
    for first in range(0, n, step):
        part = data[first * PASSAGE : (first + step) * PASSAGE]
        rows = -(-len(part) // PASSAGE)
        group, row = _GROUP_OF[part], np.arange(len(part)) // PASSAGE
        pair = row[1:] * (N_GROUPS * N_GROUPS) + group[:-1] * N_GROUPS + group[1:]
        counts = np.bincount(pair, minlength=rows * N_GROUPS * N_GROUPS).reshape(rows, -1)
        sizes = np.bincount(row, minlength=rows)
        out[first : first + rows, :-2] = np.sqrt(counts / sizes[:, None])
        out[first : first + rows, -2] = np.bincount(row, repeated[first * PASSAGE : first * PASSAGE + len(part)], rows) / sizes
        out[first : first + rows, -1] = sizes / PASSAGE
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AttentionModel:
    """Passage encoder, gated attention and output over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, x: np.ndarray, hidden: int, gate: int, seed: int) -> AttentionModel:
        rng = np.random.default_rng(seed)

        def matrix(a: int, b: int) -> np.ndarray:
            return (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)

        weights = {"enc": matrix(x.shape[1], hidden), "enc0": np.zeros(hidden, np.float32), "tan": matrix(hidden, gate),
                   "sig": matrix(hidden, gate), "att": matrix(gate, 1), "out": matrix(hidden, 1), "out0": np.zeros(1, np.float32)}
        return cls(x.mean(axis=0), x.std(axis=0) + 0.01, weights)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """All layers for bags that begin at ``starts``."""
        w, bag = self.weights, np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["enc"] + w["enc0"])
        tan, sig = np.tanh(h @ w["tan"]), _sigmoid(h @ w["sig"])
        raw = (tan * sig) @ w["att"][:, 0]
        raw = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        attention = raw / np.add.reduceat(raw, starts)[bag]
        z = np.add.reduceat(h * attention[:, None], starts)
        return {"x": x, "h": h, "tan": tan, "sig": sig, "a": attention, "z": z, "bag": bag, "score": _sigmoid(z @ w["out"][:, 0] + w["out0"])}

    def gradients(self, x: np.ndarray, starts: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(x, starts)
        d_out = ((f["score"] - label) / len(label)).astype(np.float32)
        d_z = d_out[:, None] * w["out"][:, 0]
        d_a = (f["h"] * d_z[f["bag"]]).sum(axis=1)
        d_raw = f["a"] * (d_a - np.add.reduceat(f["a"] * d_a, starts)[f["bag"]])
        d_gated = d_raw[:, None] * w["att"][:, 0]
        d_tan, d_sig = d_gated * f["sig"] * (1 - f["tan"] ** 2), d_gated * f["tan"] * f["sig"] * (1 - f["sig"])
        d_h = f["a"][:, None] * d_z[f["bag"]] + d_tan @ w["tan"].T + d_sig @ w["sig"].T
        d_pre = d_h * (1 - f["h"] ** 2)
        return {"enc": f["x"].T @ d_pre, "enc0": d_pre.sum(axis=0), "tan": f["h"].T @ d_tan, "sig": f["h"].T @ d_sig,
                "att": ((f["tan"] * f["sig"]).T @ d_raw)[:, None], "out": (f["z"].T @ d_out)[:, None], "out0": d_out.sum(keepdims=True)}


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 30, batch: int = 64,
        rate: float = 0.004, decay: float = 1e-4, seed: int = 7) -> AttentionModel:
    """Adam on the log loss of the bags; the same input gives the same model."""
    model = AttentionModel.new(np.concatenate(bags), hidden, gate, seed)
    rng, step = np.random.default_rng(seed), 0
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            chosen = [bags[j] for j in order[i : i + batch]]
            starts = np.concatenate(([0], np.cumsum([len(b) for b in chosen])[:-1]))
            step += 1
            for k, g in model.gradients(np.concatenate(chosen), starts, labels[order[i : i + batch]]).items():
                g = g + decay * model.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.weights[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_docs: int = MAX_TRAIN_DOCS, max_bytes: int = MAX_TRAIN_BYTES) -> AttentionModel | None:
    """A model from at most ``max_docs`` labelled documents of at most ``max_bytes`` bytes, chosen by the hash of the id.

    Only labels 0 and 1 of ids whose crc32 modulo 3 isn't 1 are read. An id with several labels counts with the smallest.
    None if there is nothing to learn from.
    """
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & (remainder(F.col("doc_id"), 3) != 1)).groupBy("doc_id").agg(F.min("label").alias("label"))
    # A few thousand rows of two numbers, whatever the size of the tables.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    rows = id_and_bytes(docs, id_col, text_col).where(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes)
    rows = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [passages(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(packed, pa.binary())], ["doc_id", "label", "bag"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, label int, bag binary").dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow()
    if not found.num_rows:
        return None
    bags = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in found.column("bag").to_pylist()]
    return fit(bags, found.column("label").to_numpy().astype(np.float32))


def score(docs: DataFrame, model: AttentionModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, top_passage) for every row; the passage of the largest weight is counted from 0.

    Null and empty texts are one passage of zeros and get the model's score for it. Without a model every score is 0.5.
    Repeated rows are scored each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, tops = [], []
            bags, size = [], 0
            texts = batch.column(1).to_pylist()
            for i, text in enumerate(texts):
                bags.append(passages(text))
                size += len(text or b"")
                if size < SLICE and i + 1 < len(texts):
                    continue
                starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])[:-1]))
                if shared.value is None:
                    scores, tops = scores + [0.5] * len(bags), tops + [0] * len(bags)
                else:
                    found = shared.value.forward(np.concatenate(bags), starts)
                    scores += found["score"].astype(float).tolist()
                    tops += [int(a.argmax()) for a in np.split(found["a"], starts[1:])]
                bags, size = [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(tops, pa.int32())],
                                             ["doc_id", "score", "top_passage"])

    rows = id_and_bytes(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, top_passage int")
