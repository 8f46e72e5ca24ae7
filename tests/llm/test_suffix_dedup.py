import random
from collections import Counter

import pytest

from basketloom.llm import suffix_dedup
from tests.llm.conftest import prose


def brute(texts, length):
    """(kept bytes, spans) per text by counting every string of ``length`` bytes."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans, at = [], 0
        while at < len(d):
            end = at
            while end < len(d) and gone[end]:
                end += 1
            if end > at:
                spans.append((at, end))
            at = max(end, at + 1)
        out.append((bytes(b for b, g in zip(d, gone) if not g), spans))
    return out


def compare(docs, rows, length, **more):
    got = sorted(((r["doc_id"] is None, r["doc_id"], bytes(r["kept"]), [tuple(s) for s in r["spans"]], r["n_bytes"])
                  for r in suffix_dedup.remove_repeats(docs, length, **more).collect()), key=repr)
    want = sorted(((r[0] is None, r[0], kept, spans, len((r[1] or "").encode()))
                   for r, (kept, spans) in zip(rows, brute([r[1] for r in rows], length), strict=True)), key=repr)
    assert got == want


@pytest.mark.parametrize("length", [140, 400])
def test_messy_rows(make_docs, messy_rows, length):
    compare(make_docs(messy_rows), messy_rows, length)


@pytest.mark.parametrize("batches", [1, 4, 5])
def test_passages_that_overlap_and_end_anywhere(make_docs, batches):
    """Shared passages cut at random places, so that hulls, parts and single windows all decide something."""
    rng, pool = random.Random(batches), [prose(i, 80) for i in range(4)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 3)):
            text = rng.choice(pool)
            at = rng.randrange(len(text) // 2)
            parts += [prose(1000 + rng.randrange(10**6), rng.randint(0, 12)), text[at : at + rng.randint(100, 400)]]
        rows.append((i, "é".join(parts)))
    compare(make_docs(rows), rows, 150, batches=batches)


def test_chunks_of_a_long_text_meet(make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    text = prose(7, 700).encode() + b"ab" * 300
    small = suffix_dedup.blocks(text, 200)
    monkeypatch.undo()
    whole = suffix_dedup.blocks(text, 200)
    assert {k: v.tolist() for k, v in small.items()} == {k: v.tolist() for k, v in whole.items()}


def test_empty_table_and_short_length(make_docs, messy_rows):
    assert suffix_dedup.remove_repeats(make_docs(messy_rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(make_docs(messy_rows), 50)
