import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from basketloom.llm import queries, runs
from tests.llm.conftest import prose


def brute(words):
    """Stretches of equal distance by scanning every period; the smallest period of a stretch counts."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def digests(key, text):
    words = (text or "").encode().split()
    h, n = crc32(str(key).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n and key is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


@pytest.mark.parametrize("chunk", [3, 1 << 18])
def test_runs_of_many_texts_against_brute_force(monkeypatch, chunk):
    monkeypatch.setattr(runs, "CHUNK", chunk)
    for seed in range(40):
        rng, texts = random.Random(seed), []
        for _ in range(rng.randint(1, 12)):
            words = []
            for _ in range(rng.randint(0, 6)):
                part = [rng.randrange(rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(1, 12))]
                words += (part * rng.randint(1, 9))[: rng.randint(1, 80)]
            texts.append(np.array(words, np.int64))
        assert runs.find_runs(texts) == [brute(t.tolist()) for t in texts], seed


def test_extensions_in_both_directions():
    rng = np.random.default_rng(1)
    words = np.concatenate([[90], np.tile(rng.integers(0, 3, 37), 9), rng.integers(0, 2, 300), np.zeros(200, np.int64), [91]])
    levels = runs.grammar(words)
    x, y = np.sort(rng.integers(1, len(words) - 1, (2, 500)), axis=0)
    x, y = x[x < y], y[x < y]
    for forward in (True, False):
        want = []
        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            size = 0
            while (words[i + size] == words[j + size]) if forward else (words[i - size] == words[j - size]):
                size += 1
            want.append(size)
        assert runs.extensions(levels, x, y, forward).tolist() == want


def test_query_against_brute_force(spark, make_docs, messy_rows, tmp_path):
    loops = [(200 + i, f"{prose(i, 9)} " + "the same words " * (i + 2) + prose(i + 1, 7) + " no" * i) for i in range(25)]
    rows = [*messy_rows, *loops, (300, "a b " * 7), (301, "x " * 70_000)]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = [(r["doc_id"], *r[1:]) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()]
    small = [(r[0], *digests(r[0], r[1])) for r in rows if r[0] != 301]
    assert sorted((g for g in got if g[0] != 301), key=repr) == sorted(small, key=repr)
    long = next(g for g in got if g[0] == 301)
    assert long[1:6] == (1, 0, 70_000, 1, 70_000_000)


def test_general_interface(make_docs):
    out = runs.word_runs(make_docs([(1, "go a b a b a b a b end"), (2, None)])).collect()
    assert [(r["n_words"], [tuple(x) for x in r["runs"]], bytes(r["collapsed"])) for r in out] == [(10, [(1, 8, 2)], b"go a b end"), (0, [], b"")]
    assert runs.word_runs(make_docs([(1, "a")]).limit(0)).count() == 0
