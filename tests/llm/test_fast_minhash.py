import random

import numpy as np
import pytest

from basketloom.llm import fast_minhash as mh
from tests.llm.conftest import prose


def full_set(text, size=4):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)] if words else [])


def brute(rows, percent=80):
    """(doc_id, size, component, kept) of every row by comparing all pairs of distinct sets."""
    sets = [full_set(r[1]) for r in rows]
    distinct = sorted({s for s in sets if s}, key=repr)
    top = {s: s for s in distinct}

    def root(s):
        while top[s] is not s:
            s = top[s]
        return s

    for i, one in enumerate(distinct):
        for two in distinct[:i]:
            if 100 * len(one & two) >= percent * len(one | two):
                top[root(one)] = root(two)
    least = {}
    for r, s in zip(rows, sets, strict=True):
        if s and r[0] is not None:
            least[root(s)] = min(r[0], least.get(root(s), r[0]))
    out = []
    for r, s in zip(rows, sets, strict=True):
        component = least.get(root(s)) if s else r[0]
        out.append((r[0], len(s), component, component == r[0]))
    return out


def variants(seed, count, changes):
    """Copies of one text with some words replaced, and copies of copies, so that links form chains and stars."""
    rng, made = random.Random(seed), [prose(seed, 90)]
    for _ in range(count):
        words = rng.choice(made).split()
        for _ in range(rng.randint(1, changes)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(99)}"
        made.append(" ".join(words))
    return made


@pytest.mark.parametrize("block", [3, 512])
def test_whole_operator_against_brute_force(make_docs, messy_rows, monkeypatch, block):
    monkeypatch.setattr(mh, "BLOCK", block)
    monkeypatch.setattr(mh, "BLOCK_SHINGLES", 80 * block)
    texts = [t for seed in (61, 62) for t in variants(seed, 25, 4)] + ["A b  c", "a B c", "a b c d", "a b c d e", "a b c d e f g h", "a b c d e f g h i"]
    rows = [*messy_rows, *((400 + i, t) for i, t in enumerate(texts)), (None, prose(8)), (None, "alone without an id is what this row has to be")]
    got = [tuple(r) for r in mh.near_duplicates(make_docs(rows)).collect()]
    want = brute(rows)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len({w[2] for w in want[len(messy_rows) :]}) > 3 and sum(not w[3] for w in want) > 30


def test_rows_of_one_id_are_judged_apart(make_docs):
    rows = [(1, prose(1)), (1, prose(2)), (2, prose(2)), (3, prose(3))]
    got = sorted(tuple(r)[::2] for r in mh.near_duplicates(make_docs(rows)).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 3)]


def test_every_coordinate_is_filled_and_agreement_estimates_similarity():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 40, 3000):
        pool = np.unique(rng.integers(0, 2**63, 2 * size, dtype=np.uint64))
        a, b = np.sort(pool[:size]), np.sort(pool[: max(1, size * 4 // 5)])
        made = mh.sketches([a, b])
        assert made.shape == (2, mh.SIZE) and made.max() < np.iinfo(np.uint64).max
        assert abs((made[0] == made[1]).mean() - len(b) / len(a)) < 0.12
    assert mh.sketches([]).shape == (0, mh.SIZE)


def test_few_links_are_lost_by_the_bands():
    """Pairs at the threshold meet in a bucket."""
    rng = np.random.default_rng(5)
    for _ in range(60):
        pool = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
        a, b = np.sort(pool[:270]), np.sort(pool[30:])
        made = mh.sketches([a, b])
        assert (mh.band_keys(made)[0] == mh.band_keys(made)[1]).any()
        assert (made[0] == made[1]).sum() >= mh.fewest_equal(80)


def test_empty_table_and_low_threshold(make_docs, messy_rows):
    assert mh.near_duplicates(make_docs(messy_rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        mh.near_duplicates(make_docs(messy_rows), percent=20)


def test_few_texts_are_shuffled(spark):
    """All rows with a wanted text, and hardly any other, come to the join that fetches texts."""
    rows = mh._documents(spark.range(3000).selectExpr("id doc_id", "concat('text ', id % 1500) text"), "doc_id", "text")
    wanted = rows.where("doc_id < 5").selectExpr("doc_id vertex", "doc_id _id", "text_hash _hash")
    near = [r["doc_id"] for r in mh._possible_rows(rows, wanted).collect()]
    assert {*range(5), *range(1500, 1505)} <= set(near) and len(near) < 60
    assert sorted(tuple(r) for r in mh._wanted_texts(rows, wanted).collect()) == [(i, f"text {i}".encode()) for i in range(5)]
