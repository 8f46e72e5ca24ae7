import random

import pytest

CLASHING = "fp long, row long, rep long, words string, kept string, region long, score double, held_out boolean, canonical string, listed string"


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "river", "stone", "light", "morning", "a", "in", "to", "old", "house", "garden"])
                    + rng.choice(["", "", "", "s", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang]) with extra columns whose names the operators use inside."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 0, 1, 2, 3, "w", "k", 4, 0.5, True, "c", "l") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING)
    return make


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls, empty and blank texts, one word, copies, near copies, repeated rows, odd characters, a long text."""
    base = prose(1)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, base), (6, base), (7, base.replace("river", "Lake", 1)), (8, prose(2)),
            (8, prose(2)), (9, "日本語 ñandú €5 \u0000 😀"), (10, prose(3, 6000)), (11, "a" * 900), (None, "no id here at all"),
            (12, "\n".join(["same line again"] * 30)), (13, prose(4) + " " + base), (14, "x y", None), (15, prose(5), "fr")]
