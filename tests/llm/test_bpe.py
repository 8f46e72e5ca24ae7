import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from basketloom.llm import bpe


@pytest.fixture(scope="module")
def tokens():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(tokens):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def test_like_the_library_and_back(make_docs, messy_rows, tokens, library):
    rng = random.Random(4)
    odd = ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(32, 0x3000), rng.randrange(9, 127)])) for _ in range(50)) for _ in range(300)]
    rows = [*messy_rows, *((100 + i, t) for i, t in enumerate([*odd, "<|endoftext|>", "x'll 'S we've \u3000 \x1c\x85end", "²½Ⅷ ǅ"]))]
    out = bpe.encode(make_docs(rows), tokens, public_tokenizers.PATTERN).collect()
    want = sorted((repr(r[0]), np.array(library.encode_ordinary(r[1] or ""), "<u4").tobytes(), (r[1] or "").encode()) for r in rows)
    assert sorted((repr(r["doc_id"]), bytes(r["ids"]), bytes(r["decoded"])) for r in out) == want


def test_the_hash_is_perfect_and_minimal(tokens):
    perfect = bpe.PerfectHash(tokens)
    assert sorted(perfect.ids.tolist()) == list(range(len(tokens))) and (perfect.find(tokens) == np.arange(len(tokens))).all()
    assert bpe.PerfectHash([b"one"]).find([b"one", b"other"]).tolist() == [0, 0]


def test_memory_of_a_worker_is_bounded(tokens, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 50)
    coder = bpe.Coder(tokens, public_tokenizers.PATTERN)
    coder.start()
    texts = [f"word{i} and more{i}" for i in range(100)]
    for i in range(0, 100, 10):
        ids = coder.encode(texts[i : i + 10])
        assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [library.encode_ordinary(t) for t in texts[i : i + 10]]
        assert len(coder.memo) <= 50


def test_empty_table(make_docs, messy_rows, tokens):
    assert bpe.encode(make_docs(messy_rows).limit(0), tokens, public_tokenizers.PATTERN).count() == 0
