import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import __spark_entry__
import corpus_pipeline
from basketloom.llm import bpe, decontaminate, quality_rules
from tests.llm.conftest import prose
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_suffix_dedup import brute


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)} and "pipeline" in names


def test_pipeline_against_its_parts_by_brute_force(spark, make_docs, messy_rows, tmp_path):
    item = prose(900, 40)
    shared = prose(901, 90)
    rows = [*messy_rows, *((100 + i, prose(i + 10, 150)) for i in range(12)), (150, prose(20, 150)), (151, prose(40, 100) + " " + item),
            (152, prose(41, 120) + shared), (153, prose(42, 120) + shared), (154, " | ".join("abcdefgh" * 20))]
    docs = make_docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    kept = {r["doc_id"] for r in quality_rules.quality_rules(docs).where("kept").collect()}
    left = {r[0]: r[1] for r in rows if r[0] in kept and r[0] is not None}
    groups = brute_components({i: brute_fingerprint(t) for i, t in left.items()}, 3)
    left = {i: t for i, t in left.items() if groups[i] == i}
    left = dict(zip(left, (k.decode() for k, _ in brute(list(left.values()), corpus_pipeline.REPEAT)), strict=True))
    normal = {i: decontaminate.normal(t.encode()) for i, t in left.items()}
    left = {i: t for i, t in left.items() if decontaminate.normal(item.encode())[:96] not in normal[i]}
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    want = {}
    for i, text in left.items():
        ids = library.encode_ordinary(text)
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert got == want and 151 not in got and len(got) > 8


def test_stages_keep_the_columns(spark, make_docs, messy_rows, tmp_path):
    docs = make_docs([*messy_rows, *((100 + i, prose(i + 10, 150)) for i in range(4))]).select("doc_id", "text", "lang", "source", "n_chars")
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name


def test_near_dedup_keeps_distinct_texts_whatever_their_ids(spark, make_docs):
    rows = [(1, prose(1)), (1, prose(2)), (1, prose(2)), (None, prose(3)), (None, prose(3)), (2, prose(4)), (3, prose(4)), (None, prose(4))]
    docs = make_docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()), key=repr)
    assert got == sorted([(1, prose(1)), (1, prose(2)), (None, prose(3)), (2, prose(4))], key=repr)


def test_passages_of_over_fifty_words_go(spark, make_docs):
    shared = prose(901, 55)
    docs = make_docs([(i, f"{prose(i, 60)} {shared} {prose(i + 50, 60)}") for i in range(3)]).select("doc_id", "text", "lang", "source", "n_chars")
    assert not any(shared[5:-5] in r["text"] for r in corpus_pipeline.long_repeats(spark, docs, "").collect())
