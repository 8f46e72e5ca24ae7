import random

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from basketloom.llm import simhash
from tests.llm.conftest import prose


def brute_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    pieces = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    """{id: smallest reachable id} for a dict of id to fingerprint."""
    found, left = {}, sorted(prints)
    while left:
        front = [left[0]]
        group = set(front)
        while front:
            at = front.pop()
            near = [x for x in left if x not in group and (prints[x] ^ prints[at]).bit_count() <= distance]
            group.update(near)
            front += near
        found.update(dict.fromkeys(group, min(group)))
        left = [x for x in left if x not in group]
    return found


def test_whole_operator_against_brute_force(make_docs, messy_rows):
    rows = [*messy_rows, (8, prose(77)), (None, prose(78)), (None, messy_rows[4][1])]
    got = sorted((tuple(r)[:3] for r in simhash.near_duplicates(make_docs(rows)).collect()), key=repr)
    prints = [brute_fingerprint(r[1]) for r in rows]
    groups = brute_components(dict(enumerate(prints)), 3)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[groups[i]] = min(r[0], least.get(groups[i], r[0]))
    want = [(r[0], f"{p:016x}", least.get(groups[i])) for i, (r, p) in enumerate(zip(rows, prints, strict=True))]
    assert got == sorted(want, key=repr) and got.count((1, "0" * 16, 1)) == 1
    assert (None, f"{prints[-2]:016x}", None) in got and (None, f"{prints[4]:016x}", 5) in got


def test_repeated_rows_stay_rows_and_empty_tables_are_empty(make_docs, messy_rows):
    out = simhash.near_duplicates(make_docs(messy_rows))
    assert out.where("doc_id = 8").count() == 2 and out.count() == len(messy_rows)
    assert simhash.near_duplicates(make_docs(messy_rows).limit(0)).count() == 0


def test_shingle_hash_is_the_one_of_the_engine(spark):
    assert spark.sql("select xxhash64('a b c') h").first()["h"] % (1 << 64) == xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("leaf", [2, 4096])
def test_links_keep_every_component(spark, distance, leaf):
    """Chains, dense clusters and loners; with a leaf of two nearly every bucket is crowded."""
    rng, prints = random.Random(distance), set()
    for _ in range(5):
        at = rng.getrandbits(64)
        for _ in range(20):
            prints.add(at)
            for _ in range(rng.randint(1, 4)):
                at ^= 1 << rng.randrange(64)
    prints |= {rng.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1}
    ids = dict(enumerate(sorted(prints)))
    rows = spark.createDataFrame([(p - (p >> 63 << 64), i) for i, p in ids.items()], "fp long, rep long")
    edges = simhash.links(rows, distance, leaf)
    found = {r["id"]: r["component"] for r in simhash.components(edges).collect()}
    assert {i: found.get(i, i) for i in ids} == brute_components(ids, distance)


def test_long_chain_of_components(spark):
    edges = spark.range(0, 500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(
        spark.createDataFrame([(900, 901), (901, 900), (902, 902)], "a long, b long"))
    found = {r["id"]: r["component"] for r in simhash.components(edges).collect()}
    assert found == {**dict.fromkeys(range(1, 501), 0), 901: 900}
