import math
import random
from collections import Counter
from itertools import combinations, permutations

import pytest

from basketloom.operators import baskets as bk
from basketloom.operators import candidates as cd
from basketloom.operators.pairs import half_pairs_of_large_groups
from tests.conftest import rows_of

DAY = "2024-01-01"


def test_basket_size_bounds(order_lines):
    rows = [("k", f"o{n}", f"p{i:03d}", DAY) for n in (1, 2, 200, 201) for i in range(n)]
    rows += [("k", "o2", "p000", DAY)] * 3      # repeated lines are one product
    orders = order_lines(rows)
    kept = {r["order_id"]: r["products"] for r in bk.build_baskets(orders).collect()}
    assert {name: len(items) for name, items in kept.items()} == {"o2": 2, "o200": 200}
    assert kept["o200"] == sorted(kept["o200"])
    assert bk.basket_filter_counts(orders).first().asDict() == {
        "total_before": 4, "too_small": 1, "too_large": 1, "kept": 2}
    assert sorted(len(r["products"]) for r in bk.build_baskets(orders, max_items=None).collect()) == [2, 200, 201]
    assert bk.basket_filter_counts(orders, max_items=None).first().asDict() == {
        "total_before": 4, "too_small": 1, "too_large": 0, "kept": 3}


def test_baskets_are_gathered_in_the_order_of_the_cut(order_lines):
    """Windows gather the products, missing ids included; no aggregation sorts the lines a second time."""
    lines = [(k, o, p, DAY) for k in ("k", None) for o in ("o1", "o2", None) for p in ("c", "a", None, "b", "a")]
    baskets = bk.build_baskets(order_lines([*lines, ("k", "o3", "a", DAY), ("k", "o4", None, DAY)]))
    assert rows_of(baskets) == sorted(((k, o, ["a", "b", "c"]) for k in ("k", None) for o in ("o1", "o2", None)), key=repr)
    assert "ObjectHashAggregate" not in baskets._jdf.queryExecution().executedPlan().toString()


def test_basket_size_stats(order_lines):
    orders = order_lines([("k", f"o{n}", f"p{i}", DAY) for n in (2, 3, 7) for i in range(n)])
    row = bk.basket_size_stats(bk.build_baskets(orders)).first()
    assert (row["min_size"], row["mean_size"], row["median_size"], row["max_size"]) == (2, 4.0, 3.0, 7)


@pytest.mark.parametrize("cell_items", [1, 3, 100])
def test_block_join_gives_each_pair_once(spark, cell_items):
    items = [("g", f"p{i:02d}", i % 3 + 1) for i in range(20)] + [("h", "a", 1), ("h", "b", 5), ("one", "z", 1)]
    df = spark.createDataFrame(items, "g string, p string, w bigint")
    got = half_pairs_of_large_groups(df, ["g"], "p", "w", cell_items)
    want = [(g1, p1, p2, w1 * w2) for (g1, p1, w1), (g2, p2, w2) in combinations(sorted(items), 2) if g1 == g2]
    assert rows_of(got) == sorted(want, key=repr)


def brute_counts(baskets):
    by_order = {}
    for order_id, products in baskets:
        by_order.setdefault(order_id, []).extend(products)
    pairs = Counter()
    for items in by_order.values():
        for a, c in permutations(items, 2):
            if a != c:
                pairs[a, c] += 1
    return pairs


@pytest.mark.parametrize("shared_ids", [False, True])
def test_pair_counts_and_measures(spark, shared_ids):
    rng = random.Random(11)
    rows = [(f"k{i}", f"o{i % 7 if shared_ids else i}", sorted(rng.sample("abcdefgh", rng.randint(2, 5))))
            for i in range(30)]
    rows.append(("k99", "o99", ["a", "rare"]))
    baskets = spark.createDataFrame(rows, "kiosk_id string, order_id string, products array<string>")
    in_baskets = Counter(p for _, _, products in rows for p in products)
    counts = brute_counts([(o, p) for _, o, p in rows])
    got = {(r["anchor_product_id"], r["candidate_product_id"]): r for r in cd.generate_candidates(baskets, 2).collect()}
    assert {pair: row["cooc_count"] for pair, row in got.items()} == {
        pair: n for pair, n in counts.items() if n >= 2 and min(in_baskets[p] for p in pair) >= 2}
    for (a, c), row in got.items():
        both, total = counts[a, c], len(rows)
        assert row["lift"] == pytest.approx(both * total / (in_baskets[a] * in_baskets[c]))
        assert row["cooc_cosine_sim"] == pytest.approx(both / math.sqrt(in_baskets[a] * in_baskets[c]))
        assert row["support"] == pytest.approx(both / total)
        assert row["confidence"] == pytest.approx(both / in_baskets[a])
    assert not any("rare" in pair for pair in got)


def test_no_baskets_give_typed_empty_candidates(spark):
    none = spark.createDataFrame([], "kiosk_id string, order_id string, products array<string>")
    out = cd.generate_candidates(none)
    assert out.count() == 0
    assert dict(out.dtypes) == {
        "anchor_product_id": "string", "candidate_product_id": "string", "cooc_count": "bigint",
        "anchor_count": "bigint", "candidate_count": "bigint", "support": "double", "confidence": "double",
        "lift": "double", "cooc_cosine_sim": "double"}


def test_top_k_order_and_columns(spark):
    rows = [("a", "w", 2.0, 9, 0.1), ("a", "x", 3.0, 5, 0.2), ("a", "y", 3.0, 6, 0.3), ("a", "z", 3.0, 5, 0.4),
            ("a", "low", 0.5, 99, 0.9), ("b", "x", 1.0, 1, 0.5)]
    df = spark.createDataFrame(rows, "anchor_product_id string, candidate_product_id string, lift double, "
                                     "cooc_count bigint, cooc_cosine_sim double")
    out = cd.select_top_k_candidates(df, k=2, min_lift=1.0)
    assert out.columns == ["anchor_product_id", "candidate_product_id", "cooc_cosine_sim"]
    assert rows_of(out) == [("a", "x", 0.2), ("a", "y", 0.3), ("b", "x", 0.5)]
    stats = cd.topk_candidate_stats(out, 2).first()
    assert (stats["n_anchors"], stats["min_cands"], stats["max_cands"], stats["n_full"], stats["pct_full"]) == (2, 1, 2, 1, 50.0)
