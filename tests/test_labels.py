import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from basketloom.operators import labels as lb
from basketloom.operators import training_set as ts
from tests.conftest import rows_of

KEYS = "kiosk_id string, anchor_product_id string, candidate_product_id string"


def brute_window(rows, days):
    counts = Counter()
    for k1, _, a, t1 in rows:
        for k2, _, c, t2 in rows:
            gap = datetime.fromisoformat(t2) - datetime.fromisoformat(t1)
            if k1 == k2 and a != c and timedelta(0) <= gap <= timedelta(days=days):
                counts[k1, a, c] += 1
    return sorted(((*key, n) for key, n in counts.items()), key=repr)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    start = datetime(1969, 12, 20)
    rows = []
    for i in range(n):
        moment = start + timedelta(days=rng.choice([0, 1, 2, 4, 9, 20]), seconds=rng.choice([0, 1, 3600, 86399]),
                                   microseconds=rng.choice([0, 1, 999999]))
        rows.append((rng.choice(["k", "k", "hot", "hot", "hot", "m"]), f"o{i}", rng.choice("abcde"), moment.isoformat(" ")))
    return rows


@pytest.mark.parametrize("busy_bucket", [0, 6, 10_000])
@pytest.mark.parametrize("days", [2, 7])
def test_window_labels_match_brute_force(order_lines, busy_bucket, days):
    rows = random_rows(days)
    got = lb.label_pairs_window(order_lines(rows), window_days=days, busy_bucket=busy_bucket)
    assert rows_of(got) == brute_window(rows, days)


@pytest.mark.parametrize("busy_bucket", [0, 1000])
def test_window_ends_are_inclusive_and_directed(order_lines, busy_bucket):
    rows = [("k", "1", "a", "2024-01-01 00:00:00"), ("k", "2", "b", "2024-01-08 00:00:00"),
            ("k", "3", "c", "2024-01-08 00:00:01"), ("k", "1", "d", "2024-01-01 00:00:00")]
    got = {row[1:3] for row in rows_of(lb.label_pairs_window(order_lines(rows), window_days=7, busy_bucket=busy_bucket))}
    assert ("a", "b") in got and ("b", "a") not in got
    assert ("a", "c") not in got                            # a second too late
    assert ("a", "d") in got and ("d", "a") in got          # the same order counts both ways


def test_tree_cells_do_not_change_counts(order_lines):
    rows = random_rows(8)
    events = lb._window_events(order_lines(rows), "order_dt", 7 * 86_400_000_000)
    pairs = lb._tree_pairs(events, 7 * 86_400_000_000, products_per_cell=1)
    got = pairs.groupBy("kiosk_id", "anchor_product_id", "candidate_product_id").sum("pairs")
    assert rows_of(got) == brute_window(rows, 7)


@pytest.mark.parametrize("array_items", [2, 200])
def test_same_order_labels(order_lines, array_items):
    rows = [("k", "1", p, "2024-01-01") for p in "abca"] + [("k", "2", p, "2024-01-02") for p in "ab"]
    rows += [("m", "1", "z", "2024-01-01")]
    got = rows_of(lb.label_pairs_same_order(order_lines(rows), array_items=array_items))
    assert got == [("k", "a", "b", 2), ("k", "a", "c", 1), ("k", "b", "a", 2), ("k", "b", "c", 1),
                   ("k", "c", "a", 1), ("k", "c", "b", 1)]


def test_min_count_and_missing_time(order_lines):
    rows = [("k", "1", p, "2024-01-01") for p in "ab"] + [("k", "2", p, "2024-01-02") for p in "abc"]
    assert len(rows_of(lb.build_label_pairs(order_lines(rows), min_cooc_label=2))) == 2
    with pytest.raises(ValueError):
        lb.build_label_pairs(order_lines(rows).drop("order_dt"), window_days=2)


def test_labels_are_tinyint_and_binary(spark, order_lines):
    rows = spark.createDataFrame([("k", "a", "b"), ("k", "a", "x")], KEYS)
    out = lb.build_labels(rows, order_lines([("k", "1", p, "2024-01-01") for p in "ab"]))
    assert dict(out.dtypes)["label"] == "tinyint"
    assert rows_of(out) == [("k", "a", "b", 1), ("k", "a", "x", 0)]


@pytest.fixture
def labeled(spark):
    rows = [("k", "mixed", f"n{i}", 0) for i in range(10)] + [("k", "mixed", "p", 1)]
    rows += [("k", "allpos", "p1", 1), ("k", "allpos", "p2", 1), ("k", "neg", "n1", 0), ("k", "neg", "n2", 0),
             ("k", "one", "p", 1)]
    return spark.createDataFrame(rows, KEYS + ", label int").withColumn("label", lb.F.col("label").cast("tinyint"))


def test_good_queries(labeled):
    kept = {r["anchor_product_id"] for r in ts.filter_good_queries(labeled).collect()}
    assert kept == {"mixed", "allpos"}      # one row only, or no positive: dropped


def test_negative_sampling(labeled):
    out = ts.sample_negatives(labeled, 3)
    assert out.filter("label = 1").count() == 4
    assert out.filter("anchor_product_id = 'mixed' and label = 0").count() == 3
    assert rows_of(out) == rows_of(ts.sample_negatives(labeled.repartition(5), 3))      # reproducible
    assert ts.sample_negatives(labeled, 0).count() == labeled.count()


def test_shuffle_is_a_permutation(labeled):
    out = ts.shuffle_within_query(labeled, seed=5)
    ranks = sorted(r["shuffle_rank"] for r in out.collect() if r["anchor_product_id"] == "mixed")
    assert ranks == list(range(1, 12))


def test_stats(labeled):
    row = ts.label_stats(labeled).first()
    assert (row["n_rows"], row["positives"], row["negatives"], row["queries"]) == (16, 4, 12, 4)
    empty = ts.label_stats(labeled.limit(0)).first()
    assert (empty["n_rows"], empty["positives"], empty["pos_ratio"]) == (0, 0, 0.0)


def test_candidate_recall(spark):
    pairs = spark.createDataFrame([("k", "a", "b"), ("k", "a", "c"), ("k", "z", "b")], KEYS)
    rows = spark.createDataFrame([("k", "a", "b"), ("k", "a", "x")], KEYS)
    out = lb.candidate_recall(rows.select("kiosk_id", "anchor_product_id").distinct(), rows, pairs).first()
    assert (out["total_pos"], out["hits"], out["recall"]) == (2, 1, 0.5)
    none = lb.candidate_recall(rows.select("kiosk_id", "anchor_product_id"), rows, pairs.limit(0)).first()
    assert none["recall"] is None


def test_unfolded_sides_of_busy_stores_are_not_broadcast(order_lines, capsys):
    """Their size is a multiple of the points' that the planner can't see."""
    lb.label_pairs_window(order_lines(random_rows(7)), window_days=7, busy_bucket=0).explain()
    met = [line for line in capsys.readouterr().out.splitlines() if "Join" in line and "frame" in line]
    assert met and all("SortMergeJoin" in line for line in met)
