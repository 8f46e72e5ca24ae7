import random

import pytest
from pyspark.sql import functions as F

from basketloom.functions.hashing import draw_key
from basketloom.functions.ranking import hash_ranked
from basketloom.operators import splits as sp
from basketloom.sources.files import first_orders, last_orders

RATIOS = {"train_ratio": 0.8, "val_ratio": 0.1, "test_ratio": 0.1}


def ids(df):
    return {r["order_id"] for r in df.collect()}


def sizes(split):
    return [df.count() for df in (split.train, split.val, split.test)]


def test_ratios_must_sum_to_one(order_lines):
    with pytest.raises(ValueError):
        sp.split_orders_by_time(order_lines([("k", "1", "a", "2024-01-01")]), train_ratio=0.5, val_ratio=0.1,
                                test_ratio=0.1)


def test_time_split_bounds(order_lines):
    orders = order_lines([("k", str(i), "a", f"2024-01-{i + 1:02d}") for i in range(11)])
    split = sp.split_orders_by_time(orders, **RATIOS)
    assert ids(split.train) == {str(i) for i in range(8)}
    assert ids(split.val) == {"8"}
    assert ids(split.test) == {"9", "10"}


@pytest.mark.parametrize("leaf_rows", [1, 7, 1000])
def test_equal_timestamps_split_by_rows(order_lines, leaf_rows):
    orders = order_lines([("k", str(i), "a", "2024-01-01") for i in range(50)])
    split = sp.split_orders_by_time(orders, **RATIOS, leaf_rows=leaf_rows)
    assert sizes(split) == [40, 5, 5]
    assert len(ids(split.train) | ids(split.val) | ids(split.test)) == 50


def test_empty_part_falls_back_to_rows(order_lines):
    orders = order_lines([("k", str(i), "a", "2024-01-01") for i in range(19)] + [("k", "x", "a", "2024-03-01")])
    split = sp.split_orders_by_time(orders, **RATIOS)
    assert sizes(split) == [16, 2, 2]
    assert "x" in ids(split.test)


@pytest.mark.parametrize("leaf_rows", [1, 5])
def test_row_positions_match_a_full_sort(order_lines, leaf_rows):
    rng = random.Random(3)
    rows = [("k", str(i), "a", f"2024-01-0{rng.randint(1, 3)} 00:{rng.randint(0, 2):02d}:{rng.randint(0, 2):02d}")
            for i in range(200)]
    orders = order_lines(rows)
    keyed = orders.withColumn("h", draw_key(0, "order_id", "product_id"))
    ordered = [r["order_id"] for r in keyed.orderBy("order_dt", "h").collect()]
    split = sp.split_orders_by_rows(orders, **RATIOS, leaf_rows=leaf_rows)
    assert ids(split.train) == set(ordered[:160])
    assert ids(split.val) == set(ordered[160:180])
    assert ids(first_orders(orders, 13, leaf_rows=leaf_rows)) == set(ordered[:13])
    assert ids(last_orders(orders, 13, leaf_rows=leaf_rows)) == set(ordered[-13:])
    assert first_orders(orders, 500).count() == 200


def test_exact_copies_are_counted(order_lines):
    orders = order_lines([("k", "1", "a", "2024-01-01")] * 30)
    assert sizes(sp.split_orders_by_rows(orders, **RATIOS, leaf_rows=1)) == [24, 3, 3]


@pytest.mark.parametrize("share", [0.0, 0.3, 0.999])
def test_feature_label_cut_on_distinct_times(order_lines, share):
    rng = random.Random(5)
    times = [f"2024-0{rng.randint(1, 2)}-01 10:{rng.randint(0, 3):02d}:0{rng.randint(0, 9)}.{rng.randint(0, 3)}"
             for _ in range(120)]
    orders = order_lines([("k", str(i), "a", t) for i, t in enumerate(times)])
    distinct = sorted({r["order_dt"] for r in orders.collect()})
    start = distinct[min(max(1, int(len(distinct) * (1.0 - share))), len(distinct) - 1)]
    early, late = sp.split_feature_label(orders, share)
    assert {r["order_dt"] for r in early.collect()} == {t for t in distinct if t < start}
    assert early.count() + late.count() == 120


def test_single_time_is_not_cut(order_lines):
    orders = order_lines([("k", str(i), "a", "2024-01-01") for i in range(4)])
    early, late = sp.split_feature_label(orders)
    assert early.count() == late.count() == 4


def test_hash_rank_equals_plain_rank(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    ranked = hash_ranked(df, ["g"], draw_key(1, "id"), ["id"], "r").withColumn("h", draw_key(1, "id")).collect()
    hot = sorted((row for row in ranked if row["g"] == "hot"), key=lambda row: row["h"])
    assert [row["r"] for row in hot] == list(range(1, 2001))
    assert all(row["r"] == 1 for row in ranked if row["g"] != "hot")


@pytest.mark.parametrize("kind", ["timestamp_ntz", "string"])
def test_lines_without_a_time_keep_their_place(spark, kind):
    """The same rows whether positions are found by counting or by sorting; missing times come first."""
    rows = [(str(i), "k", str(i % 3), None if i % 7 == 0 else f"2024-01-{1 + i % 9:02d} 10:00:{i % 60:02d}", 1.0) for i in range(40)]
    orders = spark.createDataFrame(rows, "order_id string, kiosk_id string, product_id string, order_dt string, quantity double")
    orders = orders.withColumn("order_dt", orders["order_dt"].cast(kind))
    for n in (1, 2, 6, 7, 20, 39, 40):
        for cut in (first_orders, last_orders):
            small, large = ({r["order_id"] for r in cut(orders, n, leaf_rows=leaf).collect()} for leaf in (100_000, 1))
            assert small == large and len(small) == n
    parts = [{r["order_id"] for r in p.collect()} for p in sp.split_orders_by_rows(
        orders, train_ratio=0.8, val_ratio=0.1, test_ratio=0.1, leaf_rows=1).named().values()]
    assert [len(p) for p in parts] == [32, 4, 4] and len(set.union(*parts)) == 40
