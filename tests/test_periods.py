"""Calendars, repurchase gaps, sketches, catalog changes and the laid-out lookup."""

import uuid

import pytest
from pyspark.sql import functions as F

from basketloom.operators import calendar as cal
from basketloom.operators import changes as ch
from basketloom.operators import labels as lb
from basketloom.operators import lookup as lk
from basketloom.operators import repurchase as rp
from basketloom.operators import sketches as sk
from basketloom.operators import training_set as ts
from basketloom.operators.baskets import build_baskets
from tests.conftest import rows_of


@pytest.fixture(params=["UTC", "America/New_York"])
def session_zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_days_across_a_clock_change(spark, order_lines, session_zone):
    """In Berlin 2024-03-31 had 23 hours and 2024-10-27 25; its days begin at 23:00 or 22:00 UTC."""
    orders = order_lines([("b", "1", "p", "2024-03-30 22:59:59"), ("b", "2", "p", "2024-03-30 23:00:00"), ("b", "3", "p", "2024-03-31 21:59:59"),
                          ("b", "4", "p", "2024-03-31 22:00:00"), ("b", "5", "p", "2024-10-26 22:00:00"), ("b", "6", "p", "2024-10-27 22:59:59"),
                          ("u", "7", "p", "2024-03-31 22:00:00"), ("b", "8", "p", None)])
    zones = spark.createDataFrame([("b", "Europe/Berlin"), ("b", "Europe/Berlin"), ("x", "Asia/Tokyo")], "kiosk_id string, zone string")
    got = [(r["kiosk_id"], str(r["day"]), r["lines"], r["hours"]) for r in cal.local_daily_totals(orders, zones).collect()]
    assert sorted(got) == [("b", "2024-03-30", 1, 24.0), ("b", "2024-03-31", 2, 23.0), ("b", "2024-04-01", 1, 24.0),
                           ("b", "2024-10-27", 2, 25.0), ("u", "2024-03-31", 1, 24.0)]


def test_window_and_split_end_at_local_midnights(spark, order_lines, session_zone):
    orders = order_lines([("b", "1", "p", "2024-03-30 22:30:00"), ("b", "2", "p", "2024-03-30 23:30:00"), ("u", "3", "p", "2024-03-30 23:30:00"),
                          ("u", "4", "p", "2024-03-31 00:00:00"), ("b", "5", "p", "2024-03-31 20:00:00"), ("u", "6", "p", None)])
    zones = spark.createDataFrame([("b", "Europe/Berlin")], "kiosk_id string, zone string")
    window = cal.inference_window_local(orders, zones, 1)
    assert sorted(r["order_id"] for r in window.collect()) == ["2", "4", "5"]
    split = {r["order_id"]: r["split"] for r in cal.split_by_local_day(orders, zones, "2024-03-31", "2024-04-01").collect()}
    assert split == {"1": "train", "2": "val", "3": "train", "4": "val", "5": "val", "6": None}


def test_gaps_and_recent_lines(order_lines):
    orders = order_lines([("a", "1", "p", "2024-01-01 10:00:00"), ("a", "2", "p", "2024-01-01 11:00:00"), ("a", "3", "p", "2024-01-30 00:00:00"),
                          ("a", "4", "p", "2024-01-31 00:00:00"), ("a", "5", "q", "2024-01-31 00:00:00"), ("a", "6", "p", None)])
    gaps = rp.repurchase_gaps(rp.purchase_days(orders))
    got = sorted((r["product_id"], str(r["day"]), r["lines"], r["gap_days"], r["next_gap_days"], r["recent_lines"]) for r in gaps.collect())
    assert got == [("p", "2024-01-01", 2, None, 29, 2), ("p", "2024-01-30", 1, 29, 1, 3), ("p", "2024-01-31", 1, 1, None, 2),
                   ("q", "2024-01-31", 1, None, None, 1)]
    summary = {r["product_id"]: (r["n_days"], r["min_gap"], r["mean_gap"], r["max_gap"]) for r in rp.repurchase_summary(gaps).collect()}
    assert summary == {"p": (3, 1, 15.0, 29), "q": (1, None, None, None)}


def test_sketches_of_days_merge(spark, order_lines):
    orders = order_lines([(f"k{i % 700}", f"o{i // 3}", f"p{i % 900}", f"2024-01-{i % 9 + 1:02d} 00:00:00") for i in range(6000)])
    part = F.when(F.col("order_dt") < "2024-01-04", "early").otherwise("late")
    daily = sk.day_sketches(orders, part)
    assert daily.count() == 9
    for row in sk.sketched_profile(daily, "split").collect():
        exact = orders.where(part == row["split"]).agg(F.count_distinct("kiosk_id"), F.count_distinct("product_id"), F.count("*")).first()
        assert abs(row["n_kiosks"] - exact[0]) <= sk.HLL_ERROR * exact[0] and abs(row["n_products"] - exact[1]) <= sk.HLL_ERROR * exact[1]
        assert row["n_rows"] == exact[2]
    baskets = build_baskets(orders, 1, None).withColumn("shop", F.substring("kiosk_id", 1, 2))
    sizes = sk.sketched_sizes(sk.size_sketches(baskets, "shop"), {"median": 0.5, "top": 1.0}).first()
    assert sizes["n_baskets"] == baskets.count() and sizes["top"] == baskets.agg(F.max(F.size("products"))).first()[0]
    assert sk.sketched_profile(sk.day_sketches(orders.limit(0), part), "split").count() == 0


def test_catalog_changes(spark):
    schema = "kiosk_id string, anchor_product_id string, candidate_product_id string, score double"
    before = spark.createDataFrame([("a", "x", "p", 3.0), ("a", "x", "q", 2.0), ("a", "x", "r", 2.0), ("b", "x", "p", 1.0)], schema)
    after = spark.createDataFrame([("a", "x", "r", 5.0), ("a", "x", "p", 3.0), ("a", "x", "s", 1.0), ("b", "x", "p", 9.0)], schema)
    changes = ch.catalog_changes(before, after)
    assert rows_of(changes) == [("a", "x", "p", 1, 2, "down", -1), ("a", "x", "q", 2, None, "left", None), ("a", "x", "r", 3, 1, "up", 2),
                                ("a", "x", "s", None, 3, "entered", None), ("b", "x", "p", 1, 1, "same", 0)]
    assert rows_of(ch.change_summary(changes)) == [("a", "x", 1, 1, 2, 0, 3), ("b", "x", 0, 0, 0, 1, 0)]
    assert ch.rows_in_both(before, after).count() == 1 and ch.rows_in_one(before, after).count() == 6
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1, plan
    assert ch.catalog_changes(before.limit(0), after.limit(0)).count() == 0


def test_the_catalog_side_is_not_moved(spark, tmp_path):
    schema = "kiosk_id string, anchor_product_id string, candidate_product_id string, score double"
    predictions = spark.createDataFrame([(f"k{i % 7}", f"a{i % 5}", f"c{i}", float(i)) for i in range(300)], schema)
    name = f"lookup_{uuid.uuid4().hex}"
    table = lk.write_lookup(lk.build_lookup(predictions), name, str(tmp_path / "lookup"), 4)
    requests = spark.createDataFrame([(f"a{i % 6}", f"k{i % 8}") for i in range(48)], "anchor_id string, kiosk_id string")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        answers = lk.recommend_requests(requests, table)
        plan = answers._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, plan
        want = lk.recommend_requests(requests, lk.build_lookup(predictions))
        assert rows_of(answers.drop("recommendation_date")) == rows_of(want.drop("recommendation_date")) != []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {name}")


def test_large_nodes_of_the_window_tree_are_cut(order_lines):
    """Nodes of more products than a cell holds give the same counts as whole ones."""
    orders = order_lines([("a", f"{i}", f"p{i % 13}", f"2024-01-{i % 20 + 1:02d} 0{i % 7}:00:00") for i in range(120)])
    width = 7 * 86_400_000_000
    events = lb._window_events(orders, "order_dt", width)
    keys = ["kiosk_id", "anchor_product_id", "candidate_product_id"]
    want = rows_of(lb._bucket_pairs(events, width).groupBy(*keys).agg(F.sum("pairs")))
    for cell in (3, 1000):
        assert rows_of(lb._tree_pairs(events, width, cell).groupBy(*keys).agg(F.sum("pairs"))) == want


def test_an_empty_split_has_a_row(spark):
    rows = spark.createDataFrame([("k", "a", "c", 1), ("k", "a", "d", 0)], "kiosk_id string, anchor_product_id string, candidate_product_id string, label int")
    got = rows_of(ts.split_summary({"train": rows, "val": rows.limit(0)}))
    assert got == [("train", 2, 1, 1, 50.0, 1, 2.0), ("val", 0, 0, 0, 0.0, 0, 0.0)]
