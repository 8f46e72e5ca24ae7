import math

import pytest

from basketloom.operators import metrics as mt

SCHEMA = "kiosk_id string, anchor_product_id string, candidate_product_id string, label int, score double"


@pytest.fixture
def judged(spark):
    rows = [("k", "a", "p1", 0, 0.9), ("k", "a", "p2", 1, 0.8), ("k", "a", "p3", 0, 0.7), ("k", "a", "p4", 1, 0.6)]
    rows += [("k", "b", "p1", 1, 0.5), ("k", "b", "p2", 1, 0.4), ("k", "b", "p3", 1, 0.3)]      # more positives than k
    rows += [("k", "c", "p1", 0, 0.5), ("k", "c", "p2", 0, 0.4)]                                # no positive: left out
    rows += [("k", "d", "p1", 0, 0.5), ("k", "d", "p2", 0, 0.4), ("k", "d", "p3", 1, 0.3)]      # no hit in the top 2
    rows += [("k", "e", "p1", 1, 0.1)]                                                          # fewer rows than k
    return spark.createDataFrame(rows, SCHEMA)


def only(df):
    return df.first()[0]


def test_values_by_hand(judged):
    assert only(mt.hitrate_at_k(judged, 2)) == pytest.approx(3 / 4)
    assert only(mt.recall_at_k(judged, 2)) == pytest.approx((1 / 2 + 2 / 3 + 0 + 1) / 4)
    assert only(mt.precision_at_k(judged, 2)) == pytest.approx((1 / 2 + 1 + 0 + 1 / 2) / 4)
    assert only(mt.positives_at_k(judged, 2)) == pytest.approx((1 + 2 + 0 + 1) / 4)
    assert only(mt.mrr_at_k(judged, 2)) == pytest.approx((1 / 2 + 1 + 0 + 1) / 4)
    second = 1 / math.log2(3)
    assert only(mt.ndcg_at_k(judged, 2)) == pytest.approx((second / (1 + second) + 1 + 0 + 1) / 4)


def test_table_agrees_with_single_metrics(judged):
    table = {(r["metric"], r["k"]): r["value"] for r in mt.metrics_table(judged, [3, 2, 2, -1]).collect()}
    assert len(table) == 12
    for k in (2, 3):
        assert table["NDCG", k] == only(mt.ndcg_at_k(judged, k))
        assert table["Recall", k] == only(mt.recall_at_k(judged, k))
    assert {r["k"] for r in mt.metrics_table(judged).collect()} == {20}


def test_ties_fall_to_the_smaller_product(spark):
    df = spark.createDataFrame([("k", "a", "x", 1, 0.5), ("k", "a", "b", 0, 0.5)], SCHEMA)
    assert only(mt.hitrate_at_k(df, 1)) == 0.0


def test_empty_set(judged):
    none = judged.limit(0)
    for metric in (mt.hitrate_at_k, mt.ndcg_at_k, mt.mrr_at_k, mt.positives_at_k):
        assert only(metric(none, 2)) == 0.0
    for metric in (mt.recall_at_k, mt.precision_at_k):
        assert only(metric(none, 2)) is None


def test_coverage(judged):
    row = mt.eval_query_coverage(judged).first()
    assert (row["n_queries"], row["n_with_pos"], row["pct_with_pos"]) == (5, 4, 80.0)


def test_quantities(spark):
    judged = spark.createDataFrame([("k", "a", "x", 1, 0.9), ("k", "a", "y", 0, 0.1), ("k", "b", "x", 1, 0.9)], SCHEMA)
    orders = spark.createDataFrame(
        [("1", "k", "a", 1.0), ("1", "k", "x", 2.0), ("2", "k", "b", 1.0), ("2", "k", "x", 5.0), ("3", "k", "x", 50.0),
         ("4", "k", "a", 1.0)], "order_id string, kiosk_id string, product_id string, quantity double")
    # x lies in orders 1 and 2, which hold some valid anchor; both queries count both.
    assert only(mt.quantity_captured_at_k(judged, orders, 1)) == pytest.approx((7 + 7) / 2)
    # By own anchor: a has orders 1 and 4 with 2 of x, b has order 2 with 5 of x.
    assert only(mt.quantity_captured_per_order_at_k(judged, orders, 1)) == pytest.approx((2 / 2 + 5 / 1) / 2)
    assert only(mt.quantity_captured_at_k(judged.limit(0), orders, 1)) is None


def test_category_coverage_counts_unknown_as_one(spark):
    df = spark.createDataFrame(
        [("k", "a", "p1", 1, 0.9, "s"), ("k", "a", "p2", 0, 0.8, None), ("k", "a", "p3", 0, 0.7, "t"),
         ("k", "b", "p1", 0, 0.7, "t")], SCHEMA + ", candidate_category string")
    assert only(mt.category_coverage_lift_at_k(df, 2)) == 2.0
