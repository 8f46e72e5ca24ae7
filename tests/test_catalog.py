import pytest

from basketloom.functions.scaling import minmax_scale_to_range, value_range
from basketloom.operators import catalog as ct
from basketloom.operators import lookup as lk
from tests.conftest import rows_of

DAY = "2024-01-01"
PREDICTION = "kiosk_id string, anchor_product_id string, candidate_product_id string, score double"


@pytest.fixture
def info(spark):
    return ct.product_info(spark.createDataFrame(
        [("a", "Apple", "fruit"), ("b", "Beer", "drink"), ("c", "Cola", "drink"), ("c", "Cola", "drink"), ("n", "Nil", None)],
        "productid string, name string, category string"))


@pytest.fixture
def scored(spark):
    return spark.createDataFrame([("k", "a", "b", 2.0), ("k", "a", "c", 3.0), ("k", "a", "n", 1.0), ("m", "b", "c", -4.0)],
                                 PREDICTION)


def test_catalog_keeps_the_best_with_names(scored, info):
    out = ct.predictions_catalog(scored, info, 2)
    assert rows_of(out) == [("k", "a", "Apple", "b", "Beer", "drink", 2.0), ("k", "a", "Apple", "c", "Cola", "drink", 3.0),
                            ("m", "b", "Beer", "c", "Cola", "drink", -4.0)]


def test_coverage(spark, scored, info):
    out = ct.predictions_catalog(scored, info, 2)
    active = spark.createDataFrame([("k",), ("m",), ("x",), ("y",)], "kiosk_id string")
    row = ct.catalog_coverage(out, active).first()
    assert (row["n_rows"], row["n_queries"], row["n_kiosks"], row["n_active"], row["coverage_pct"]) == (3, 2, 2, 4, 50.0)
    assert ct.catalog_coverage(out).first()["coverage_pct"] == 100.0
    assert ct.catalog_coverage(scored, active, 2).first() == row
    assert ct.catalog_coverage(out, active.limit(0)).first()["coverage_pct"] == 100.0
    assert ct.catalog_coverage(out.limit(0)).first()["coverage_pct"] == 0.0


def test_scaling(spark, scored):
    df = spark.createDataFrame([(1.0,), (2.0,), (5.0,)], "x double")
    assert [r["score"] for r in minmax_scale_to_range(df, "x", (-8, 4)).orderBy("x").collect()] == [-8.0, -5.0, 4.0]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert {r["score"] for r in minmax_scale_to_range(flat, "x", (-8, 4)).collect()} == {-8.0}
    ends = minmax_scale_to_range(df, "x", value_range(scored, "score")).orderBy("x").collect()
    assert (ends[0]["score"], ends[-1]["score"]) == (-4.0, 3.0)


def test_fallbacks(spark, order_lines, info):
    orders = order_lines([("k", str(i), p, DAY) for i, p in enumerate("bbbccann")])
    best = ct.category_fallback(orders, info, (0.0, 1.0), 1)
    assert [(r["category"], r["candidate_product_id"]) for r in best.orderBy("category").collect()] == [
        ("drink", "b"), ("fruit", "a")]     # a product without category has no row
    overall = ct.global_fallback(orders, info, (0.0, 1.0), 3).orderBy("score", ascending=False).collect()
    assert [r["candidate_product_id"] for r in overall][0] == "b"
    assert (overall[0]["score"], overall[-1]["score"]) == (1.0, 0.0)
    topk = spark.createDataFrame([("a", "b", 0.2), ("a", "c", 0.4), ("b", "c", 0.3)],
                                 "anchor_product_id string, candidate_product_id string, cooc_cosine_sim double")
    rows = {(r["anchor_product_id"], r["candidate_product_id"]): r["score"]
            for r in ct.anchor_fallback(topk, info, (0.0, 1.0), 1).collect()}
    assert rows == {("a", "c"): pytest.approx(1.0), ("b", "c"): pytest.approx(0.0)}


@pytest.fixture
def lookup(scored):
    return lk.build_lookup(scored)


def test_requests(spark, lookup):
    requests = spark.createDataFrame([("a", "k", 2), ("a", "k", None), ("a", "k", -1), ("a", "zz", 5)],
                                     "anchor_id string, kiosk_id string, limit int")
    out = lk.recommend_requests(requests, lookup, "m1")
    assert out.columns == ["anchor_id", "kiosk_id", "product_id", "position", "model_id", "recommendation_date"]
    assert sorted((r["product_id"], r["position"]) for r in out.collect()) == [
        ("b", 2), ("b", 2), ("c", 1), ("c", 1), ("n", 3)]
    assert {r["model_id"] for r in out.collect()} == {"m1"}
    assert lk.valid_limits(requests).count() == 2
    assert out.first()["recommendation_date"].endswith("Z")
    no_limit = lk.recommend_requests(requests.drop("limit").limit(1), lookup)
    assert no_limit.count() == 3


def test_multi_answers_every_request(spark, lookup):
    requests = spark.createDataFrame([("a", "k"), ("q", "k")], "anchor_id string, kiosk_id string")
    out = {r["anchor_id"]: r["recs"] for r in lk.recommend_multi(requests, lookup).collect()}
    assert out == {"a": ["c", "b", "n"], "q": []}


def test_lookup_needs_its_columns(scored):
    with pytest.raises(ValueError, match="score"):
        lk.build_lookup(scored.drop("score"))


def test_fallback_levels(spark, order_lines, scored, lookup, info):
    orders = order_lines([("k", str(i), p, DAY) for i, p in enumerate("bbbcca")])
    topk = spark.createDataFrame([("a", "b", 0.2)],
                                 "anchor_product_id string, candidate_product_id string, cooc_cosine_sim double")
    requests = spark.createDataFrame([("a", "k", 1), ("a", "new", 1), ("c", "new", 1), ("none", "new", 1)],
                                     "anchor_id string, kiosk_id string, limit int")
    out = lk.recommend_with_fallback(
        requests, lookup, ct.anchor_fallback(topk, info, (0, 1)), ct.category_fallback(orders, info, (0, 1)),
        ct.global_fallback(orders, info, (0, 1)), info)
    assert sorted((r["level"], r["anchor_id"], r["product_id"]) for r in out.collect()) == [
        (1, "a", "c"), (2, "a", "b"), (3, "c", "b"), (4, "none", "b")]
