import pytest

from basketloom.operators import features as ft
from tests.conftest import rows_of

DAY = "2024-01-01"
TOPK = "anchor_product_id string, candidate_product_id string, cooc_cosine_sim double"


def test_candidates_of_a_store_join_on_store_and_anchor(spark):
    baskets = spark.createDataFrame([("k1", "o1", ["a", "x"]), ("k2", "o2", ["a", "y"])],
                                    "kiosk_id string, order_id string, products array<string>")
    topk = spark.createDataFrame([("k1", "a", "c1", 2.0, 5), ("k2", "a", "c2", 3.0, 6)],
                                 "kiosk_id string, anchor_product_id string, candidate_product_id string, "
                                 "lift double, cooc_count int")
    queries = spark.createDataFrame([("k1", "a"), ("k2", "a")], "kiosk_id string, anchor_product_id string")
    for given in (queries, None):
        out = ft.build_feature_table(baskets, topk, given)
        assert rows_of(out.select("kiosk_id", "candidate_product_id")) == [("k1", "c1"), ("k2", "c2")]


def test_queries_come_from_baskets(spark):
    baskets = spark.createDataFrame([("k1", "o1", ["a", "b"]), ("k1", "o2", ["a", "c"])],
                                    "kiosk_id string, order_id string, products array<string>")
    topk = spark.createDataFrame([("a", "b", 0.5), ("c", "a", 0.2)], TOPK)
    assert rows_of(ft.build_feature_table(baskets, topk)) == [("k1", "a", "b", 0.5), ("k1", "c", "a", 0.2)]
    with pytest.raises(ValueError):
        ft.build_feature_table(baskets.drop("products"), topk)


@pytest.fixture
def parts(spark, order_lines):
    rows = spark.createDataFrame(
        [("k1", "a", "b", 0.5), ("k1", "a", "c", 0.4), ("k2", "a", "b", 0.5), ("new", "a", "zz", 0.1)],
        "kiosk_id string, " + TOPK)
    orders = order_lines([("k1", "1", "b", DAY), ("k1", "2", "b", DAY), ("k1", "3", "a", DAY), ("k2", "4", "c", DAY)])
    products = spark.createDataFrame([("a", "snack"), ("b", "snack"), ("c", "drink"), ("d", None), ("a", "snack")],
                                     "productid string, category string")
    stores = spark.createDataFrame([("k1", "web", "north"), ("k2", "shop", None), ("k2", "shop", None)],
                                   "userid string, channel string, region string")
    return rows, orders, products, stores


def test_optional_inputs_decide_the_columns(parts):
    rows, orders, products, stores = parts
    plain = ft.add_all_features(rows, orders=orders)
    assert "same_category" not in plain.columns and "channel" not in plain.columns
    assert "same_category" in ft.add_all_features(rows, orders=orders, products=products).columns
    assert "same_category" not in ft.add_all_features(rows, orders=orders, products=products.drop("category")).columns


def test_feature_values(parts):
    rows, orders, products, stores = parts
    out = ft.add_all_features(rows, orders=orders, products=products, commerces=stores)
    assert dict(out.dtypes)["cand_is_new"] == dict(out.dtypes)["same_category"] == "tinyint"
    values = {(r["kiosk_id"], r["candidate_product_id"]): (
        r["pop_store"], r["pop_global"], r["kiosk_product_cnt"], r["cand_is_new"], r["same_category"],
        r["channel"], r["region"]) for r in out.collect()}
    assert values == {
        ("k1", "b"): (2, 2, 3, 0, 1, "web", "north"), ("k1", "c"): (0, 1, 3, 1, 0, "web", "north"),
        ("k2", "b"): (0, 2, 1, 1, 1, "shop", None), ("new", "zz"): (0, 0, 0, 1, None, None, None)}
    assert out.count() == 5     # the store listed twice doubles its row


def test_single_features_agree_with_all(parts):
    rows, orders, products, stores = parts
    step = ft.feat_cand_is_new(ft.feat_kiosk_product_cnt(ft.feat_pop_global(ft.feat_pop_store(rows, orders), orders), orders))
    step = ft.feat_kiosk_meta(ft.feat_same_category(step, products), stores)
    whole = ft.add_all_features(rows, orders=orders, products=products, commerces=stores)
    assert rows_of(step.select(*whole.columns)) == rows_of(whole)


def test_filling_and_encoding(spark):
    df = spark.createDataFrame([(None, None, 1.5), (2, "web", None)], "pop_store bigint, channel string, x double")
    filled = ft.fill_missing_features(df, ["pop_store", "x"], ["channel"])
    assert rows_of(filled) == [(0, "__MISSING__", 1.5), (2, "web", 0.0)]
    full = ft.ensure_feature_columns(df, ["pop_store", "pop_global", "region"], ["channel", "region"])
    assert full.first()["pop_global"] == 0 and full.first()["region"] == "__MISSING__"
    codes = spark.createDataFrame([("BUILDING",), (None,)], "channel string").select(
        *ft.encode_features(["channel"], ["channel"])).collect()
    assert codes[0]["channel"] == 1999359697241702.0 and codes[1]["channel"] > 0


def test_zero_only(spark):
    df = spark.createDataFrame([(0, None, -1.0), (0, None, 0.0)], "a int, b double, c double")
    assert rows_of(ft.zero_only_features(df, ["a", "b", "c", "absent"])) == [("a",), ("b",)]


def test_feature_columns_from_schema(parts):
    rows, orders, products, stores = parts
    out = ft.add_all_features(rows, orders=orders, products=products, commerces=stores)
    numbers, kinds = ft.feature_columns(out)
    assert numbers == ["cand_is_new", "cooc_cosine_sim", "kiosk_product_cnt", "pop_global", "pop_store", "same_category"]
    assert kinds == ["channel", "region"]


@pytest.mark.parametrize("leaf_rows", [1, 1000])
def test_samples_are_reproducible(spark, leaf_rows):
    queries = spark.range(300).selectExpr("cast(id % 40 as string) kiosk_id", "cast(id as string) anchor_product_id")
    one = rows_of(ft.sample_queries(queries, 25, leaf_rows=leaf_rows))
    two = rows_of(ft.sample_queries(queries.repartition(7), 25))
    assert one == two and len(one) == 25
    assert one != rows_of(ft.sample_queries(queries, 25, seed=1))
    some = ft.sample_kiosks(queries, 5, leaf_rows=leaf_rows)
    assert some.select("kiosk_id").distinct().count() == 5
    assert ft.sample_kiosks(queries, 0).count() == 300
    assert ft.sample_queries(queries, 10_000).count() == 300
