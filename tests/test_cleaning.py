import pytest

from basketloom.operators import cleaning as cl
from basketloom.sources.files import unblocked
from tests.conftest import rows_of

RAW = "documenttype string, orderid string, userid string, productid string, orderdt string, quantity double"


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def test_only_real_orders_with_quantity_survive(spark):
    df = cl.preprocess_orders(raw(
        spark, ("order", "1", "k", "a", "2024-01-01", 1.0), ("order", "1", "k", "a", "2024-01-01", 1.0),
        ("return", "2", "k", "a", "2024-01-01", 1.0), (None, "3", "k", "a", "2024-01-01", 1.0),
        ("order", "4", "k", "a", "2024-01-01", 0.0), ("order", "5", "k", "a", "2024-01-01", -2.0),
        ("order", "6", "k", "a", "2024-01-01", None)))
    assert [row["order_id"] for row in df.collect()] == ["1", "1"]      # duplicates stay
    assert df.columns == ["order_id", "kiosk_id", "product_id", "order_dt", "quantity"]
    assert dict(df.dtypes)["order_dt"] == "timestamp_ntz"


def test_unreadable_date_fails_the_check(spark):
    df = raw(spark, ("order", "1", "k", "a", "no date", 1.0), ("order", "2", "k", "a", "2024-01-01 10:00:00", 1.0))
    assert cl.null_counts(cl.preprocess_orders(df)).first()["order_dt"] == 1
    with pytest.raises(ValueError, match="order_dt"):
        cl.preprocess_orders(df, check=True)


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="quantity"):
        cl.preprocess_orders(raw(spark, ("order", "1", "k", "a", "2024-01-01", 1.0)).drop("quantity"))


def test_null_ratio(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (4,)], "x int")
    assert cl.null_ratios(df, ["x"]).first()["x"] == 0.5


def test_blocked_products(spark, order_lines):
    products = spark.createDataFrame(
        [("a", "TRUE"), ("b", "false"), ("c", None)], "productid string, blocked string")
    assert [r["productid"] for r in unblocked(products).collect()] == ["b"]     # unknown flag: not in the catalog
    blocked = cl.blocked_product_ids(products)
    assert rows_of(blocked) == [("a",)]
    orders = order_lines([("k", "1", p, "2024-01-01") for p in "abc"])
    kept = cl.filter_blocked_products(orders, blocked)
    assert sorted(r["product_id"] for r in kept.collect()) == ["b", "c"]        # but its order lines stay
    assert cl.blocked_product_ids(products.drop("blocked")).count() == 0


def test_active_kiosks(spark, order_lines):
    orders = order_lines([(k, k, "a", "2024-01-01") for k in ("1", "2", "3")])
    stores = spark.createDataFrame(
        [("1", True), ("1", True), ("2", False), (None, True)], "userid string, active boolean")
    kept, left = cl.filter_active_kiosks(orders, stores)
    assert [r["kiosk_id"] for r in kept.collect()] == ["1"]     # a store listed twice does not double its orders
    assert left.count() == 3
    same, _ = cl.filter_active_kiosks(orders, stores.drop("active"))
    assert same.count() == 3


def test_inference_window_and_cap(order_lines):
    orders = order_lines([("k", str(i), "a", f"2024-01-{i:02d}") for i in range(1, 21)])
    assert cl.inference_window(orders, 5).count() == 6      # both ends of the window
    assert cl.inference_window(orders, 0).count() == 20
    newest = cl.inference_window(orders, 10, max_rows=3, leaf_rows=1)
    assert sorted(r["order_id"] for r in newest.collect()) == ["18", "19", "20"]
