import pytest

from basketloom.operators.lookup import build_lookup
from basketloom.sources import files
from basketloom.streaming.ingest import answer_stream, ingest_orders_incremental

HEADER = "documenttype,orderid,userid,productid,orderdt,quantity,priceperunit,origin"


def write_orders(path, start, n):
    lines = [f"{'order' if i % 5 else 'return'},{i},k{i % 3},p{i % 4},2024-01-01 10:00:00,2,1.5,app"
             for i in range(start, start + n)]
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_order_csv_types(spark, tmp_path):
    df = files.read_orders_csv(spark, write_orders(tmp_path / "a.csv", 0, 10))
    kinds = dict(df.dtypes)
    assert kinds["orderid"] == kinds["orderdt"] == kinds["origin"] == "string"
    assert kinds["quantity"] == kinds["priceperunit"] == "double"
    assert df.count() == 10


@pytest.mark.parametrize("split_bytes", ["128m", "300b"])
def test_head_and_tail_per_file(spark, tmp_path, split_bytes):
    paths = [write_orders(tmp_path / "a.csv", 0, 50), write_orders(tmp_path / "b.csv", 100, 30)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        def got(**how):
            return sorted(int(r["orderid"]) for r in files.sample_orders_csv(spark, paths, **how).collect())
        assert got(n_rows=20) == [*range(0, 10), *range(100, 110)]
        assert got(n_rows=20, sample_position="tail") == [*range(40, 50), *range(120, 130)]
        assert got(n_rows=1) == [0, 100]                    # at least one row per file
        assert len(got(n_rows=1000)) == 80
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(ValueError):
        files.sample_orders_csv(spark, paths, sample_position="middle")


def test_files_of_different_headers(spark, tmp_path):
    """Columns meet by name, whatever their order in a file; one that a file lacks is NULL."""
    (tmp_path / "a.csv").write_text("orderid,userid,quantity\n1,u1,2\n")
    (tmp_path / "b.csv").write_text("userid,orderid,quantity,extra\nu2,2,3,x\n")
    (tmp_path / "c.csv").write_text("orderid,userid,quantity\n3,u3,4\n")
    want = {("1", "u1", 2.0, None), ("2", "u2", 3.0, "x"), ("3", "u3", 4.0, None)}
    for paths in (str(tmp_path), [str(tmp_path / n) for n in ("b.csv", "a.csv", "c.csv")]):
        rows = files.read_orders_csv(spark, paths).select("orderid", "userid", "quantity", "extra").collect()
        assert {tuple(r) for r in rows} == want
        assert {r["orderid"] for r in files.sample_orders_csv(spark, paths, 3).collect()} == {"1", "2", "3"}


def test_products_and_commerces(spark, tmp_path):
    (tmp_path / "p.csv").write_text("productid;name;category;blocked\n1;A;x;false\n2;B;y;True\n3;C;z;\n")
    (tmp_path / "c.csv").write_text("userid;channel;region;active\n007;web;north;true\n8;shop;south;false\n")
    assert [r["productid"] for r in files.read_products(spark, str(tmp_path / "p.csv")).collect()] == ["1"]
    assert files.read_products(spark, str(tmp_path / "p.csv"), filter_blocked=False).count() == 3
    stores = files.read_commerces(spark, str(tmp_path / "c.csv")).collect()
    assert [(r["userid"], r["active"]) for r in stores] == [("007", True), ("8", False)]


def test_parquet_round_trip(spark, tmp_path):
    out = str(tmp_path / "t")
    for n in (5, 3):
        files.write_parquet(spark.range(n), out)
    assert files.read_orders_parquet(spark, out).count() == 3       # overwritten
    assert any(name.name.endswith(".zstd.parquet") for name in (tmp_path / "t").iterdir())
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        files.read_orders_parquet(spark, str(tmp_path / "absent"))


def test_incremental_ingest_takes_each_file_once(spark, tmp_path):
    folder, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    folder.mkdir()
    write_orders(folder / "a.csv", 0, 20)
    assert ingest_orders_incremental(spark, str(folder), out, mark).count() == 16
    write_orders(folder / "b.csv", 100, 10)
    assert ingest_orders_incremental(spark, str(folder), out, mark).count() == 24
    assert ingest_orders_incremental(spark, str(folder), out, mark).count() == 24


def test_streamed_requests(spark, tmp_path):
    lookup = build_lookup(spark.createDataFrame(
        [("k", "a", "x", 0.5), ("k", "a", "y", 0.9)],
        "kiosk_id string, anchor_product_id string, candidate_product_id string, score double"))
    asked = str(tmp_path / "asked")
    spark.createDataFrame([("a", "k", 1), ("b", "k", 3)], "anchor_id string, kiosk_id string, limit int").write.parquet(asked)
    stream = spark.readStream.schema("anchor_id string, kiosk_id string, limit int").parquet(asked)
    answer_stream(stream, lookup, str(tmp_path / "answers"), str(tmp_path / "mark")).awaitTermination()
    assert [(r["anchor_id"], r["product_id"]) for r in spark.read.parquet(str(tmp_path / "answers")).collect()] == [("a", "y")]


def test_yearly_files_are_sorted_in_ranges(spark, monkeypatch):
    """One file a year in the order of all columns, put together from ranges that are sorted apart; equal and missing values stay."""
    from types import SimpleNamespace

    from basketloom.checks import file_queries

    rows = [("order", str(i % 90), str(i % 7), f"p{i % 5}", f"199{i % 3}-0{1 + i % 9}-01 00:00:00" if i % 10 else None, float(i % 4)) for i in range(600)]
    raw = spark.createDataFrame(rows, "documenttype string, orderid string, userid string, productid string, orderdt string, quantity double")
    seen, union = [], file_queries.files.union_by_name
    monkeypatch.setattr(file_queries.files, "union_by_name", lambda parts: seen.append(len(parts)) or union(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = file_queries._yearly_files(SimpleNamespace(spark=spark, raw=raw))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(seen) == 4 and max(seen) > 1
    by_year = {}
    for row in rows:
        by_year.setdefault((row[4] or "none")[:4], []).append(row)
    got = {}
    for file in spark.read.text(path).inputFiles():
        lines = [tuple(r) for r in spark.read.option("header", True).csv(file).select("orderdt", "orderid", "productid", "quantity", "documenttype", "userid").collect()]
        assert lines == sorted(lines, key=lambda line: [v or "" for v in line])
        got[(lines[0][0] or "none")[:4]] = lines
    assert {y: sorted(map(repr, v)) for y, v in got.items()} == {
        y: sorted(repr((r[4], r[1], r[3], str(r[5]), r[0], r[2])) for r in v) for y, v in by_year.items()}
