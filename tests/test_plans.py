"""Files to model, model to catalog, catalog to reports, on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from basketloom.operators.ranker import Ranker, RankerParams
from basketloom.plans.analysis import ReportParams, novelty_report, personalization_report, reports_from_files, score_test_period
from basketloom.plans.scoring import ScoringParams, generate_predictions
from basketloom.plans.training import TrainingParams, run_training
from basketloom.sources.star import StarTables

PARAMS = TrainingParams(
    min_cooc=2, min_lift=1.0, top_k=20, label_window_days=30, max_neg_per_group=10, max_eval_queries=100, eval_ks=[5, 10],
    ranker=RankerParams(learning_rate=0.2, max_depth=3, min_data_in_leaf=5, num_boost_round=2, eval_ks=(5,)))


@pytest.fixture(scope="module")
def folder(spark, data_dir, tmp_path_factory):
    out = tmp_path_factory.mktemp("files")
    tables = StarTables(spark, data_dir)
    raw = tables.raw_orders().withColumn("orderdt", F.col("orderdt").cast("string"))
    raw.coalesce(1).write.option("header", True).csv(str(out / "orders"))
    for name, df in (("products", tables.all_products()), ("commerces", tables.commerces())):
        df.coalesce(1).write.option("header", True).option("sep", ";").csv(str(out / name))
    return out


@pytest.fixture(scope="module")
def result(spark, folder):
    return run_training(
        spark, raw_paths=[str(folder / "orders")], interim_path=str(folder / "interim"),
        products_path=str(folder / "products"), commerces_path=str(folder / "commerces"),
        model_path=str(folder / "model"), n_rows=0, params=PARAMS, eval_log_path=str(folder / "curve"))


def test_training_reports(spark, result, folder):
    parts = {r["split"]: r for r in result.summary.collect()}
    assert set(parts) == {"train", "val", "test"}
    assert all(row["n_rows"] == row["pos"] + row["neg"] and row["pos"] > 0 for row in parts.values())
    assert parts["test"]["queries"] <= 100
    assert result.metrics.count() == 12
    assert all(r["value"] >= 0 for r in result.metrics.collect())
    recall = result.recall.first()
    assert 0 < recall["hits"] <= recall["total_pos"]
    assert spark.read.option("header", True).csv(str(folder / "curve")).columns == [
        "iteration", "dataset", "metric", "value"]
    # Only the cleaning is in the interim table: store and product filters come later.
    assert spark.read.parquet(str(folder / "interim")).count() == 4032


def test_catalog_files(spark, result, folder):
    tables = generate_predictions(
        spark, orders_path=str(folder / "interim"), products_path=str(folder / "products"),
        commerces_path=str(folder / "commerces"), model_path=str(folder / "model"), out_folder=str(folder / "catalog"),
        params=ScoringParams(last_n_days=0, min_cooc=2, min_lift=1.0, top_k_candidates=20, catalog_top_k=5))
    written = spark.read.parquet(str(folder / "catalog" / "predictions"))
    assert written.columns == ["kiosk_id", "anchor_product_id", "anchor_name", "candidate_product_id",
                               "candidate_name", "category", "score"]
    per_query = written.groupBy("kiosk_id", "anchor_product_id").count()
    assert per_query.agg(F.max("count")).first()[0] <= 5
    low, high = written.agg(F.min("score"), F.max("score")).first()
    overall = spark.read.parquet(str(folder / "catalog" / "overall"))
    assert overall.count() == 5
    assert overall.agg(F.min("score")).first()[0] <= high
    assert tables.coverage.first()["n_rows"] == written.count()


def test_reports_on_scored_stores(spark, result, data_dir, folder):
    tables = StarTables(spark, data_dir)
    orders = spark.read.parquet(str(folder / "interim"))
    scored = score_test_period(orders, tables.products(), tables.commerces(),
                               Ranker.load(spark, str(folder / "model")), n_kiosks=30, min_lift=1.0)
    assert scored.select("kiosk_id").distinct().count() <= 30
    for name, table in {**personalization_report(scored, tables.products()),
                        **novelty_report(scored, tables.products())}.items():
        assert not table.isEmpty(), name


def test_reports_from_files(spark, result, data_dir, folder):
    """The written tables are those of the same plan on tables; nothing else is left in the scratch folder."""
    paths = {"raw_paths": [str(folder / "orders")], "interim_path": str(folder / "again"), "products_path": str(folder / "products"),
             "commerces_path": str(folder / "commerces"), "model_path": str(folder / "model"), "out_folder": str(folder / "reports")}
    tables = reports_from_files(spark, **paths, params=ReportParams(n_kiosks=30, min_lift=1.0))
    assert {name.split("/")[0] for name in tables} == {"personalization", "novelty"} and len(tables) == 13
    star = StarTables(spark, data_dir)
    scored = score_test_period(spark.read.parquet(str(folder / "interim")), star.products(), star.commerces(),
                               Ranker.load(spark, str(folder / "model")), n_kiosks=30, min_lift=1.0)
    want = novelty_report(scored, star.products())
    for name in ("totals", "by_position", "pool"):
        assert sorted(map(tuple, tables[f"novelty/{name}"].collect())) == sorted(map(tuple, want[name].collect())), name
    with pytest.raises(ValueError, match="no such report: sales"):
        reports_from_files(spark, **paths, reports=["sales"])
