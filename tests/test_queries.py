"""Registered queries against their SQL in DuckDB; BASKETLOOM_ALL=1 takes all of them."""

import math
import os

import pytest

import __spark_entry__ as entry_points

duckdb = pytest.importorskip("duckdb")

SOME = ["sample_orders_head", "sample_orders_tail", "last_orders", "read_products", "read_commerces", "read_orders_csv",
        "null_ratios", "split_orders_by_rows", "split_orders_by_rows_radix", "pairwise_jaccard", "sampled_jaccard", "split_feature_label", "select_top_k_candidates",
        "add_all_features", "feature_rows", "label_pairs_window", "label_pairs_window_busy", "label_pairs_same_order_large",
        "pair_cooccurrence_shared", "shuffle_within_query", "sample_negatives", "metrics_table", "quantity_captured_at_k",
        "predict_scores", "ranker_save_load",
        "fixed_score_stats", "lambda_gradients", "stump_nodes", "stump_importance", "stump_eval_curve", "label_pairs_stream", "running_candidates", "orders_profile_sketched", "basket_sizes_sketched", "catalog_changes",
        "catalog_change_summary", "catalog_rows_in_one", "repurchase_gaps", "repurchase_summary", "local_daily_totals",
        "inference_window_local", "split_by_local_day", "recommend_requests_bucketed", "split_summary", "orders_profile", "generate_candidates", "anchor_fallback", "recommend_with_fallback", "baseline_overlap",
        "personalization_report_files", "novelty_report_files"]
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def database(data_dir):
    connection = duckdb.connect()
    for name in os.listdir(data_dir):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{data_dir}/{name}'")
    return connection


def normal(frame):
    def cell(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return None
        return repr(float(value)) if isinstance(value, float) else str(value)
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted((tuple(map(cell, row)) for row in frame.itertuples(index=False)), key=str)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(ORACLES) if os.environ.get("BASKETLOOM_ALL") else SOME)
def test_same_rows(spark, data_dir, database, name):
    got = entry_points.queries()[name](spark, data_dir).toPandas()
    assert normal(got) == normal(database.execute(ORACLES[name]).df())
