"""Training plan: order files to labelled splits, a ranker and its offline evaluation."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from basketloom.functions.durable import collected, materialize, scratch
from basketloom.operators.baskets import build_baskets, kiosk_anchor_queries
from basketloom.operators.candidates import generate_candidates, select_top_k_candidates
from basketloom.operators.cleaning import (
    assert_not_null,
    blocked_product_ids,
    filter_active_kiosks,
    filter_blocked_products,
    preprocess_orders,
)
from basketloom.operators.features import FeatureFacts, attach_features, build_feature_table, feature_facts, sample_queries
from basketloom.operators.labels import build_label_pairs, candidate_recall, label_rows, queries_with_positives
from basketloom.operators.metrics import eval_query_coverage, metrics_table
from basketloom.operators.ranker import Ranker, RankerParams, predict_scores, train_ranker
from basketloom.operators.splits import split_feature_label, split_orders_by_time
from basketloom.operators.training_set import filter_good_queries, sample_negatives, split_summary
from basketloom.schema import QUERY_KEYS, ROW_KEYS
from basketloom.sources.files import (
    read_commerces,
    read_orders_csv,
    read_products,
    sample_orders_csv,
    unblocked,
    write_parquet,
)


@dataclass(frozen=True)
class TrainingParams:
    """The defaults of the training run, but for ``max_eval_queries``: 0 measures on all test queries."""

    train_ratio: float = 0.8
    val_ratio: float = 0.1
    test_ratio: float = 0.1
    train_label_ratio: float = 0.3
    min_cooc: int = 3
    min_lift: float = 2.0
    top_k: int = 100
    top_k_train: int | None = None
    label_window_days: int | None = 7
    min_cooc_label: int = 1
    max_neg_per_group: int = 60
    max_eval_queries: int = 0
    eval_ks: list[int] = field(default_factory=lambda: [20])
    ranker: RankerParams = RankerParams()


def build_labeled_split(*, query_orders: DataFrame, label_orders: DataFrame, facts: FeatureFacts,
                        topk: DataFrame, params: TrainingParams, keep_good: bool, draw_negatives: bool,
                        max_queries: int = 0, durable: bool = False) -> DataFrame:
    """Labelled feature rows of one period.

    Queries without positives go first, then labels and sampling work on keys
    alone; features are computed last, for the surviving rows only.
    """
    pairs = build_label_pairs(label_orders, window_days=params.label_window_days,
                              min_cooc_label=params.min_cooc_label).select(*ROW_KEYS)
    if durable:
        pairs = materialize(pairs)
    queries = queries_with_positives(kiosk_anchor_queries(build_baskets(query_orders)), pairs)
    if max_queries > 0:
        if durable:
            queries = materialize(queries)
        queries = sample_queries(queries, max_queries)
    labeled = label_rows(build_feature_table(None, topk, queries), pairs)
    if keep_good or draw_negatives:
        # Both read the rows several times; on real data they are written once.
        labeled = materialize(labeled) if durable else labeled
    if keep_good:
        labeled = filter_good_queries(labeled)
    if draw_negatives:
        labeled = sample_negatives(labeled, params.max_neg_per_group)
    columns = [name for name in labeled.columns if name != "label"]
    rows = attach_features(labeled, facts)
    return rows.select(*columns, *[name for name in rows.columns if name not in columns and name != "label"], "label")


@dataclass(frozen=True)
class LabeledSplits:
    train: DataFrame
    val: DataFrame
    test: DataFrame
    topk: DataFrame
    test_orders: DataFrame


def labeled_splits(orders: DataFrame, products: DataFrame | None, commerces: DataFrame | None,
                   params: TrainingParams = TrainingParams()) -> LabeledSplits:
    """Labelled train, validation and test rows from cleaned, written orders.

    Training features come from the earlier part of the training period and its
    labels from the later one; validation and test are labelled from their own
    period and described by the whole training period.
    """
    split = split_orders_by_time(orders, train_ratio=params.train_ratio, val_ratio=params.val_ratio,
                                 test_ratio=params.test_ratio)
    early, late = split_feature_label(split.train, params.train_label_ratio)
    baskets = materialize(build_baskets(split.train))
    k = max(1, min(params.top_k_train or params.top_k, params.top_k))
    candidates = generate_candidates(baskets, params.min_cooc)
    topk = materialize(select_top_k_candidates(candidates, k, params.min_lift))

    def part(queries: DataFrame, labels: DataFrame, facts: FeatureFacts, shaped: bool, cap: int = 0) -> DataFrame:
        return materialize(build_labeled_split(
            query_orders=queries, label_orders=labels, facts=facts, topk=topk, params=params, keep_good=shaped,
            draw_negatives=shaped, max_queries=cap, durable=True))

    early_facts = feature_facts(early, products, commerces, durable=True)
    facts = feature_facts(split.train, products, commerces, durable=True)
    return LabeledSplits(
        part(early, late, early_facts, True), part(split.val, split.val, facts, True),
        part(split.test, split.test, facts, False, params.max_eval_queries), topk, split.test)


@dataclass(frozen=True)
class TrainingResult:
    ranker: Ranker
    summary: DataFrame
    recall: DataFrame
    coverage: DataFrame
    metrics: DataFrame


def train_and_evaluate(splits: LabeledSplits, params: TrainingParams = TrainingParams(),
                       model_path: str | None = None, may_be_empty: bool = False) -> TrainingResult:
    """Train on the labelled splits, save the model, then measure it on the test rows.

    ``may_be_empty``: a history without anything to learn from gives a model without trees instead of an error.
    """
    spark = splits.train.sparkSession
    # The metrics of the final table are those that training watches.
    ranker = train_ranker(splits.train, splits.val, replace(params.ranker, eval_ks=tuple(sorted(params.eval_ks))),
                          may_be_empty=may_be_empty)
    if model_path:
        ranker.save(spark, model_path)
    scored = materialize(predict_scores(splits.test, ranker).select(*ROW_KEYS, "label", "score"))
    pairs = build_label_pairs(splits.test_orders, window_days=params.label_window_days,
                              min_cooc_label=params.min_cooc_label)
    return TrainingResult(
        ranker, split_summary({"train": splits.train, "val": splits.val, "test": splits.test}),
        candidate_recall(scored.select(*QUERY_KEYS).distinct(), scored, pairs),
        eval_query_coverage(scored), metrics_table(scored, params.eval_ks))


def clean_order_files(spark: SparkSession, raw_paths: list[str], interim_path: str, n_rows: int = 0,
                      sample_position: str = "head") -> DataFrame:
    """Order files (whole, or a sample of ``n_rows``) cleaned into one checked parquet table."""
    if n_rows > 0:
        raw = sample_orders_csv(spark, raw_paths, n_rows, sample_position)
    else:
        raw = read_orders_csv(spark, raw_paths)
    write_parquet(preprocess_orders(raw), interim_path)
    orders = spark.read.parquet(interim_path)
    assert_not_null(orders)
    return orders


def run_training(spark: SparkSession, *, raw_paths: list[str], interim_path: str, products_path: str,
                 commerces_path: str, model_path: str, n_rows: int = 0, sample_position: str = "head",
                 params: TrainingParams = TrainingParams(), eval_log_path: str | None = None) -> TrainingResult:
    """From order, product and store files to a saved model and its test metrics.

    All rows of the order files are read; a sample has to be asked for by ``n_rows``.
    """
    with scratch(spark):
        orders = clean_order_files(spark, raw_paths, interim_path, n_rows, sample_position)
        catalog = read_products(spark, products_path, filter_blocked=False)
        orders, commerces = filter_active_kiosks(orders, read_commerces(spark, commerces_path))
        orders = materialize(filter_blocked_products(orders, blocked_product_ids(catalog)))
        splits = labeled_splits(orders, unblocked(catalog), commerces, params)
        result = train_and_evaluate(splits, params, model_path)
        if eval_log_path:
            result.ranker.eval_curve(spark).coalesce(1).write.mode("overwrite").option("header", True).csv(eval_log_path)
        # The reports have a few rows each; the intermediates they come from go with the block.
        return TrainingResult(result.ranker, *map(collected, (result.summary, result.recall, result.coverage, result.metrics)))
