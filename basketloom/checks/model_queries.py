"""Queries whose result depends on a trained model; they have no SQL counterpart."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.checks.stages import LABEL_DAYS, MIN_COOC, MIN_LIFT, TOP_K, Stages
from basketloom.functions.durable import shared_folder
from basketloom.operators import catalog as ct
from basketloom.operators.ranker import Ranker, RankerParams, lambda_gradients, predict_scores, train_ranker
from basketloom.plans.scoring import ScoringParams, build_catalog
from basketloom.plans.training import TrainingParams, labeled_splits, train_and_evaluate
from basketloom.schema import ROW_KEYS

PARAMS = TrainingParams(
    min_cooc=MIN_COOC, min_lift=MIN_LIFT, top_k=TOP_K, label_window_days=LABEL_DAYS, max_neg_per_group=20,
    eval_ks=[5, 10, 20],
    ranker=RankerParams(learning_rate=0.3, max_depth=4, min_data_in_leaf=20, num_boost_round=200, early_stopping_rounds=3))

# One trained model per application and directory: the queries below share it. On a large history of independent products
# no pair reaches MIN_LIFT, so that there is nothing to learn from: the model has no trees then.
_trained: dict[tuple[str, str], tuple] = {}


def trained(s: Stages):
    key = (s.spark.sparkContext.applicationId, s.tables.directory)
    if key not in _trained:
        splits = labeled_splits(s.orders, s.products, s.active[1], PARAMS)
        _trained[key] = (splits, train_and_evaluate(splits, PARAMS, may_be_empty=True))
    return _trained[key]


def _ranker(s: Stages) -> Ranker:
    return trained(s)[1].ranker


def _six_digits(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(n, 6).alias(n) if kind == "double" else F.col(n) for n, kind in df.dtypes])


def _stopping(s: Stages) -> DataFrame:
    """Validation NDCG per round, and the round kept."""
    best = F.lit(_ranker(s).best_iteration)
    curve = _ranker(s).eval_curve(s.spark).filter(F.col("dataset") == "valid")
    return curve.select("iteration", "value", (F.col("iteration") == best).alias("kept"))


def _reloaded(s: Stages) -> DataFrame:
    """Test rows scored by the model after saving and loading it."""
    path = f"{shared_folder(s.spark)}/basketloom/model-{uuid.uuid4().hex}"
    _ranker(s).save(s.spark, path)
    rows = predict_scores(trained(s)[0].test, Ranker.load(s.spark, path))
    return rows.select(*ROW_KEYS, "score")


def _scored(s: Stages) -> DataFrame:
    return predict_scores(trained(s)[0].test, _ranker(s))


def fixed_ranker() -> Ranker:
    """A small model that SQL can state too: two trees over three features."""
    nodes = [(1, 0, 0, 0.05, 1, 2, 0.0, 4.0), (1, 1, -1, 0.0, 0, 0, -1.0, 0.0), (1, 2, 1, 2.0, 3, 4, 0.0, 2.5),
             (1, 3, -1, 0.0, 0, 0, 0.25, 0.0), (1, 4, -1, 0.0, 0, 0, 1.5, 0.0),
             (2, 0, 2, 0.0, 1, 2, 0.0, 1.0), (2, 1, -1, 0.0, 0, 0, 0.5, 0.0), (2, 2, 0, 0.1, 3, 4, 0.0, 0.5),
             (2, 3, -1, 0.0, 0, 0, -0.125, 0.0), (2, 4, -1, 0.0, 0, 0, 2.0, 0.0)]
    return Ranker(["cooc_cosine_sim", "pop_store", "cand_is_new"], [], nodes, [(1, "valid", "ndcg@5", 0.25), (2, "valid", "ndcg@5", 0.5)], 2)


def _fixed_scores(s: Stages, ranker: Ranker) -> DataFrame:
    return predict_scores(s.scored.drop("score"), ranker).select(*ROW_KEYS, "score")


def _fixed_reloaded(s: Stages) -> DataFrame:
    path = f"{shared_folder(s.spark)}/basketloom/model-{uuid.uuid4().hex}"
    fixed_ranker().save(s.spark, path)
    return _fixed_scores(s, Ranker.load(s.spark, path))


STUMP = RankerParams(learning_rate=1.0, max_depth=1, min_data_in_leaf=1, feature_fraction=1.0, bagging_fraction=1.0, num_boost_round=1, eval_ks=(5, 10))
_stumps: dict[tuple[str, str], Ranker] = {}


def _stump(s: Stages) -> Ranker:
    """One boosting round on the labelled test rows with a feature of two values, so that SQL can state the tree."""
    key = (s.spark.sparkContext.applicationId, s.tables.directory)
    if key not in _stumps:
        anchor, candidate = (F.substring_index(name, "-", 1) for name in ("anchor_product_id", "candidate_product_id"))
        rows = s.labeled.select(*ROW_KEYS, "label", (anchor == candidate).cast("double").alias("same_brand"))
        _stumps[key] = train_ranker(rows, rows, STUMP, may_be_empty=True)
    return _stumps[key]


def _model_catalog(s: Stages) -> DataFrame:
    tables = build_catalog(s.clean, s.all_products, s.commerces, _ranker(s),
                           ScoringParams(last_n_days=0, min_cooc=MIN_COOC, min_lift=1.0, catalog_top_k=20))
    return tables.predictions


BUILDERS = {
    "train_ranker": lambda s: _ranker(s).node_table(s.spark),
    "ranker_early_stopping": _stopping,
    "ranker_eval_curve": lambda s: _ranker(s).eval_curve(s.spark),
    "feature_importance": lambda s: _ranker(s).feature_importance(s.spark),
    "predict_scores": lambda s: _fixed_scores(s, fixed_ranker()),
    "ranker_save_load": _fixed_reloaded,
    "fixed_score_stats": lambda s: _six_digits(ct.score_stats(_fixed_scores(s, fixed_ranker()))),
    "stump_nodes": lambda s: _six_digits(_stump(s).node_table(s.spark)),
    "stump_importance": lambda s: _six_digits(_stump(s).feature_importance(s.spark)),
    "stump_eval_curve": lambda s: _six_digits(_stump(s).eval_curve(s.spark)),
    "lambda_gradients": lambda s: _six_digits(lambda_gradients(s.labeled)),
    "trained_scores": _scored,
    "trained_save_load": _reloaded,
    "ranker_test_metrics": lambda s: trained(s)[1].metrics,
    "ranker_split_summary": lambda s: trained(s)[1].summary,
    "model_catalog": _model_catalog,
    "model_score_stats": lambda s: ct.score_stats(_scored(s)),
}
