import pytest
from pyspark.sql import functions as F

from basketloom.operators.metrics import ndcg_at_k
from basketloom.operators.ranker import Ranker, RankerParams, _walk, lambda_gradients, predict_scores, train_ranker

PARAMS = RankerParams(learning_rate=0.3, max_depth=3, min_data_in_leaf=10, num_boost_round=4, max_bins=32,
                      feature_fraction=1.0, bagging_fraction=0.8, eval_ks=(5,), write_scores_every=2)


@pytest.fixture(scope="module")
def planted(spark):
    """Positives follow pop_store in one channel and its opposite in the other; the cosine says little."""
    rows = spark.range(0, 200 * 15).select(
        F.floor(F.col("id") / 15).cast("string").alias("kiosk_id"), F.lit("a").alias("anchor_product_id"),
        (F.col("id") % 15).cast("string").alias("candidate_product_id"), F.rand(1).alias("cooc_cosine_sim"),
        F.rand(2).alias("pop_store"), F.when(F.col("id") % 2 == 0, "web").otherwise("shop").alias("channel"))
    good = F.when(F.col("channel") == "web", F.col("pop_store")).otherwise(1 - F.col("pop_store"))
    rows = rows.withColumn("label", (good > 0.8).cast("tinyint")).persist()
    store = F.col("kiosk_id").cast("int")
    return rows.filter(store < 140), rows.filter(store >= 140)


@pytest.fixture(scope="module")
def ranker(planted):
    return train_ranker(*planted, PARAMS)


def test_model_beats_the_cosine_order(planted, ranker):
    val = planted[1]
    plain = ndcg_at_k(val, 5, "cooc_cosine_sim").first()[0]
    model = ndcg_at_k(predict_scores(val, ranker), 5).first()[0]
    assert model > plain + 0.2
    assert model == pytest.approx(max(v for _, name, _, v in ranker.curve if name == "valid"), abs=1e-9)


def test_curve_and_importance(spark, ranker):
    curve = ranker.eval_curve(spark)
    assert {r["dataset"] for r in curve.collect()} == {"train", "valid"}
    first = ranker.feature_importance(spark).first()
    assert first["feature"] in ("pop_store", "channel") and first["gain"] > 0
    assert ranker.features == ["cooc_cosine_sim", "pop_store", "channel"]


def test_save_and_load(spark, planted, ranker, tmp_path):
    ranker.save(spark, str(tmp_path / "m"))
    again = Ranker.load(spark, str(tmp_path / "m"))
    assert (again.features, again.categorical, again.nodes) == (ranker.features, ranker.categorical, ranker.nodes)
    assert sorted(again.curve) == sorted(ranker.curve) and again.best_iteration == ranker.best_iteration
    assert again.feature_importance(spark).collect() == ranker.feature_importance(spark).collect()
    both = predict_scores(predict_scores(planted[1], ranker), again, "again")
    assert both.filter("score != again").count() == 0


def test_early_stop(planted):
    stopped = train_ranker(*planted, RankerParams(**{**PARAMS.__dict__, "learning_rate": 0.0, "num_boost_round": 5,
                                                     "early_stopping_rounds": 1}))
    assert stopped.best_iteration == 1
    assert max(row[0] for row in stopped.curve) == 2


def test_lambdas_by_hand(spark):
    rows = spark.createDataFrame([("k", "a", "p", 1, 0.0), ("k", "a", "q", 0, 0.0), ("k", "b", "p", 1, 0.0)],
                                 "kiosk_id string, anchor_product_id string, candidate_product_id string, label int, score double")
    got = {r["candidate_product_id"]: r for r in lambda_gradients(rows).collect()}
    swap = 1.0 - 1.0 / 1.5849625007211562       # places 1 and 2; the ideal DCG is 1
    assert got["p"]["push"] == pytest.approx(swap / 2) and got["q"]["push"] == pytest.approx(-swap / 2)
    assert got["p"]["curve"] == pytest.approx(swap / 4)
    assert len(got) == 2        # a query without negatives teaches nothing


def test_absent_features_get_defaults(planted, ranker):
    assert predict_scores(planted[1].drop("channel", "pop_store"), ranker).filter("score is null").count() == 0


def test_empty_training_data_is_an_error(planted):
    with pytest.raises(ValueError):
        train_ranker(planted[0].limit(0), planted[1], PARAMS)


def test_nothing_to_learn_from(spark, planted, tmp_path):
    """No rows, or no query with both kinds: an error, or on request a model without trees that scores, saves and loads."""
    train, val = planted
    alike = train.withColumn("label", F.lit(0).cast("tinyint"))
    for rows, judged in ((train.limit(0), val), (train, val.limit(0)), (alike, val)):
        with pytest.raises(ValueError):
            train_ranker(rows, judged, PARAMS)
        bare = train_ranker(rows, judged, PARAMS, may_be_empty=True)
        assert (bare.nodes, bare.curve, bare.best_iteration) == ([], [], 0)
        assert predict_scores(val, bare).filter("score = 0").count() == val.count()
    bare.save(spark, str(tmp_path / "bare"))
    again = Ranker.load(spark, str(tmp_path / "bare"))
    assert (again.features, again.nodes, again.best_iteration) == (bare.features, [], 0)
    assert {r["gain"] for r in again.feature_importance(spark).collect()} == {0.0}


def test_few_rows_and_an_empty_bag(planted):
    train, val = (df.filter("kiosk_id in ('3', '150') and candidate_product_id in ('1', '2', '3', '4', '5', '6')").withColumn(
        "label", (F.col("candidate_product_id") == "2").cast("tinyint")) for df in planted)
    few = train_ranker(train, val, RankerParams(**{**PARAMS.__dict__, "bagging_fraction": 0.0001, "num_boost_round": 1, "min_data_in_leaf": 1}))
    assert few.nodes and len(few.curve) == 2


def test_gain_of_kept_trees_only(spark, planted):
    """Weighted variance gain, read from the nodes: trees after the best round don't count."""
    hand = Ranker(["a", "b"], [], [(1, 0, 1, 0.5, 1, 2, 0.0, 3.0), (1, 1, -1, 0.0, 0, 0, 1.0, 0.0), (1, 2, 0, 0.5, 3, 4, 0.0, 1.5),
                                   (1, 3, -1, 0.0, 0, 0, 1.0, 0.0), (1, 4, -1, 0.0, 0, 0, 1.0, 0.0)])
    assert [tuple(r) for r in hand.feature_importance(spark).collect()] == [("b", 3.0), ("a", 1.5)]
    stopped = train_ranker(*planted, RankerParams(**{**PARAMS.__dict__, "num_boost_round": 30, "early_stopping_rounds": 2, "eval_ks": (1, 5)}))
    assert {row[0] for row in stopped.nodes} == set(range(1, stopped.best_iteration + 1))
    assert max(row[0] for row in stopped.curve) == stopped.best_iteration + 2


def test_tree_nodes_are_numbered_in_pre_order():
    class Node:
        def __init__(self, *children, at=0):
            self.children, self.at = children, at
        subtreeDepth = lambda self: len(self.children)
        leftChild = lambda self: self.children[0]
        rightChild = lambda self: self.children[1]
        gain = lambda self: 0.5
        count = lambda self: 4
        impurityStats = split = lambda self: self
        featureIndex = lambda self: self.at
        threshold = lambda self: 7.0
    nodes = [(1, 0, -1, 0.0, 0, 0, 9.0, 0.0)]
    _walk(Node(Node(Node(), Node(), at=1), Node()), [3, 5], [1.0, 2.0, 3.0], nodes, 2)
    assert nodes[1:] == [(2, 0, 3, 7.0, 1, 4, 0.0, 2.0), (2, 1, 5, 7.0, 2, 3, 0.0, 2.0), (2, 2, -1, 0.0, 0, 0, 1.0, 0.0),
                         (2, 3, -1, 0.0, 0, 0, 2.0, 0.0), (2, 4, -1, 0.0, 0, 0, 3.0, 0.0)]
