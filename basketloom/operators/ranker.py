"""LambdaMART on Spark ML trees: lambda gradients per query, Newton leaf values, early stopping."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.functions.durable import forget, materialize
from basketloom.operators.features import encode_features, ensure_feature_columns, feature_columns
from basketloom.schema import QUERY_KEYS, ROW_KEYS

NODE_SCHEMA = "tree int, node int, feature int, threshold double, low int, high int, value double, gain double"
CURVE_SCHEMA = "iteration int, dataset string, metric string, value double"


@dataclass(frozen=True)
class RankerParams:
    """Training parameters.

    Spark ML grows trees level by level: ``max_depth`` bounds them, a leaf
    count and an L1 penalty have no counterpart. ``min_gain`` is a variance
    gain per unit of weight, Spark's own scale.
    """

    learning_rate: float = 0.03
    max_depth: int = 5
    min_data_in_leaf: int = 200
    min_gain: float = 0.0
    lambda_l2: float = 1.0
    feature_fraction: float = 0.7
    bagging_fraction: float = 0.7
    max_bins: int = 64
    num_boost_round: int = 2000
    early_stopping_rounds: int = 100
    eval_ks: tuple[int, ...] = (20,)
    write_scores_every: int = 5
    seed: int = 42


@dataclass
class Ranker:
    """An ensemble as a flat node table, with its features and its training record."""

    features: list[str]
    categorical: list[str]
    nodes: list[tuple] = field(default_factory=list)
    curve: list[tuple] = field(default_factory=list)
    best_iteration: int = 0

    def eval_curve(self, spark: SparkSession) -> DataFrame:
        """(iteration, dataset, metric, value) of every boosting round."""
        return spark.createDataFrame(self.curve, CURVE_SCHEMA)

    def feature_importance(self, spark: SparkSession) -> DataFrame:
        """Weighted variance gain per feature over the kept trees, highest first."""
        rows = [(name, float(sum(row[7] for row in self.nodes if row[2] == i))) for i, name in enumerate(self.features)]
        return spark.createDataFrame(rows, "feature string, gain double").orderBy(F.desc("gain"), "feature")

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        listed = [(i, name, name in self.categorical) for i, name in enumerate(self.features)]
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        (spark.createDataFrame(listed, "place int, feature string, categorical boolean")
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/features"))
        self.eval_curve(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/curve")
        (spark.createDataFrame([(self.best_iteration,)], "best_iteration int")
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/record"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Ranker":
        listed = spark.read.parquet(f"{path}/features").orderBy("place").collect()
        if not listed:
            raise ValueError("the model's feature list is empty; train it again")
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        return Ranker([row["feature"] for row in listed],
                      [row["feature"] for row in listed if row["categorical"]],
                      [tuple(row) for row in nodes],
                      [tuple(row) for row in spark.read.parquet(f"{path}/curve").orderBy("iteration", "dataset", "metric").collect()],
                      spark.read.parquet(f"{path}/record").first()["best_iteration"])


def _ensemble(nodes: list[tuple]):
    """The summed leaf values of all trees, for a matrix of rows by features."""
    table = np.array([row[1:7] for row in nodes], dtype="float64").reshape(-1, 6)
    owner = np.array([row[0] for row in nodes], dtype="int64")
    roots = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.array([], dtype="int64")
    start = np.repeat(roots, np.diff(np.r_[roots, len(owner)])) if len(owner) else owner
    feature = table[:, 1].astype("int64")
    threshold, value = table[:, 2], table[:, 5]
    low, high = table[:, 3].astype("int64") + start, table[:, 4].astype("int64") + start

    def total(x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.zeros(len(x))
        for root in roots:
            at = np.full(len(x), root)
            while True:
                split = feature[at] >= 0
                if not split.any():
                    break
                left = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(split, np.where(left, low[at], high[at]), at)
            out += value[at]
        return out

    return total


def predict_scores(df: DataFrame, ranker: Ranker, score_col: str = "score") -> DataFrame:
    """Adds the ensemble's score; absent features get their default.

    The nodes (a few thousand rows of a trained model) go to the executors
    with the function; rows stay in their partitions and pass through Arrow.
    """
    total = _ensemble(ranker.nodes)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(total(np.column_stack(batch)))

    ready = ensure_feature_columns(df, ranker.features, ranker.categorical)
    inputs = encode_features(ranker.features, ranker.categorical)
    return ready.withColumn(score_col, score(*inputs)).select(*df.columns, score_col)


def _places(score: np.ndarray) -> np.ndarray:
    """1-based place of each candidate of a query; equal scores keep the order of the candidates."""
    out = np.empty(len(score))
    out[np.argsort(-score, kind="stable")] = np.arange(1, len(score) + 1)
    return out


def query_gradients(label: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lambda gradient (upward push) and its curvature for each candidate of one query.

    For each positive and negative: the change of DCG on swapping their places, over the ideal DCG, times the
    logistic of the score gap. A query without both kinds teaches nothing.
    """
    push, curve = np.zeros(len(label)), np.zeros(len(label))
    good = label == 1
    if good.any() and not good.all():
        gain = 1 / np.log2(_places(score) + 1)
        ideal = (1 / np.log2(np.arange(2, good.sum() + 2))).sum()
        wrong = 1 / (1 + np.exp(score[good][:, None] - score[~good][None, :]))
        weight = np.abs(gain[good][:, None] - gain[~good][None, :]) * wrong / ideal
        push[good], push[~good] = weight.sum(axis=1), -weight.sum(axis=0)
        curve[good], curve[~good] = (weight * (1 - wrong)).sum(axis=1), (weight * (1 - wrong)).sum(axis=0)
    return push, curve


def _ndcg(label: np.ndarray, score: np.ndarray, ks: tuple[int, ...]) -> list[float | None]:
    """NDCG at each k; None without positives."""
    good = label == 1
    if not good.any():
        return [None] * len(ks)
    gain = np.where(good, 1 / np.log2(_places(score) + 1), 0.0)
    ideal = 1 / np.log2(np.arange(2, good.sum() + 2))
    return [float(gain[_places(score) <= k].sum() / ideal[:k].sum()) for k in ks]


def packed_queries(df: DataFrame, part: str, inputs: list) -> DataFrame:
    """(part, query, candidates, label, x, score): one row per query, candidates in order of their ids.

    A query holds at most its candidate list (top-K per anchor), so its arrays are short. Packing shuffles the rows
    once; gradients and metrics of all rounds then need no shuffle.
    """
    item = F.struct("candidate_product_id", F.col("label").cast("double").alias("label"), F.array(*inputs).alias("x"))
    rows = df.groupBy(*QUERY_KEYS).agg(F.sort_array(F.collect_list(item)).alias("items"))
    return rows.select(F.lit(part).alias("part"), F.struct(*QUERY_KEYS).alias("query"), F.col("items.candidate_product_id").alias("candidates"),
                       F.col("items.label").alias("label"), F.col("items.x").alias("x"),
                       F.transform("items", lambda _: F.lit(0.0)).alias("score"))


def graded_queries(packed: DataFrame, nodes: list[tuple], ks: tuple[int, ...]) -> DataFrame:
    """``packed`` with the trees' values added to the scores, and push, curve (arrays) and ndcg (one per k) of each query."""
    total = _ensemble(nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, matrix = batch.column("label"), batch.column("x")
            sizes = np.diff(labels.offsets.to_numpy())
            label = labels.flatten().to_numpy(zero_copy_only=False)
            x = matrix.flatten().flatten().to_numpy(zero_copy_only=False).reshape(len(label), -1)
            score = batch.column("score").flatten().to_numpy(zero_copy_only=False) + total(x)
            cuts = np.cumsum(sizes)[:-1]
            queries = list(zip(np.split(label, cuts), np.split(score, cuts))) if len(sizes) else []
            graded = [query_gradients(*q) for q in queries]
            offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())

            def lists(values: list[np.ndarray]) -> pa.Array:
                return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values) if values else np.zeros(0), pa.float64()))

            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), lists([s for _, s in queries]), lists([g[0] for g in graded]),
                 lists([g[1] for g in graded]), pa.array([_ndcg(*q, ks) for q in queries], pa.list_(pa.float64()))],
                [*kept, "score", "push", "curve", "ndcg"])

    kept = ["part", "query", "candidates", "label", "x"]
    kinds = ", ".join(f"{n} {packed.schema[n].dataType.simpleString()}" for n in kept)
    return packed.select(*kept, "score").mapInArrow(
        run, f"{kinds}, score array<double>, push array<double>, curve array<double>, ndcg array<double>")


def gradient_rows(graded: DataFrame) -> DataFrame:
    """One row per candidate that has a gradient."""
    items = F.inline(F.arrays_zip("candidates", "label", "x", "push", "curve"))
    return graded.select("part", "query", items).where("curve > 0")


def lambda_gradients(df: DataFrame) -> DataFrame:
    """(keys, push, curve) of the first round, in which all scores are equal."""
    rows = gradient_rows(graded_queries(packed_queries(df, "all", [F.lit(0.0)]), [], (1,)))
    return rows.select("query.*", F.col("candidates").alias("candidate_product_id"), "push", "curve")


def _walk(java_node, places: list[int], values: list[float], nodes: list[tuple], tree: int) -> None:
    """Append a tree's nodes in pre-order; leaves are numbered in the same order as Spark's leaf column."""
    begin, leaves = len(nodes), iter(values)

    def visit(node) -> int:
        at = len(nodes) - begin
        if node.subtreeDepth() == 0:
            nodes.append((tree, at, -1, 0.0, 0, 0, next(leaves), 0.0))
            return at
        nodes.append(None)
        split, gain = node.split(), float(node.gain() * node.impurityStats().count())
        low, high = visit(node.leftChild()), visit(node.rightChild())
        nodes[begin + at] = (tree, at, places[split.featureIndex()], float(split.threshold()), low, high, 0.0, gain)
        return at

    visit(java_node)


def train_ranker(train: DataFrame, val: DataFrame, params: RankerParams = RankerParams(), *, may_be_empty: bool = False) -> Ranker:
    """Boost trees on lambda gradients until validation NDCG stops rising.

    With nothing to learn from (no training or validation rows, or no training query with both kinds of candidates)
    this is an error, or with ``may_be_empty`` a model without trees, which scores every row 0.

    Rows are packed to one row per query, so that a round shuffles nothing but the tree's own statistics; it
    collects its leaf sums (at most ``2 ** max_depth`` rows) and the mean metrics. Training stops when NDCG at any
    of ``eval_ks`` hasn't risen for ``early_stopping_rounds``; the trees up to that metric's best round stay.
    """
    numeric, categorical = feature_columns(train)
    features = numeric + categorical
    if train.isEmpty() or val.isEmpty():
        if may_be_empty:
            return Ranker(features, categorical)
        raise ValueError("no training or validation rows: change the split ratios or add data")
    inputs = encode_features(features, categorical)
    packed = materialize(packed_queries(train, "train", inputs).union(packed_queries(val, "valid", inputs)))
    ranker = Ranker(features, categorical)
    draw = np.random.default_rng(params.seed)
    wanted = max(1, round(params.feature_fraction * len(features)))
    best = {k: (-1.0, 0) for k in params.eval_ks}
    unwritten: list[tuple] = []
    state = graded_queries(packed, [], params.eval_ks).persist()
    teaching = gradient_rows(state.filter("part = 'train'")).limit(100).count()
    if not teaching:
        state.unpersist()
        forget(packed)
        if may_be_empty:
            return ranker
        raise ValueError("no training query has positives and negatives: change the label window or add data")

    for turn in range(1, params.num_boost_round + 1):
        places = sorted(int(i) for i in draw.choice(len(features), wanted, replace=False))
        rows = gradient_rows(state.filter("part = 'train'")).select(
            "query", "candidates", array_to_vector("x").alias("x"), "push", "curve", (F.col("push") / F.col("curve")).alias("target"))
        rows = VectorSlicer(inputCol="x", outputCol="some", indices=places).transform(rows)
        bag = F.pmod(F.xxhash64(F.lit(params.seed * 1000 + turn), "query", "candidates"), F.lit(10_000))
        bagged = rows.filter(bag < int(10_000 * params.bagging_fraction))
        if teaching < 100 and bagged.isEmpty():
            bagged = rows       # a bag of so few rows may come out empty
        tree = DecisionTreeRegressor(
            featuresCol="some", labelCol="target", weightCol="curve", leafCol="leaf", maxDepth=params.max_depth,
            minInstancesPerNode=params.min_data_in_leaf, minInfoGain=params.min_gain, maxBins=params.max_bins,
            seed=params.seed + turn,
        ).fit(bagged)
        sums = (tree.transform(rows).groupBy(F.col("leaf").cast("int").alias("leaf"))
                .agg(F.sum("push").alias("push"), F.sum("curve").alias("curve")).collect())
        steps = {row["leaf"]: params.learning_rate * row["push"] / (row["curve"] + params.lambda_l2) for row in sums}
        grown: list[tuple] = []
        _walk(tree._call_java("rootNode"), places, [float(steps.get(i, 0.0)) for i in range((tree.numNodes + 1) // 2)], grown, turn)
        ranker.nodes += grown
        unwritten += grown
        before, state = state, graded_queries(packed, unwritten, params.eval_ks)
        if turn % params.write_scores_every == 0:
            # Scores are written now and then, so that the trees to be walked do not grow with the rounds.
            superseded, packed, unwritten = packed, materialize(state), []
            forget(superseded)
            state = packed
        state = state.persist()
        means = state.groupBy("part").agg(*[F.avg(F.col("ndcg")[i]).alias(f"k{i}") for i in range(len(params.eval_ks))]).collect()
        before.unpersist()
        for row in sorted(means):
            for i, k in enumerate(params.eval_ks):
                value = float(row[f"k{i}"] or 0.0)
                ranker.curve.append((turn, row["part"], f"ndcg@{k}", value))
                if row["part"] == "valid" and value > best[k][0]:
                    best[k] = value, turn
        stalled = [at for _, at in best.values() if turn - at >= params.early_stopping_rounds]
        if stalled:
            break

    state.unpersist()
    forget(packed)
    ranker.best_iteration = stalled[0] if stalled else best[params.eval_ks[0]][1]
    ranker.nodes = [row for row in ranker.nodes if row[0] <= ranker.best_iteration]
    return ranker
