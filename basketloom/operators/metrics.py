"""Ranking metrics at k over (store, anchor) queries with at least one positive."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.functions.ranking import top_rows
from basketloom.schema import QUERY_KEYS

METRICS = ["HitRate", "Recall", "NDCG", "MRR", "Precision", "Positives"]


def _by_score(score_col: str) -> list[Column]:
    return [F.desc(score_col), F.asc("candidate_product_id")]


def _positives(df: DataFrame) -> DataFrame:
    """Positive rows per query, for queries that have any."""
    return df.filter(F.col("label") == 1).groupBy(*QUERY_KEYS).agg(F.count("*").alias("n_pos"))


def _valid_top(df: DataFrame, k: int, score_col: str, *more: str) -> DataFrame:
    """Top-k rows of the queries with positives."""
    rows = df.select(*QUERY_KEYS, "candidate_product_id", "label", score_col, *more)
    top = top_rows(rows, QUERY_KEYS, _by_score(score_col), k, "rank")
    return top.join(_positives(df).select(*QUERY_KEYS), QUERY_KEYS, "left_semi")


def _ideal_gain(k: int) -> Column:
    """DCG of min(n_pos, k) positives at the top, from a constant array of k sums."""
    sums, total = [], 0.0
    for rank in range(1, k + 1):
        total += 1.0 / math.log2(rank + 1)
        sums.append(F.lit(total))
    return F.element_at(F.array(*sums), F.least(F.col("n_pos"), F.lit(k)).cast("int"))


def per_query_metrics(df: DataFrame, ks: list[int], score_col: str = "score") -> DataFrame:
    """One row per query with every metric at every k, named ``<metric>@<k>``.

    At most ``max(ks)`` rows of a query leave each map task and totals are
    pre-aggregated, so a very large query costs no more than a small one.
    """
    rows = df.select(*QUERY_KEYS, "candidate_product_id", "label", score_col)
    top = top_rows(rows, QUERY_KEYS, _by_score(score_col), max(ks), "rank")
    aggs = []
    for k in ks:
        hit = (F.col("rank") <= k) & (F.col("label") == 1)
        aggs += [F.count_if(hit).alias(f"hits_{k}"),
                 F.sum(F.when(hit, 1.0 / F.log2(F.col("rank") + 1.0)).otherwise(0.0)).alias(f"dcg_{k}"),
                 F.min(F.when(hit, F.col("rank"))).alias(f"first_{k}")]
    joined = _positives(df).join(top.groupBy(*QUERY_KEYS).agg(*aggs), QUERY_KEYS)
    out = []
    for k in ks:
        hits = F.col(f"hits_{k}")
        values = {"HitRate": (hits > 0).cast("double"), "Recall": hits / F.col("n_pos"),
                  "NDCG": F.col(f"dcg_{k}") / _ideal_gain(k),
                  "MRR": F.coalesce(1.0 / F.col(f"first_{k}"), F.lit(0.0)),
                  "Precision": hits / F.lit(k), "Positives": hits.cast("double")}
        out += [values[name].alias(f"{name}@{k}") for name in METRICS]
    return joined.select(*QUERY_KEYS, *out)


def _mean(df: DataFrame, metric: str, k: int, score_col: str, out: str, empty: float | None) -> DataFrame:
    mean = F.avg(f"{metric}@{k}")
    value = mean if empty is None else F.coalesce(mean, F.lit(empty))
    return per_query_metrics(df, [k], score_col).agg(value.alias(out))


def hitrate_at_k(df: DataFrame, k: int = 20, score_col: str = "score") -> DataFrame:
    return _mean(df, "HitRate", k, score_col, "hitrate", 0.0)


def ndcg_at_k(df: DataFrame, k: int = 20, score_col: str = "score") -> DataFrame:
    return _mean(df, "NDCG", k, score_col, "ndcg", 0.0)


def positives_at_k(df: DataFrame, k: int = 20, score_col: str = "score") -> DataFrame:
    return _mean(df, "Positives", k, score_col, "positives", 0.0)


def recall_at_k(df: DataFrame, k: int = 20, score_col: str = "score") -> DataFrame:
    return _mean(df, "Recall", k, score_col, "recall", None)


def precision_at_k(df: DataFrame, k: int = 20, score_col: str = "score") -> DataFrame:
    return _mean(df, "Precision", k, score_col, "precision", None)


def mrr_at_k(df: DataFrame, k: int = 20, score_col: str = "score") -> DataFrame:
    return _mean(df, "MRR", k, score_col, "mrr", 0.0)


def metrics_table(df: DataFrame, eval_ks: list[int] | None = None, score_col: str = "score") -> DataFrame:
    """(metric, k, value) for all six metrics, from one ranked pass. Empty input gives 0 or NULL as above."""
    ks = sorted({k for k in eval_ks or [] if k > 0}) or [20]
    names = [f"{name}@{k}" for k in ks for name in METRICS]
    means = per_query_metrics(df, ks, score_col).agg(*[F.avg(name).alias(name) for name in names])
    long = means.unpivot([], names, "name", "value")
    parts = F.split("name", "@")
    zero = F.when(parts[0].isin("HitRate", "NDCG", "MRR", "Positives"), F.lit(0.0))
    return long.select(parts[0].alias("metric"), parts[1].cast("int").alias("k"),
                       F.coalesce("value", zero).alias("value"))


def eval_query_coverage(df: DataFrame) -> DataFrame:
    """One row: queries, those with a positive, and their share in percent."""
    per_query = df.groupBy(*QUERY_KEYS).agg(F.max("label").alias("best"))
    total, good = F.count("*"), F.count_if(F.col("best") == 1)
    return per_query.agg(total.alias("n_queries"), good.alias("n_with_pos"),
                         F.coalesce(F.try_divide(100.0 * good, total), F.lit(0.0)).alias("pct_with_pos"))


def quantity_captured_at_k(df: DataFrame, orders: DataFrame, k: int = 20, score_col: str = "score") -> DataFrame:
    """Mean quantity of the top-k candidates of a query in its store's anchor orders.

    An anchor order is one holding *any* anchor of the store with a positive,
    so one line may count for several anchors (kept as defined). Quantities
    are summed per (store, product) before they meet the recommendations.
    """
    anchors = _positives(df).select("kiosk_id", F.col("anchor_product_id").alias("product_id"))
    keys = ["order_id", "kiosk_id"]
    chosen = orders.join(anchors, ["kiosk_id", "product_id"], "left_semi").select(*keys).distinct()
    bought = (orders.join(chosen, keys, "left_semi")
              .groupBy("kiosk_id", F.col("product_id").alias("candidate_product_id"))
              .agg(F.sum("quantity").alias("quantity")))
    captured = (_valid_top(df, k, score_col).join(bought, ["kiosk_id", "candidate_product_id"])
                .groupBy(*QUERY_KEYS).agg(F.sum("quantity").alias("quantity")))
    return captured.agg(F.avg("quantity").alias("quantity_captured"))


def quantity_captured_per_order_at_k(df: DataFrame, orders: DataFrame, k: int = 20,
                                     score_col: str = "score") -> DataFrame:
    """Mean over queries of captured quantity per order holding the query's own anchor.

    Orders meet the recommendations on (order, candidate), never as all
    anchors times all lines of an order. Queries that capture nothing are left out.
    """
    anchors = _positives(df).select(*QUERY_KEYS)
    lines = orders.select("kiosk_id", "order_id", "product_id", "quantity")
    chosen = (lines.withColumnRenamed("product_id", "anchor_product_id")
              .join(anchors, QUERY_KEYS, "left_semi").select("order_id", *QUERY_KEYS).distinct())
    n_orders = chosen.groupBy(*QUERY_KEYS).agg(F.count("*").alias("n_orders"))
    bought = (lines.groupBy("kiosk_id", "order_id", F.col("product_id").alias("candidate_product_id"))
              .agg(F.sum("quantity").alias("quantity")))
    wanted = chosen.join(_valid_top(df, k, score_col).select(*QUERY_KEYS, "candidate_product_id"), QUERY_KEYS)
    captured = (wanted.join(bought, ["kiosk_id", "order_id", "candidate_product_id"])
                .groupBy(*QUERY_KEYS).agg(F.sum("quantity").alias("quantity")))
    each = captured.join(n_orders, QUERY_KEYS).withColumn("share", F.col("quantity") / F.col("n_orders"))
    return each.agg(F.avg("share").alias("quantity_per_order"))


def category_coverage_lift_at_k(df: DataFrame, k: int = 20, score_col: str = "score") -> DataFrame:
    """Distinct categories in the top-k over those among the positives; an unknown category counts as one."""
    def kinds(rows: DataFrame, out: str) -> DataFrame:
        category = F.col("candidate_category")
        count = F.count_distinct(category) + F.max(category.isNull().cast("int"))
        return rows.groupBy(*QUERY_KEYS).agg(count.alias(out))

    rows = df.select(*QUERY_KEYS, "candidate_product_id", "candidate_category", score_col)
    shown = kinds(top_rows(rows, QUERY_KEYS, _by_score(score_col), k), "shown")
    true = kinds(df.filter(F.col("label") == 1), "true")
    lift = shown.join(true, QUERY_KEYS).withColumn("lift", F.col("shown") / F.col("true"))
    return lift.agg(F.avg("lift").alias("coverage_lift"))
