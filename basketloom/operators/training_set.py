"""Shaping of labelled rows for training: query filters, negative sampling, shuffling, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketloom.functions.hashing import draw_key
from basketloom.functions.ranking import top_rows
from basketloom.operators.features import add_query_id
from basketloom.schema import QUERY_KEYS, ROW_KEYS


def filter_good_queries(df: DataFrame) -> DataFrame:
    """Rows of queries with more than one row and at least one positive."""
    good = (df.groupBy(*QUERY_KEYS).agg(F.count("*").alias("n"), F.sum("label").alias("pos"))
            .filter((F.col("n") > 1) & (F.col("pos") > 0)))
    return df.join(good, QUERY_KEYS, "left_semi").select(*df.columns)


def sample_negatives(df: DataFrame, max_neg_per_group: int, seed: int = 42) -> DataFrame:
    """All positives and at most ``max_neg_per_group`` negatives per query, drawn by a seeded hash."""
    if max_neg_per_group <= 0:
        return df
    drawn = top_rows(df.filter(F.col("label") == 0), QUERY_KEYS,
                     [draw_key(seed, *ROW_KEYS), F.col("candidate_product_id")], max_neg_per_group)
    return df.filter(F.col("label") == 1).unionByName(drawn)


def shuffle_within_query(df: DataFrame, seed: int = 42) -> DataFrame:
    """Adds ``shuffle_rank``: the place of each row in a seeded random order of its query.

    A query has at most its candidate list, so one shuffle by query is enough;
    ``hash_ranked`` is for groups without such a bound.
    """
    order = Window.partitionBy(*QUERY_KEYS).orderBy(draw_key(seed, *ROW_KEYS), "candidate_product_id")
    return df.withColumn("shuffle_rank", F.row_number().over(order).cast("bigint"))


def query_group_sizes(df: DataFrame) -> DataFrame:
    return add_query_id(df).groupBy("query_id").agg(F.count("*").alias("q_size"))


def _counts():
    rows, positives = F.count("*"), F.coalesce(F.sum("label"), F.lit(0)).cast("bigint")
    return rows, positives, F.count_distinct(F.struct(*QUERY_KEYS))


def label_stats(df: DataFrame) -> DataFrame:
    """One row: rows, positives, negatives, share of positives, queries."""
    rows, positives, queries = _counts()
    return df.agg(rows.alias("n_rows"), positives.alias("positives"), (rows - positives).alias("negatives"),
                  F.coalesce(F.try_divide(positives, rows), F.lit(0.0)).alias("pos_ratio"),
                  queries.alias("queries"))


def split_summary(named: dict[str, DataFrame]) -> DataFrame:
    """One row per labelled split, also of an empty one, from one aggregation over all of them."""
    tagged = None
    for name, df in named.items():
        part = df.select(F.lit(name).alias("split"), *QUERY_KEYS, "label")
        tagged = part if tagged is None else tagged.unionByName(part)
    rows, positives, queries = _counts()
    counted = tagged.groupBy("split").agg(rows.alias("n_rows"), positives.alias("pos"), queries.alias("queries"))
    names = tagged.sparkSession.createDataFrame([(name,) for name in named], "split string")
    filled = names.join(counted, "split", "left").select("split", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "pos", "queries")])
    return filled.select("split", "n_rows", "pos", (F.col("n_rows") - F.col("pos")).alias("neg"),
                         F.coalesce(F.try_divide(100.0 * F.col("pos"), F.col("n_rows")), F.lit(0.0)).alias("pos_pct"), "queries",
                         F.coalesce(F.try_divide("n_rows", "queries"), F.lit(0.0)).alias("avg_group"))
