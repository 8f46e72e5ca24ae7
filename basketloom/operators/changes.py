"""What changed between two catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketloom.schema import QUERY_KEYS, ROW_KEYS, require_columns


def catalog_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(keys, old_rank, new_rank, change, moved_up) for every row of either catalog.

    ``change``: entered, left, up, down or same; ``moved_up``: places gained. Ranks go by falling score, then id. Both catalogs are
    dealt by query once; ranks and the comparison need no further shuffle, and a list holds at most its top-k rows.
    """
    sides = []
    for side, df in ((0, before), (1, after)):
        require_columns(df, [*ROW_KEYS, "score"])
        sides.append(df.select(*ROW_KEYS, "score", F.lit(side).alias("side")))
    both = sides[0].unionByName(sides[1]).repartition(*QUERY_KEYS)
    order = Window.partitionBy(*QUERY_KEYS, "side").orderBy(F.desc("score"), "candidate_product_id")
    ranked = both.withColumn("rank", F.row_number().over(order).cast("bigint"))
    ranks = ranked.groupBy(*ROW_KEYS).agg(*[F.max(F.when(F.col("side") == side, F.col("rank"))).alias(name)
                                            for side, name in ((0, "old_rank"), (1, "new_rank"))])
    moved = F.col("old_rank") - F.col("new_rank")
    change = (F.when(F.col("old_rank").isNull(), "entered").when(F.col("new_rank").isNull(), "left")
              .when(moved > 0, "up").when(moved < 0, "down").otherwise("same"))
    return ranks.select(*ROW_KEYS, "old_rank", "new_rank", change.alias("change"), moved.alias("moved_up"))


def change_summary(changes: DataFrame) -> DataFrame:
    """Per query: products that entered, left, moved or stayed, and the sum of places moved."""
    def n(*kinds: str):
        return F.count_if(F.col("change").isin(*kinds))
    return changes.groupBy(*QUERY_KEYS).agg(
        n("entered").alias("n_entered"), n("left").alias("n_left"), n("up", "down").alias("n_moved"), n("same").alias("n_same"),
        F.coalesce(F.sum(F.abs("moved_up")), F.lit(0)).cast("bigint").alias("places_moved"))


def rows_in_one(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whole rows that only one catalog has, repeats counted, with ``catalog`` before or after."""
    return before.exceptAll(after).withColumn("catalog", F.lit("before")).unionByName(
        after.exceptAll(before).withColumn("catalog", F.lit("after")))


def rows_in_both(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.intersectAll(after)
