"""Min-max scaling of a column to a target range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_range(df: DataFrame, column: str) -> tuple[Column, Column]:
    """(min, max) of a column as scalar subqueries, evaluated once per query."""
    one = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high")).alias("range")).scalar()
    return one["low"], one["high"]


def minmax_scale_to_range(df: DataFrame, column: str, target: tuple, out: str = "score") -> DataFrame:
    """Map ``column`` linearly onto ``target`` = (low, high).

    The source range is taken over the whole table. A table without spread
    gets the low end of the target. The ends of ``target`` are numbers or
    columns (scalar subqueries included).
    """
    goal_low, goal_high = (end if isinstance(end, Column) else F.lit(float(end)) for end in target)
    low, high = value_range(df, column)
    scaled = F.try_divide(F.col(column) - low, high - low) * (goal_high - goal_low) + goal_low
    return df.withColumn(out, F.coalesce(scaled, goal_low).cast("double"))
