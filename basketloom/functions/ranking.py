"""Top-n per group and exact row positions without pulling a group into one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, by: list[str], order: list[Column], n: int,
             rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows of each group.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit, so each
    map task sends at most ``n`` rows of a group, however large the group is.
    """
    name = rank_col or "_rank"
    window = Window.partitionBy(*by).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return kept if rank_col else kept.drop(name)


def top_lists(df: DataFrame, by: list[str], order: list[Column], n: int, item: str, name: str) -> DataFrame:
    """One row per group: ``item`` of its first ``n`` rows as an array ``name``, in their order.

    A second window gathers the rows as the first has sorted them; ``collect_list`` by group would sort all of them
    twice more, as it keeps few groups in memory at a time.
    """
    whole = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gathered = top_rows(df, by, order, n, "_rank").withColumn(name, F.collect_list(item).over(whole))
    return gathered.filter(F.col("_rank") == 1).select(*by, name)


def hash_ranked(df: DataFrame, by: list[str], key: Column, ties: list[str], rank_col: str) -> DataFrame:
    """Exact 1-based rank by a uniform hex ``key`` inside each group.

    Each group is cut into 256 slices by the first two digits of the key: the
    slices are ranked apart and shifted by the size of the slices before them,
    so a group holding a third of all rows is still ranked by 256 tasks.
    """
    keyed = df.withColumn("_key", key).withColumn("_slice", F.substring("_key", 1, 2))
    sizes = keyed.groupBy(*by, "_slice").agg(F.count("*").alias("_size"))
    earlier = (Window.partitionBy(*by).orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*by, "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*by, "_slice").orderBy("_key", *ties)
    return (keyed.withColumn("_place", F.row_number().over(inside))
            .join(starts, [*by, "_slice"])
            .withColumn(rank_col, (F.col("_place") + F.col("_start")).cast("bigint"))
            .drop("_key", "_slice", "_place", "_start"))


@dataclass(frozen=True)
class Spot:
    """Where a row position lies: the group of rows sharing ``prefix``, and rows before it."""

    prefix: tuple
    before: int


def locate(df: DataFrame, digits: list[Column], position: int, *, distinct: bool = False,
           leaf_rows: int = 100_000) -> Spot:
    """Radix selection of the row at 0-based ``position`` in the order of ``digits``.

    Each level counts rows (or distinct values) per digit, which is a small
    table whatever the data size, and keeps the one digit holding the position.
    It stops as soon as the rows left fit ``leaf_rows``.
    """
    prefix: list = []
    before = 0
    scope = df
    for digit in digits:
        size = F.count_distinct(*digits) if distinct else F.count("*")
        sizes = scope.groupBy(digit.alias("digit")).agg(size.alias("size"))
        running = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        hit = (sizes.withColumn("upto", F.sum("size").over(running))
               .filter(F.col("upto") > position - before).orderBy("digit").first())
        if hit is None:
            raise ValueError("position lies beyond the last row")
        prefix.append(hit["digit"])
        before += hit["upto"] - hit["size"]
        scope = scope.filter(digit.eqNullSafe(F.lit(hit["digit"])))
        if hit["size"] <= leaf_rows:
            break
    return Spot(tuple(prefix), before)


def _inside(digits: list[Column], spot: Spot) -> Column:
    test = F.lit(True)
    for digit, value in zip(digits, spot.prefix):
        test = test & digit.eqNullSafe(F.lit(value))
    return test


def _before(digits: list[Column], spot: Spot) -> Column:
    """Rows ordered before the spot; a missing digit stands before all others, as in an ascending sort."""
    test = F.lit(False)
    equal = F.lit(True)
    for digit, value in zip(digits, spot.prefix):
        if value is not None:
            test = test | (equal & F.coalesce(digit < F.lit(value), F.lit(True)))
        equal = equal & digit.eqNullSafe(F.lit(value))
    return test


def cut_rows(df: DataFrame, digits: list[Column], ties: list[Column], cuts: list[int], total: int,
             *, leaf_rows: int = 100_000) -> list[DataFrame]:
    """Rows between neighbouring positions of ``cuts`` in the order ``digits, ties``, one table each."""
    spots = {at: Spot((), 0) if total <= leaf_rows else locate(df, digits, at, leaf_rows=leaf_rows)
             for at in set(cuts) if 0 < at < total}
    return [_between(df, digits, ties, low, min(high, total), total, spots) for low, high in zip(cuts, cuts[1:])]


def _between(df: DataFrame, digits: list[Column], ties: list[Column], start: int, stop: int, total: int,
             spots: dict[int, Spot]) -> DataFrame:
    """Rows at positions ``start .. stop - 1``.

    All but the rows of the two edge groups are chosen by a plain filter, so
    nothing is sorted or shuffled as a whole.
    """
    if start >= stop:
        return df.limit(0)
    if start <= 0 and stop == total:
        return df
    low, high = spots.get(start), spots.get(stop)
    parts = []
    if low is None or high is None or low != high:
        between = F.lit(True)
        if low is not None:
            between = between & ~_before(digits, low) & ~_inside(digits, low)
        if high is not None:
            between = between & _before(digits, high)
        if not any(spot is not None and not spot.prefix for spot in (low, high)):
            parts.append(df.filter(between))
    for spot in {spot for spot in (low, high) if spot is not None}:
        place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*digits, *ties))
        edge = df.filter(_inside(digits, spot)).withColumn("_at", place + F.lit(spot.before - 1))
        parts.append(edge.filter((F.col("_at") >= start) & (F.col("_at") < stop)).drop("_at"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
