"""Time-based and row-based splits of order history."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.functions.ranking import locate
from basketloom.functions.times import instant, time_digits
from basketloom.schema import require_columns
from basketloom.sources.files import cut_orders


@dataclass(frozen=True)
class OrderSplit:
    """The parts; ``part``: the name of a line's part as an expression over the split orders, where there is one."""

    train: DataFrame
    val: DataFrame
    test: DataFrame
    part: Column | None = None

    def named(self) -> dict[str, DataFrame]:
        return {"train": self.train, "val": self.val, "test": self.test}

    def tagged(self) -> DataFrame:
        """All parts in one table with a ``split`` column."""
        parts = [df.withColumn("split", F.lit(name)) for name, df in self.named().items()]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _check_ratios(*ratios: float) -> None:
    if abs(sum(ratios) - 1.0) > 0.001:
        raise ValueError("the three ratios must sum to 1.0")


def split_orders_by_rows(orders: DataFrame, *, train_ratio: float, val_ratio: float, test_ratio: float,
                         leaf_rows: int = 100_000) -> OrderSplit:
    """Split by row position in time order; lines of one instant are ordered by an id hash."""
    _check_ratios(train_ratio, val_ratio, test_ratio)
    total = orders.count()
    first = int(total * train_ratio)
    second = first + int(total * val_ratio)
    return OrderSplit(*cut_orders(orders, [0, first, second, total], total, leaf_rows=leaf_rows))


def time_cutoffs(low: datetime, high: datetime, train_ratio: float, val_ratio: float) -> tuple[datetime, datetime]:
    """Start of validation and of test, in whole seconds after ``low``."""
    span = (high - low).total_seconds()
    return tuple(low + timedelta(seconds=int(span * share)) for share in (train_ratio, train_ratio + val_ratio))


def split_orders_by_time(orders: DataFrame, *, train_ratio: float, val_ratio: float, test_ratio: float,
                         dt_col: str = "order_dt", leaf_rows: int = 100_000) -> OrderSplit:
    """Split by two time cutoffs, computed from one-row aggregates.

    The parts are plain filters with literal bounds, which reach the scan.
    Where all orders have one timestamp or a part would be empty, the split
    goes by rows.
    """
    _check_ratios(train_ratio, val_ratio, test_ratio)
    require_columns(orders, [dt_col])
    ends = orders.agg(F.min(dt_col).alias("low"), F.max(dt_col).alias("high")).first()
    if ends["low"] is None:
        return OrderSplit(orders, orders, orders)
    by_rows = ends["low"] == ends["high"]
    if not by_rows:
        to_val, to_test = time_cutoffs(ends["low"], ends["high"], train_ratio, val_ratio)
        when = F.col(dt_col)
        tests = [when < instant(to_val),
                 (when >= instant(to_val)) & (when < instant(to_test)),
                 when >= instant(to_test)]
        filled = orders.agg(*[F.bool_or(test).alias(f"part{i}") for i, test in enumerate(tests)]).first()
        by_rows = not all(filled)
    if by_rows:
        return split_orders_by_rows(orders, train_ratio=train_ratio, val_ratio=val_ratio,
                                    test_ratio=test_ratio, leaf_rows=leaf_rows)
    part = F.when(tests[0], "train").when(tests[1], "val").when(tests[2], "test")
    return OrderSplit(*[orders.filter(test) for test in tests], part)


def split_feature_label(train: DataFrame, train_label_ratio: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """Earlier part for features, later part for labels, cut on distinct timestamps."""
    instants = train.select(F.count_distinct("order_dt")).first()[0]
    if instants < 2:
        return train, train
    at = min(max(1, int(instants * (1.0 - train_label_ratio))), instants - 1)
    digits = time_digits(F.col("order_dt"))
    spot = locate(train, digits, at, distinct=True, leaf_rows=0)
    same = F.lit(True)
    for digit, value in zip(digits, spot.prefix):
        same = same & (digit == F.lit(value))
    start = train.filter(same).agg(F.min("order_dt")).first()[0]
    start = instant(start)
    return train.filter(F.col("order_dt") < start), train.filter(F.col("order_dt") >= start)
