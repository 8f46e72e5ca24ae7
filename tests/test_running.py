import os
import random
from datetime import date, datetime, timedelta

import pytest

from basketloom.operators import running as rn
from basketloom.operators.baskets import build_baskets
from basketloom.operators.candidates import generate_candidates
from basketloom.operators.labels import label_pairs_window
from basketloom.streaming import label_pairs as lp
from tests.conftest import rows_of

FIRST = date(2024, 1, 29)


def some_days(order_lines, days):
    """Order lines of some days around a month's end; ids of odd days are shared by two stores."""
    rng, rows = random.Random(5), []
    for d in days:
        for order in range(8):
            at = datetime(2024, 1, 29, 9) + timedelta(days=d, minutes=order)
            for store in ("a", "b") if d % 2 else ("a",):
                rows += [(store, f"{d}-{order}", f"p{rng.randrange(5)}", str(at)) for _ in range(rng.randint(1, 5))]
    return order_lines([*rows, ("a", "x", "p1", None)])


def measured(df):
    return sorted((r[0], r[1], *(round(x, 9) for x in r[2:])) for r in df.collect())


def test_a_window_that_moves_gives_the_candidates_of_a_full_run(spark, order_lines, tmp_path):
    path = str(tmp_path / "days")
    orders = some_days(order_lines, range(7)).cache()
    day = timedelta(days=1)
    rn.store_days(orders.where("order_dt < '2024-02-03'"), path)
    rn.append_days(orders.where("order_dt >= '2024-02-03'"), path)
    counts = rn.window_counts(spark, path, FIRST, FIRST + 4 * day)
    counts = rn.moved_counts(spark, counts, path, (FIRST, FIRST + 4 * day), (FIRST + day, FIRST + 5 * day))
    counts = rn.moved_counts(spark, counts, path, (FIRST + day, FIRST + 5 * day), (FIRST + 3 * day, FIRST + 6 * day)).cache()
    assert rows_of(counts) == rows_of(rn.window_counts(spark, path, FIRST + 3 * day, FIRST + 6 * day))
    window = orders.where("order_dt >= '2024-02-01' and order_dt < '2024-02-05'")
    want = measured(generate_candidates(build_baskets(window).cache()))
    assert measured(rn.candidates_of_counts(counts)) == want and len(want) > 10


def test_only_the_days_that_change_are_read(spark, order_lines, tmp_path):
    path = str(tmp_path / "days")
    rn.store_days(some_days(order_lines, range(7)), path)
    plan = rn.stored_days(spark, path, date(2024, 2, 1), date(2024, 2, 1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(day), GreaterThanOrEqual(day" in plan


def test_a_day_written_again_replaces_its_month(spark, order_lines, tmp_path):
    path = str(tmp_path / "days")
    orders = some_days(order_lines, range(3, 7))
    rn.store_days(orders, path)
    rn.store_days(orders, path)
    assert rows_of(rn.window_counts(spark, path, FIRST, FIRST + timedelta(days=9))) == rows_of(
        rn.day_counts(orders).groupBy("left", "right").agg({"n": "sum"}))


def test_windows_only_move_forward(spark, order_lines, tmp_path):
    day = timedelta(days=1)
    counts = rn.day_counts(some_days(order_lines, [0])).drop("day")
    for to in ((FIRST - day, FIRST + day), (FIRST + 3 * day, FIRST + 4 * day), (FIRST, FIRST)):
        with pytest.raises(ValueError):
            rn.moved_counts(spark, counts, str(tmp_path), (FIRST, FIRST + day), to)


def test_no_orders_no_candidates(order_lines):
    empty = rn.day_counts(some_days(order_lines, [0]).limit(0)).drop("day")
    assert rn.candidates_of_counts(empty).count() == 0


def test_streamed_pairs_over_shuffled_files(spark, tmp_path):
    """Lines of ten days a file, each two files swapped; what comes after its watermark is counted as late."""
    folder, out, mark = (str(tmp_path / name) for name in ("in", "out", "mark"))
    rng, base = random.Random(1), datetime(2020, 1, 1)

    def drop(rows):
        spark.createDataFrame(rows, lp.LINES).coalesce(1).write.mode("append").parquet(folder)

    lines = [(f"k{rng.randrange(3)}", f"p{rng.randrange(4)}", base + timedelta(hours=rng.randrange(960), seconds=rng.choice([0, 0, 1])))
             for _ in range(250)]
    for part in (1, 0, 3, 2):
        drop([x for x in lines if (x[2] - base).days // 10 == part])
    odd = [(None, "p1", base + timedelta(days=39)), ("k1", None, base + timedelta(days=39)), ("k2", "p2", None)]
    drop([("k0", "p1", base + timedelta(days=3)), ("k0", "p2", base + timedelta(days=3)), *odd])

    def run():
        return lp.stream_label_pairs(spark, folder, out, mark, window_days=7, delay="20 days", files_per_batch=1)

    assert run() == 2
    open_days = lp.streamed_pairs(spark, out)
    lp.close_days(spark, folder, base + timedelta(days=100))
    before = sum(r["cooc_count"] for r in open_days.collect())
    assert run() == 0
    batch = spark.createDataFrame([("o", *x) for x in lines], "order_id string, " + lp.LINES)
    want = rows_of(label_pairs_window(batch, window_days=7))
    assert rows_of(lp.streamed_pairs(spark, out)) == want and before < sum(w[3] for w in want)


def test_few_state_partitions(spark, tmp_path):
    """The state has two partitions for each core, whatever the session asks for, and the session keeps its own number."""
    folder, out, mark = (str(tmp_path / name) for name in ("in", "out", "mark"))
    rows = [("k1", "p1", datetime(2020, 1, 1)), ("k1", "p2", datetime(2020, 1, 2))]
    spark.createDataFrame(rows, lp.LINES).coalesce(1).write.parquet(folder)
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        lp.close_days(spark, folder, datetime(2020, 3, 1))
        lp.stream_label_pairs(spark, folder, out, mark)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "37"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
    assert rows_of(lp.streamed_pairs(spark, out)) == [("k1", "p1", "p2", 1)]
    parts = [name for name in os.listdir(f"{mark}/state/0") if name.isdigit()]
    assert len(parts) == min(37, 2 * spark.sparkContext.defaultParallelism)
