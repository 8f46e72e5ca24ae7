"""Queries that send the tables through files and streams and read them back."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.checks.model_queries import fixed_ranker
from basketloom.checks.stages import LABEL_DAYS, MIN_COOC, MIN_LIFT, REPORT_K, TOP_K, Stages
from basketloom.functions.durable import delete, shared_folder
from basketloom.functions.times import instant, micros
from basketloom.operators import lookup as lk
from basketloom.operators import running as rn
from basketloom.plans.analysis import ReportParams, reports_from_files
from basketloom.sources import files
from basketloom.streaming.ingest import answer_stream, ingest_orders_incremental
from basketloom.streaming.label_pairs import close_days, stream_label_pairs, streamed_pairs


def _fresh(s: Stages, name: str) -> str:
    return f"{shared_folder(s.spark)}/basketloom/{name}-{uuid.uuid4().hex}"


def _order_files(s: Stages) -> str:
    path = _fresh(s, "orders")
    text = s.raw.withColumn("orderdt", F.col("orderdt").cast("string"))
    text.write.option("header", True).csv(path)
    return path


def _yearly_files(s: Stages) -> str:
    """One file of raw orders for each year, its lines in the order of all their columns."""
    path = _fresh(s, "yearly")
    order = ["orderdt", "orderid", "productid", "quantity", "documenttype", "userid"]
    years = s.raw.withColumn("orderdt", F.col("orderdt").cast("string")).withColumn("year", F.substring("orderdt", 1, 4))
    # Ranges of the order are sorted apart, one file for each range and year; a year's file is then written from its ranges
    # one after another, so that no task sorts a year.
    sorted_path = _fresh(s, "ranges")
    (years.repartitionByRange("year", *order).sortWithinPartitions("year", *order)
     .write.partitionBy("year").parquet(sorted_path))
    folders: dict[str, list[str]] = {}
    for file in sorted(s.spark.read.parquet(sorted_path).inputFiles()):
        folders.setdefault(file.rpartition("/")[0], []).append(file)

    def write(folder: str) -> None:
        ranges = [s.spark.read.schema(years.drop("year").schema).parquet(file) for file in folders[folder]]
        files.union_by_name(ranges).coalesce(1).write.option("header", True).csv(f"{path}/{folder.rpartition('/')[2]}")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, folders))
    delete(s.spark, sorted_path)
    return path


def _sampled(s: Stages, position: str) -> DataFrame:
    return files.sample_orders_csv(s.spark, _yearly_files(s), 1000, position)


def _product_files(s: Stages) -> str:
    path = _fresh(s, "products")
    s.tables.all_products().write.option("header", True).option("sep", ";").csv(path)
    return path


def _commerce_files(s: Stages) -> str:
    path = _fresh(s, "commerces")
    s.tables.commerces().write.option("header", True).option("sep", ";").csv(path)
    return path


def _products_csv(s: Stages) -> DataFrame:
    return files.read_products(s.spark, _product_files(s)).withColumn("blocked", F.col("blocked").cast("boolean"))


def _commerces_csv(s: Stages) -> DataFrame:
    return files.read_commerces(s.spark, _commerce_files(s))


def _report(s: Stages, report: str, table: str) -> DataFrame:
    """A report table on all stores, from files of orders, products, stores and the fixed model."""
    model, params = _fresh(s, "model"), ReportParams(REPORT_K, 0, 0.8, 0.1, 0.1, MIN_COOC, MIN_LIFT, TOP_K, drop_blocked=True)
    with ThreadPoolExecutor(4) as pool:
        written = [pool.submit(write, s) for write in (_order_files, _product_files, _commerce_files)]
        pool.submit(fixed_ranker().save, s.spark, model).result()
        orders, products, commerces = [path.result() for path in written]
    return reports_from_files(
        s.spark, raw_paths=[orders], interim_path=_fresh(s, "clean"), products_path=products,
        commerces_path=commerces, model_path=model, out_folder=_fresh(s, "reports"), reports=[report],
        params=params)[f"{report}/{table}"]


def _ingested(s: Stages) -> DataFrame:
    return ingest_orders_incremental(s.spark, _order_files(s), _fresh(s, "clean"), _fresh(s, "mark"), files_per_batch=1)


def _written(s: Stages) -> DataFrame:
    path = _fresh(s, "table")
    files.write_parquet(s.clean, path)
    return s.spark.read.parquet(path)


def requests(s: Stages) -> DataFrame:
    """Every (store, product) of the whole order history asks once; many are unknown to the catalog."""
    limit = F.when(F.col("kiosk_id").endswith("7"), 3).otherwise(20)
    return s.orders.select(F.col("product_id").alias("anchor_id"), "kiosk_id").distinct().withColumn("limit", limit)


def _streamed(s: Stages) -> DataFrame:
    """The request table as a stream, answered from the catalog."""
    asked, answers = _fresh(s, "asked"), _fresh(s, "answers")
    wanted = requests(s)
    wanted.write.parquet(asked)
    stream = s.spark.readStream.schema(wanted.schema).parquet(asked)
    lookup = files.materialize(lk.build_lookup(s.catalog))
    answer_stream(stream, lookup, answers, _fresh(s, "mark")).awaitTermination()
    return s.spark.read.parquet(answers).drop("recommendation_date")


def _streamed_pairs(s: Stages) -> DataFrame:
    """Label pairs of the test lines as a stream: six spans of time, each two swapped, then the first once more, all late."""
    folder, out, mark = _fresh(s, "lines"), _fresh(s, "day-pairs"), _fresh(s, "mark")
    lines = files.materialize(s.test.select("kiosk_id", "product_id", "order_dt"))
    ends = lines.agg(F.min("order_dt").alias("low"), F.max("order_dt").alias("high")).first()
    span = int((ends["high"] - ends["low"]).total_seconds()) // 6 + 1
    part = F.floor((micros(F.col("order_dt")) - micros(instant(ends["low"]))) / (span * 1_000_000))
    # The spans are parted once, by all tasks; the one task that writes a span's file reads no other lines.
    spans = _fresh(s, "spans")
    tagged = lines.withColumn("part", part.cast("int"))
    tagged.write.partitionBy("part").parquet(spans)
    parted = s.spark.read.schema(tagged.schema).parquet(spans)
    for number in (1, 0, 3, 2, 5, 4, 0):
        parted.where(F.col("part") == number).drop("part").coalesce(1).write.mode("append").parquet(folder)
    delete(s.spark, spans)
    close_days(s.spark, folder, ends["high"] + timedelta(seconds=4 * span + 30 * 86_400))
    late = stream_label_pairs(s.spark, folder, out, mark, window_days=LABEL_DAYS, delay=f"{2 * span} seconds", files_per_batch=1)
    return streamed_pairs(s.spark, out).withColumn("late_lines", F.lit(late).cast("bigint"))


def _running_candidates(s: Stages) -> DataFrame:
    """All days but the last are counted and stored; then the window moves on by one day."""
    path = _fresh(s, "day-counts")
    ends = s.orders.agg(F.min("order_dt").alias("low"), F.max("order_dt").alias("high")).first()
    first, last, day = ends["low"].date(), ends["high"].date(), timedelta(days=1)
    rn.store_days(s.orders.where(F.col("order_dt") < F.lit(str(last)).cast("timestamp_ntz")), path)
    before = files.materialize(rn.window_counts(s.spark, path, first, last - day))
    rn.append_days(s.orders.where(F.col("order_dt") >= F.lit(str(last)).cast("timestamp_ntz")), path)
    counts = files.materialize(rn.moved_counts(s.spark, before, path, (first, last - day), (first + day, last)))
    return rn.candidates_of_counts(counts, MIN_COOC)


BUILDERS = {
    "label_pairs_stream": _streamed_pairs,
    "running_candidates": _running_candidates,
    "personalization_report_files": lambda s: _report(s, "personalization", "kiosk_products"),
    "novelty_report_files": lambda s: _report(s, "novelty", "by_position").withColumn("new_pct", F.round("new_pct", 6)),
    "sample_orders_head": lambda s: _sampled(s, "head"),
    "sample_orders_tail": lambda s: _sampled(s, "tail"),
    "read_products": _products_csv,
    "read_commerces": _commerces_csv,
    "read_orders_csv": lambda s: files.read_orders_csv(s.spark, _order_files(s)),
    "ingest_orders_incremental": _ingested,
    "write_parquet": _written,
    "recommend_requests_stream": _streamed,
}
