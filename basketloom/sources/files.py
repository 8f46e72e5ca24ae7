"""Order, product and store files: readers, samples and the parquet writer."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketloom.functions.durable import materialize
from basketloom.functions.hashing import draw_key, hex_digits
from basketloom.functions.ranking import cut_rows
from basketloom.functions.times import time_digits
from basketloom.schema import COMMERCE_TYPES, PRODUCT_TYPES, RAW_ORDER_NUMBERS


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Column names of a delimited file; reads one line."""
    return spark.read.option("header", True).option("sep", sep).csv(path).columns


def _schema(header: list[str] | tuple[str, ...], types: dict) -> T.StructType:
    return T.StructType([T.StructField(name, types.get(name, T.StringType())) for name in header])


def _typed(spark: SparkSession, path: str, sep: str, types: dict) -> T.StructType:
    return _schema(_header(spark, path, sep), types)


def _paths(paths: str | list[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def order_file_schema(spark: SparkSession, path: str) -> T.StructType:
    return _typed(spark, path, ",", dict.fromkeys(RAW_ORDER_NUMBERS, T.DoubleType()))


def _files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Single files of paths that may be folders or patterns."""
    return sorted(spark.read.text(_paths(paths)).inputFiles())


def read_orders_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw order lines; amounts are doubles, everything else (dates too) stays text.

    Every file is read by its own header: files of equal headers together, then all by column name. A column that
    a file lacks is NULL in its lines.
    """
    return union_by_name(_order_parts(spark, paths))


def _order_parts(spark: SparkSession, paths: str | list[str]) -> list[DataFrame]:
    """One table for each header that occurs."""
    groups: dict[tuple[str, ...], list[str]] = {}
    found = _files(spark, paths)
    # A job for each file, and files grow with the orders: a few side by side, as a job holds one core.
    with ThreadPoolExecutor(8) as pool:
        headers = pool.map(lambda path: tuple(_header(spark, path, ",")), found)
        for path, header in zip(found, headers, strict=True):
            groups.setdefault(header, []).append(path)
    if not groups:
        raise ValueError("no order files")
    numbers = dict.fromkeys(RAW_ORDER_NUMBERS, T.DoubleType())
    return [spark.read.schema(_schema(header, numbers)).option("header", True).option("enforceSchema", False).csv(files)
            for header, files in groups.items()]


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def sample_orders_csv(spark: SparkSession, paths: str | list[str], n_rows: int = 1_000_000,
                      sample_position: str = "head") -> DataFrame:
    """The first or last ``max(1, n_rows // files)`` rows of each file, in file order.

    Row positions come from the sizes of the input splits (a small table);
    lines of other splits are dropped by the join with the wanted ones.
    """
    if sample_position not in ("head", "tail"):
        raise ValueError("sample_position must be 'head' or 'tail'")
    parts = _order_parts(spark, paths)
    share = max(1, n_rows // len(_files(spark, paths)))
    fields = union_by_name(parts).columns
    placed = union_by_name([part.select(
        "*", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id")) for part in parts])
    sizes = placed.groupBy("_file", "_split").agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
    earlier = (Window.partitionBy("_file").orderBy("_split")
               .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy("_file")
    starts = sizes.select("_file", "_split", "_first", "_rows",
                          F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
                          F.sum("_rows").over(whole).alias("_total"))
    if sample_position == "head":
        low, high = F.lit(0), F.lit(share)
    else:
        low, high = F.col("_total") - share, F.col("_total")
    # Written, so that the planner sees how few splits are wanted and need not shuffle the lines.
    wanted = materialize(starts.filter((F.col("_start") < high) & (F.col("_start") + F.col("_rows") > low)))
    at = F.col("_start") + F.col("_id") - F.col("_first")
    return placed.join(wanted, ["_file", "_split"]).filter((at >= low) & (at < high)).select(*fields)


def _order_digits(df: DataFrame):
    """Total order of order lines: time, then a hash of the ids to split equal times."""
    ids = [name for name in ("order_id", "product_id", "orderid", "productid") if name in df.columns]
    when = "order_dt" if "order_dt" in df.columns else "orderdt"
    if dict(df.dtypes)[when] == "string":
        # Two characters at a time, so that a digit has few values; what a time seldom has comes last.
        time = [F.substring(when, at, 2) for at in range(1, 20, 2)] + [F.substring(when, 21, 1000)]
    else:
        time = time_digits(F.col(when))
    key = draw_key(0, *ids)
    return time + hex_digits(key), [key] + [F.col(name) for name in ids] + [F.col("quantity")]


def first_orders(orders: DataFrame, n: int, *, leaf_rows: int = 100_000) -> DataFrame:
    return cut_orders(orders, [0, n], orders.count(), leaf_rows=leaf_rows)[0]


def last_orders(orders: DataFrame, n: int, *, leaf_rows: int = 100_000) -> DataFrame:
    total = orders.count()
    return cut_orders(orders, [max(0, total - n), total], total, leaf_rows=leaf_rows)[0]


def cut_orders(orders: DataFrame, cuts: list[int], total: int, *, leaf_rows: int = 100_000) -> list[DataFrame]:
    """Order lines between neighbouring row positions, in time order."""
    digits, ties = _order_digits(orders)
    return cut_rows(orders, digits, ties, cuts, total, leaf_rows=leaf_rows)


def read_orders_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def unblocked(products: DataFrame) -> DataFrame:
    """Drop blocked products; a product whose flag is unknown is dropped too."""
    if "blocked" not in products.columns:
        return products
    return products.filter(F.lower(F.col("blocked").cast("string")) != "true")


def read_products(spark: SparkSession, path: str, separator: str = ";", filter_blocked: bool = True) -> DataFrame:
    schema = _typed(spark, path, separator, PRODUCT_TYPES)
    products = spark.read.schema(schema).option("header", True).option("sep", separator).option("enforceSchema", False).csv(path)
    return unblocked(products) if filter_blocked else products


def read_commerces(spark: SparkSession, path: str, separator: str = ";") -> DataFrame:
    schema = _typed(spark, path, separator, COMMERCE_TYPES)
    return spark.read.schema(schema).option("header", True).option("sep", separator).option("enforceSchema", False).csv(path)


def write_parquet(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)
