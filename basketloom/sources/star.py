"""Reads a star schema (lineitem, orders, part, customer, nation, region) as order history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.sources.files import unblocked


class StarTables:
    """Order lines, products and stores of one parquet directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    @staticmethod
    def _sku():
        return F.concat(F.col("p_brand"), F.lit("-"), F.col("p_type"))

    def raw_orders(self) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
        heads = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        parts = self.table("part").select("p_partkey", self._sku().alias("productid"))
        return (
            lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.when(F.col("l_returnflag") == "R", "return").otherwise("order").alias("documenttype"),
                F.col("o_orderkey").cast("string").alias("orderid"),
                F.col("o_custkey").cast("string").alias("userid"),
                "productid",
                F.col("o_orderdate").alias("orderdt"),
                F.col("l_quantity").alias("quantity"),
            )
        )

    def all_products(self) -> DataFrame:
        return (
            self.table("part")
            .groupBy(self._sku().alias("productid"))
            .agg(F.min("p_name").alias("name"), F.min("p_type").alias("category"),
                 (F.min("p_brand") == "Brand#13").alias("blocked"))
        )

    def products(self) -> DataFrame:
        return unblocked(self.all_products())

    def commerces(self) -> DataFrame:
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select("n_nationkey", F.col("r_name").alias("region"))
        return (
            self.table("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").cast("string").alias("userid"),
                    F.col("c_mktsegment").alias("channel"), "region",
                    (F.col("c_acctbal") >= 0).alias("active"))
        )
