"""Product pairs inside groups, with a bounded amount of work per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Parts of a group in a join with a table of one row per group.
SALTS = 16


def spread_join(rows: DataFrame, groups: DataFrame, by: list[str], item: str) -> DataFrame:
    """``rows`` joined to the one row of their group, a large group in SALTS parts.

    The small side is repeated for each part, so no task gets a whole group.
    """
    parts = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(F.lit("salt"), item), F.lit(SALTS)).cast("int"))
    return salted.join(parts, [*by, "_salt"]).drop("_salt")


def half_pairs(arrays: DataFrame, by: list[str]) -> DataFrame:
    """Each unordered pair (left < right) of sorted, bounded ``products`` arrays; no shuffle."""
    heads = arrays.select(*by, "products", F.posexplode("products").alias("_at", "left"))
    rest = F.slice("products", F.col("_at") + 2, F.size("products"))
    return heads.select(*by, "left", F.explode(rest).alias("right"))


def half_pairs_of_large_groups(items: DataFrame, by: list[str], item: str, weight: str,
                               cell_items: int = 1_000) -> DataFrame:
    """Unordered pairs of groups of any size, weighted by the product of the item weights.

    A group of n items is cut into ceil(n / cell_items) blocks and joined
    block against block: each cell is a join key of its own with at most about
    ``2 * cell_items`` items, so a large group is spread over many tasks.
    """
    sizes = items.groupBy(*by).agg(F.ceil(F.count("*") / cell_items).cast("int").alias("_blocks"))
    placed = spread_join(items, sizes, by, item).withColumn("_block", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int"))
    spread = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cells = spread.select(*by, F.least("_block", "_other").alias("_low"),
                          F.greatest("_block", "_other").alias("_high"), "_block",
                          F.col(item).alias("left"), F.col(weight).alias("_weight"))
    others = cells.select(*by, "_low", "_high", F.col("_block").alias("_block2"),
                          F.col("left").alias("right"), F.col("_weight").alias("_weight2"))
    once = (F.least("_block", "_block2") == F.col("_low")) & (F.greatest("_block", "_block2") == F.col("_high"))
    return (cells.join(others, [*by, "_low", "_high"])
            .filter((F.col("left") < F.col("right")) & once)
            .select(*by, "left", "right", (F.col("_weight") * F.col("_weight2")).alias("weight")))


def mirrored(counted: DataFrame, by: list[str]) -> DataFrame:
    """Both directions of counted half pairs, from one pass over them."""
    ways = F.explode(F.array(F.struct(F.col("left").alias("a"), F.col("right").alias("c")),
                             F.struct(F.col("right").alias("a"), F.col("left").alias("c"))))
    return counted.withColumn("_way", ways).select(
        *by, F.col("_way.a").alias("anchor_product_id"), F.col("_way.c").alias("candidate_product_id"), "cooc_count")
