"""New versus repeat products among recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.operators.catalog import product_info
from basketloom.operators.personalization import top_k_per_query
from basketloom.schema import QUERY_KEYS


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(100.0 * part, whole)


def new_vs_repeat_pool(rows: DataFrame) -> DataFrame:
    """One row: all rows, new and repeat ones, with shares in percent."""
    total, new = F.count("*"), F.count_if(F.col("cand_is_new") == 1)
    return rows.agg(total.alias("total"), new.alias("n_new"), (total - new).alias("n_repeat"),
                    _share(new, total).alias("new_pct"), _share(total - new, total).alias("repeat_pct"))


def new_vs_repeat_totals(scored: DataFrame, k: int = 5) -> DataFrame:
    return new_vs_repeat_pool(top_k_per_query(scored, k))


def new_share_by_position(scored: DataFrame, k: int = 5) -> DataFrame:
    """Share of new products at each list position; positions without rows are absent."""
    return (top_k_per_query(scored, k, "rank").groupBy("rank")
            .agg(F.count("*").alias("n"),
                 _share(F.count_if(F.col("cand_is_new") == 1), F.count("*")).alias("new_pct")))


def avg_pop_store(scored: DataFrame, k: int = 5) -> DataFrame:
    """One row: mean store popularity of all rows, of the top-k, and of its repeat products."""
    repeat = F.when(F.col("cand_is_new") == 0, F.col("pop_store"))
    top = top_k_per_query(scored, k).agg(F.struct(F.avg("pop_store").alias("top"),
                                                  F.avg(repeat).alias("again")).alias("means")).scalar()
    return scored.agg(F.avg("pop_store").alias("avg_all")).select(
        "avg_all", top["top"].alias("avg_top"), top["again"].alias("avg_top_repeat"))


def mixed_queries(scored: DataFrame, k: int = 5) -> DataFrame:
    """Queries whose top-k holds both new and repeat products."""
    counts = top_k_per_query(scored, k).groupBy(*QUERY_KEYS).agg(
        F.sum(F.col("cand_is_new").cast("bigint")).alias("n_new"), F.count("cand_is_new").alias("n_total"))
    return counts.filter((F.col("n_new") > 0) & (F.col("n_new") < F.col("n_total")))


def mixed_query_examples(scored: DataFrame, products: DataFrame, k: int = 5, n: int = 3) -> DataFrame:
    """The lists of the first ``n`` mixed queries with names and a NEW tag."""
    info = product_info(products)
    shown = mixed_queries(scored, k).orderBy(*QUERY_KEYS).limit(n).select(*QUERY_KEYS)
    ranked = top_k_per_query(scored.join(shown, QUERY_KEYS, "left_semi"), k, "rank")
    names = info.select(F.col("product_id").alias("candidate_product_id"),
                        F.col("product_name").alias("candidate_name"))
    anchors = info.select(F.col("product_id").alias("anchor_product_id"),
                          F.col("product_name").alias("anchor_name"))
    tag = F.when(F.col("cand_is_new") == 1, "NEW").otherwise("")
    return (ranked.join(names, "candidate_product_id", "left").join(anchors, "anchor_product_id", "left")
            .select(*QUERY_KEYS, "anchor_name", "rank", tag.alias("tag"), "pop_store",
                    "candidate_product_id", "candidate_name"))
