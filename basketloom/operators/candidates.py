"""Market-basket candidates: co-occurrence, association measures, top-K per anchor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.functions.durable import materialize
from basketloom.functions.ranking import top_rows
from basketloom.operators.baskets import explode_baskets, product_basket_counts
from basketloom.operators.pairs import half_pairs, half_pairs_of_large_groups, mirrored
from basketloom.schema import PAIR_KEYS, require_columns


def pair_cooccurrence(baskets: DataFrame, min_cooc: int = 2) -> DataFrame:
    """Ordered product pairs that meet in at least ``min_cooc`` orders.

    Orders meet on ``order_id`` alone. An id used by one basket (the normal
    case) gives its pairs straight from the array, without a join or shuffle;
    an id shared by several stores is counted over all of its baskets by the
    block join, planned only where such ids exist (a look at the id column, so
    pass a written table). Pairs are counted once per unordered pair and
    mirrored after the filter.
    """
    require_columns(baskets, ["order_id", "products"])
    shared = baskets.groupBy("order_id").agg(F.count("*").alias("n")).filter("n > 1").select("order_id")
    if shared.isEmpty():
        counted = half_pairs(baskets, []).groupBy("left", "right").agg(F.count("*").alias("cooc_count"))
    else:
        single = half_pairs(baskets.join(shared, "order_id", "left_anti"), [])
        items = (explode_baskets(baskets.join(shared, "order_id", "left_semi"))
                 .groupBy("order_id", "product_id").agg(F.count("*").alias("times")))
        several = half_pairs_of_large_groups(items, ["order_id"], "product_id", "times")
        together = single.withColumn("weight", F.lit(1).cast("bigint")).unionByName(
            several.select("left", "right", "weight"))
        counted = together.groupBy("left", "right").agg(F.sum("weight").alias("cooc_count"))
    return mirrored(counted.filter(F.col("cooc_count") >= min_cooc), [])


def generate_candidates(baskets: DataFrame, min_cooc: int = 2) -> DataFrame:
    """Pairs with support, confidence, lift and cosine.

    Basket counts per product are written, so that the planner knows whether
    they are small enough to broadcast to the pairs. The rule that a product must lie in ``min_cooc`` baskets is applied on the
    counts joined here anyway: it drops the same pairs as filtering the items
    first, and saves regrouping the baskets.
    """
    counts = materialize(product_basket_counts(explode_baskets(baskets)).filter(F.col("product_count") >= min_cooc))
    total = baskets.agg(F.count("*").cast("double").alias("n")).scalar()
    return with_measures(pair_cooccurrence(baskets, min_cooc), counts, total)


def with_measures(cooccurring: DataFrame, counts: DataFrame, total: Column) -> DataFrame:
    """Ordered pairs (anchor, candidate, cooc_count) with their measures, from basket counts per product and in all."""
    anchors = counts.select(F.col("product_id").alias("anchor_product_id"),
                            F.col("product_count").alias("anchor_count"))
    others = counts.select(F.col("product_id").alias("candidate_product_id"),
                           F.col("product_count").alias("candidate_count"))
    pairs = cooccurring.join(anchors, "anchor_product_id").join(others, "candidate_product_id")
    both, anchor, other = F.col("cooc_count"), F.col("anchor_count"), F.col("candidate_count")
    return pairs.select(
        *PAIR_KEYS, "cooc_count", "anchor_count", "candidate_count",
        (both / total).alias("support"),
        (both / anchor).alias("confidence"),
        ((both / total) / ((anchor / total) * (other / total))).alias("lift"),
        (both / F.sqrt(anchor * other)).alias("cooc_cosine_sim"))


def select_top_k_candidates(candidates: DataFrame, k: int = 50, min_lift: float = 1.0) -> DataFrame:
    """Per anchor the ``k`` candidates of highest lift, then count, then product id."""
    require_columns(candidates, [*PAIR_KEYS, "lift", "cooc_count"])
    order = [F.desc("lift"), F.desc("cooc_count"), F.asc("candidate_product_id")]
    by = ["anchor_product_id"]
    kept = top_rows(candidates.filter(F.col("lift") >= min_lift), by, order, k)
    return kept.select(*PAIR_KEYS, *[name for name in ("cooc_cosine_sim",) if name in candidates.columns])


def topk_candidate_stats(topk: DataFrame, k: int) -> DataFrame:
    """One row: anchors and the spread of candidates per anchor."""
    sizes = (topk.groupBy("anchor_product_id").agg(F.count("*").alias("n"))
             .groupBy("n").agg(F.count("*").alias("times")))
    anchors = F.coalesce(F.sum("times"), F.lit(0))
    full = F.coalesce(F.sum(F.when(F.col("n") >= k, F.col("times"))), F.lit(0))
    return sizes.agg(anchors.alias("n_anchors"), F.min("n").alias("min_cands"),
                     F.try_divide(F.sum(F.col("n") * F.col("times")), F.sum("times")).alias("mean_cands"),
                     F.percentile("n", 0.5, F.col("times")).alias("median_cands"),
                     F.max("n").alias("max_cands"), full.alias("n_full"),
                     F.coalesce(F.try_divide(100.0 * full, anchors), F.lit(0.0)).alias("pct_full"))
