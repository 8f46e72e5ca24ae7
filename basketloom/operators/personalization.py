"""How much recommendations differ between stores."""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.functions.hashing import draw_key
from basketloom.functions.ranking import top_lists, top_rows
from basketloom.operators.catalog import product_info
from basketloom.schema import PAIR_KEYS, QUERY_KEYS


def _by_score() -> list[Column]:
    return [F.desc("score"), F.asc("candidate_product_id")]


def top_k_per_query(scored: DataFrame, k: int = 5, rank_col: str | None = None) -> DataFrame:
    return top_rows(scored, QUERY_KEYS, _by_score(), k, rank_col)


def personalization_totals(top: DataFrame) -> DataFrame:
    return top.agg(F.count_distinct("kiosk_id").alias("n_kiosks"),
                   F.count_distinct(F.struct(*QUERY_KEYS)).alias("n_queries"),
                   F.count_distinct("candidate_product_id").alias("n_products"))


def kiosk_rec_sets(top: DataFrame) -> DataFrame:
    """The multiset of recommended products per store, one row per (store, product)."""
    return top.groupBy("kiosk_id", "candidate_product_id").agg(F.count("*").alias("times"))


def _query_lists(top: DataFrame, k: int) -> DataFrame:
    """Sorted list of at most k products per query."""
    return (top_lists(top, QUERY_KEYS, _by_score(), k, "candidate_product_id", "recs")
            .withColumn("recs", F.sort_array("recs")))


def anchor_list_diversity(top: DataFrame, k: int = 5) -> DataFrame:
    """Per anchor: stores, distinct lists, and distinct lists per store in percent."""
    keyed = _query_lists(top, k).select(*QUERY_KEYS, F.array_join("recs", ",").alias("list_key"))
    stats = keyed.groupBy("anchor_product_id").agg(
        F.count_distinct("kiosk_id").alias("n_kiosks"), F.count_distinct("list_key").alias("n_unique_lists"))
    return stats.withColumn("pct_unique", F.col("n_unique_lists") / F.col("n_kiosks") * 100)


def top_anchors(diversity: DataFrame, n: int = 10) -> DataFrame:
    return diversity.orderBy(F.desc("n_kiosks"), F.asc("anchor_product_id")).limit(n)


def anchor_diversity_summary(diversity: DataFrame) -> DataFrame:
    shares = diversity.groupBy("pct_unique").agg(F.count("*").alias("times"))
    return shares.agg(F.try_divide(F.sum(F.col("pct_unique") * F.col("times")), F.sum("times")).alias("avg_pct"),
                      F.percentile("pct_unique", 0.5, F.col("times")).alias("median_pct"))


def global_baseline_topk(top: DataFrame, k: int = 5) -> DataFrame:
    """Per anchor the k candidates of highest mean score over stores."""
    means = top.groupBy(*PAIR_KEYS).agg(F.avg("score").alias("avg_score"))
    # Means are compared to nine digits, so that the order of summation cannot decide a tie.
    order = [F.desc(F.round("avg_score", 9)), F.asc("candidate_product_id")]
    return top_rows(means, ["anchor_product_id"], order, k).select(*PAIR_KEYS)


def baseline_overlap(top: DataFrame, k: int = 5) -> DataFrame:
    """One row: mean and quartiles of the share of each list found in the anchor's baseline."""
    known = global_baseline_topk(top, k).withColumn("_in", F.lit(1))
    shares = (top.join(known, PAIR_KEYS, "left").groupBy(*QUERY_KEYS)
              .agg((F.count("_in") / F.count("*") * 100).alias("pct")))
    # Few distinct shares exist, so they are counted before the quantiles.
    counted = shares.groupBy("pct").agg(F.count("*").alias("times"))
    return counted.agg(F.try_divide(F.sum(F.col("pct") * F.col("times")), F.sum("times")).alias("mean_overlap"),
                       *[F.percentile("pct", share, F.col("times")).alias(name)
                         for name, share in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))])


def most_popular_anchor(top: DataFrame) -> Column:
    """The anchor recommended for in most stores, as a scalar subquery."""
    stores = top.groupBy("anchor_product_id").agg(F.count_distinct("kiosk_id").alias("n_kiosks"))
    return top_anchors(stores, 1).select("anchor_product_id").scalar()


def _jaccard_weights(k: int) -> list[float]:
    """Weight of (shared subset size j, list sizes m, n) in a sum of Jaccard similarities, flat over 0..k each.

    A pair that shares i products shares C(i, j) subsets of size j; the weights undo that count.
    """
    def weight(j: int, m: int, n: int) -> float:
        return sum((-1) ** (j - i) * comb(j, i) * i / (m + n - i) for i in range(1, min(j, m, n) + 1))

    return [weight(j, m, n) for j in range(k + 1) for m in range(k + 1) for n in range(k + 1)]


def pairwise_jaccard(top: DataFrame, k: int = 5) -> DataFrame:
    """Mean Jaccard similarity of the lists of all store pairs for the most popular anchor.

    No pair is formed: each list gives its subsets (32 of a list of five), lists are counted per subset and length, and
    pairs that share a subset follow from the counts. For lists of more than ten products draw pairs instead.
    """
    if k > 10:
        raise ValueError("lists of more than ten products have too many subsets: use sampled_jaccard")
    lists = _query_lists(top.filter(F.col("anchor_product_id") == most_popular_anchor(top)), k)
    masks = F.sequence(F.lit(0), F.shiftleft(F.lit(1), k) - 1)
    size = F.size("recs")
    subset = F.transform(F.filter(masks, lambda m: m < F.pow(F.lit(2), size)), lambda m: F.filter(
        "recs", lambda _, i: F.call_function("shiftright", m, i).bitwiseAND(F.lit(1)) == 1))
    counted = (lists.select(size.alias("m"), F.explode(subset).alias("s"))
               .groupBy("s", "m").agg(F.count("*").alias("c")))
    # One row per subset with at most k list lengths.
    lengths = counted.groupBy("s").agg(F.collect_list(F.struct("m", "c")).alias("by"))
    pairs = lengths.select(F.size("s").alias("j"), F.explode("by").alias("a"), "by").select("j", "a", F.explode("by").alias("b"))
    pairs = pairs.filter(F.col("a.m") <= F.col("b.m"))
    a, b = F.col("a.c").cast("double"), F.col("b.c").cast("double")
    number = F.when(F.col("a.m") == F.col("b.m"), a * (a - 1) / 2).otherwise(a * b)
    place = (F.col("j") * (k + 1) + F.col("a.m")) * (k + 1) + F.col("b.m")
    weight = F.get(F.array(*[F.lit(w) for w in _jaccard_weights(k)]), place)
    sums = pairs.agg(F.coalesce(F.sum(F.when(F.col("j") == 0, number)), F.lit(0.0)).alias("n"), F.sum(number * weight).alias("total"))
    return sums.select(F.col("n").cast("bigint").alias("n_pairs"), F.try_divide("total", "n").alias("mean_jaccard"))


def sampled_jaccard(top: DataFrame, k: int = 5, max_kiosks: int = 200, max_pairs: int = 1000,
                     seed: int = 42) -> DataFrame:
    """Mean Jaccard similarity of the lists of sampled store pairs for the most popular anchor.

    The sample (a feature of the report) bounds everything here: its lists
    travel in one array, whose pairs are unfolded without a join.
    """
    lists = _query_lists(top.filter(F.col("anchor_product_id") == most_popular_anchor(top)), k)
    sample = lists.orderBy(draw_key(seed, "kiosk_id"), "kiosk_id").limit(max_kiosks)
    held = sample.agg(F.sort_array(F.collect_list(F.struct("kiosk_id", "recs"))).alias("all"))
    heads = held.select("all", F.posexplode("all").alias("at", "a"))
    pairs = heads.select("a", F.explode(F.slice("all", F.col("at") + 2, F.size("all"))).alias("b"))
    flat = pairs.select(F.col("a.kiosk_id").alias("k1"), F.col("b.kiosk_id").alias("k2"),
                        F.col("a.recs").alias("r1"), F.col("b.recs").alias("r2"))
    chosen = flat.orderBy(draw_key(seed, "k1", "k2"), "k1", "k2").limit(max_pairs)
    score = F.size(F.array_intersect("r1", "r2")) / F.size(F.array_union("r1", "r2"))
    return chosen.agg(F.count("*").alias("n_pairs"), F.avg(score).alias("mean_jaccard"))


def example_recs(top: DataFrame, products: DataFrame | None = None, k: int = 5, n_kiosks: int = 3,
                 seed: int = 123) -> DataFrame:
    """Ranked lists of a few sampled stores for the most popular anchor, with product names."""
    rows = top.filter(F.col("anchor_product_id") == most_popular_anchor(top))
    kiosks = rows.select("kiosk_id").distinct().orderBy(draw_key(seed, "kiosk_id"), "kiosk_id").limit(n_kiosks)
    ranked = top_k_per_query(rows.join(kiosks, "kiosk_id", "left_semi"), k, "rank")
    out = ranked.select("kiosk_id", "anchor_product_id", "rank", "candidate_product_id")
    if products is None:
        return out
    names = product_info(products).select(F.col("product_id").alias("candidate_product_id"),
                                          F.col("product_name").alias("candidate_name"))
    return out.join(names, "candidate_product_id", "left").select(*out.columns, "candidate_name")
