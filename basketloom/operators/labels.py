"""Label pairs: products that one store buys together, in an order or inside a time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.functions.durable import materialize
from basketloom.functions.times import DAY_MICROS, micros
from basketloom.operators.baskets import BASKET_KEYS, build_baskets
from basketloom.operators.pairs import half_pairs, half_pairs_of_large_groups, mirrored, spread_join
from basketloom.schema import QUERY_KEYS, ROW_KEYS, require_columns


def label_pairs_same_order(orders: DataFrame, *, array_items: int = 200) -> DataFrame:
    """Directed product pairs per store with the number of orders holding both.

    Orders of up to ``array_items`` products give their pairs from an array,
    larger ones go through the block join; nothing is dropped.
    """
    small = half_pairs(build_baskets(orders, 2, array_items), ["kiosk_id"])
    lines = orders.select(*BASKET_KEYS, "product_id").distinct()
    large = materialize(lines.groupBy(*BASKET_KEYS).agg(F.count("*").alias("n")).filter(F.col("n") > array_items))
    both = small
    if not large.isEmpty():
        items = lines.join(large, BASKET_KEYS, "left_semi").withColumn("one", F.lit(1).cast("bigint"))
        many = half_pairs_of_large_groups(items, BASKET_KEYS, "product_id", "one")
        both = small.unionByName(many.select("kiosk_id", "left", "right"))
    counted = both.groupBy("kiosk_id", "left", "right").agg(F.count("*").alias("cooc_count"))
    return mirrored(counted, ["kiosk_id"])


def _window_events(orders: DataFrame, dt_col: str, width: int) -> DataFrame:
    """Lines per (store, product, instant) with the window-wide time bucket of the instant."""
    return (orders.filter(F.col(dt_col).isNotNull())
            .groupBy("kiosk_id", "product_id", micros(F.col(dt_col)).alias("at"))
            .agg(F.count("*").alias("n"))
            .withColumn("bucket", F.floor(F.col("at") / width).cast("bigint")))


def _bucket_pairs(events: DataFrame, width: int) -> DataFrame:
    """Plain interval join: anchors go to their own and the next bucket, candidates to theirs."""
    anchors = events.select("kiosk_id", F.col("product_id").alias("anchor_product_id"),
                            F.col("at").alias("from_at"), F.col("n").alias("n1"),
                            F.explode(F.array("bucket", F.col("bucket") + 1)).alias("bucket"))
    others = events.select("kiosk_id", F.col("product_id").alias("candidate_product_id"),
                           F.col("at").alias("to_at"), F.col("n").alias("n2"), "bucket")
    gap = F.col("to_at") - F.col("from_at")
    return (anchors.join(others, ["kiosk_id", "bucket"])
            .filter((F.col("anchor_product_id") != F.col("candidate_product_id")) & gap.between(0, width))
            .select(*ROW_KEYS, (F.col("n1") * F.col("n2")).alias("pairs")))


def _tree_pairs(events: DataFrame, width: int, products_per_cell: int = 1_000) -> DataFrame:
    """The same counts for busy stores, without comparing instants pair by pair.

    Inside one bucket a candidate counts if it comes at or after the anchor;
    in the next bucket if its offset is at most the anchor's. Both are order
    tests on offsets. Two different offsets part at exactly one bit level of a
    binary tree over the bucket, so the counts per (tree node, product)
    multiply: left half times right half at each node, plus equal offsets.
    The work grows with lines times products instead of lines squared.
    """
    levels = (width - 1).bit_length()
    bits = F.sequence(F.lit(0), F.lit(levels))
    spread = events.withColumn("offset", F.col("at") - F.col("bucket") * width)

    def side(lower: bool) -> DataFrame:
        # frame 2b: anchors and candidates of bucket b; frame 2b + 1: anchors of b, candidates of b + 1.
        level = F.col("level")
        node = F.expr("shiftright(offset, level)")
        odd = (node % 2) == 1
        role = spread.withColumn("level", F.explode(bits))
        if lower:   # anchors: earlier half in their own bucket, later half against the next one
            frames = F.array(F.struct((F.col("bucket") * 2).alias("frame"), (~odd).alias("fits")),
                             F.struct((F.col("bucket") * 2 + 1).alias("frame"), odd.alias("fits")))
        else:
            frames = F.array(F.struct((F.col("bucket") * 2).alias("frame"), odd.alias("fits")),
                             F.struct((F.col("bucket") * 2 - 1).alias("frame"), (~odd).alias("fits")))
        halves = (role.filter(level < levels).withColumn("f", F.explode(frames)).filter("f.fits")
                  .select("kiosk_id", "product_id", "n", F.col("f.frame").alias("frame"), "level",
                          F.expr("shiftright(offset, level + 1)").alias("node")))
        own = F.col("bucket") * 2
        beside = own + 1 if lower else own - 1
        equal = (spread.withColumn("frame", F.explode(F.array(own, beside)))
                 .select("kiosk_id", "product_id", "n", "frame", F.lit(-1).alias("level"),
                         F.col("offset").alias("node")))
        return (halves.unionByName(equal)
                .groupBy("kiosk_id", "frame", "level", "node", "product_id").agg(F.sum("n").alias("n")))

    where = ["kiosk_id", "frame", "level", "node"]
    anchors = side(True).withColumnRenamed("product_id", "anchor_product_id").withColumnRenamed("n", "n1")
    others = side(False).withColumnRenamed("product_id", "candidate_product_id").withColumnRenamed("n", "n2")
    # A node with many products is cut into cells by candidate, each joined apart; all others are one cell as they are.
    # Written, so that the few large nodes, mostly none, meet the sides as a small table.
    large = materialize(others.groupBy(*where).agg(F.ceil(F.count("*") / products_per_cell).cast("int").alias("cells")).where("cells > 1"))
    one = F.lit(0)
    if large.isEmpty():
        anchors, others = anchors.withColumn("cell", one), others.withColumn("cell", one)
    else:
        many_others = spread_join(others, large, where, "candidate_product_id").withColumn(
            "cell", F.pmod(F.xxhash64("candidate_product_id"), F.col("cells")).cast("int")).drop("cells")
        many_anchors = spread_join(anchors, large, where, "anchor_product_id").withColumn(
            "cell", F.explode(F.sequence(one, F.col("cells") - 1))).drop("cells")
        others = others.join(large, where, "left_anti").withColumn("cell", one).unionByName(many_others)
        anchors = anchors.join(large, where, "left_anti").withColumn("cell", one).unionByName(many_anchors)
    # The planner takes the sides, unfolded over all levels, for as small as the points they come from, and would broadcast one.
    return (anchors.join(others.hint("merge"), [*where, "cell"])
            .filter(F.col("anchor_product_id") != F.col("candidate_product_id"))
            .select(*ROW_KEYS, (F.col("n1") * F.col("n2")).alias("pairs")))


def label_pairs_window(orders: DataFrame, *, window_days: int = 7, dt_col: str = "order_dt",
                       busy_bucket: int = 2_000) -> DataFrame:
    """Directed pairs per store where the candidate line follows within ``window_days`` (ends included).

    Counts line pairs; same-instant lines of different products count. Stores
    with more than ``busy_bucket`` (product, instant) points in any one window
    take the tree form, all others the interval join, so no join key holds
    more than ``2 * busy_bucket`` points. Points and busy stores are written once.
    """
    require_columns(orders, [dt_col])
    width = window_days * DAY_MICROS
    # Written: the look for busy stores and both forms read it.
    events = materialize(_window_events(orders, dt_col, width))
    busy = (events.groupBy("kiosk_id", "bucket").agg(F.count("*").alias("points"))
            .filter(F.col("points") > busy_bucket).select("kiosk_id").distinct())
    busy = materialize(busy)
    if busy.isEmpty():
        pairs = _bucket_pairs(events, width)
    else:
        pairs = _bucket_pairs(events.join(busy, "kiosk_id", "left_anti"), width).unionByName(
            _tree_pairs(events.join(busy, "kiosk_id", "left_semi"), width))
    return pairs.groupBy(*ROW_KEYS).agg(F.sum("pairs").alias("cooc_count"))


def build_label_pairs(orders: DataFrame, *, window_days: int | None = None, min_cooc_label: int | None = None,
                      dt_col: str = "order_dt") -> DataFrame:
    require_columns(orders, ["kiosk_id", "order_id", "product_id"])
    if window_days is None:
        pairs = label_pairs_same_order(orders)
    else:
        pairs = label_pairs_window(orders, window_days=window_days, dt_col=dt_col)
    if min_cooc_label is not None and min_cooc_label > 1:
        pairs = pairs.filter(F.col("cooc_count") >= min_cooc_label)
    return pairs


def label_rows(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows with ``label`` 1 where the pair is positive, else 0."""
    positive = pairs.select(*ROW_KEYS).withColumn("_positive", F.lit(1))
    label = F.coalesce(F.col("_positive"), F.lit(0)).cast("tinyint").alias("label")
    return rows.join(positive, ROW_KEYS, "left").select(*rows.columns, label)


def build_labels(features: DataFrame, orders: DataFrame, *, window_days: int | None = None,
                 min_cooc_label: int | None = None, dt_col: str = "order_dt") -> DataFrame:
    require_columns(features, ROW_KEYS)
    return label_rows(features, build_label_pairs(
        orders, window_days=window_days, min_cooc_label=min_cooc_label, dt_col=dt_col))


def queries_with_positives(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """The queries that have a positive pair at all."""
    return queries.join(pairs.select(*QUERY_KEYS).distinct(), QUERY_KEYS, "left_semi").select(*queries.columns)


def candidate_recall(queries: DataFrame, rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: positives of the evaluated queries, those among the candidates, their ratio.

    The ratio is NULL where no positives exist.
    """
    positives = pairs.select(*ROW_KEYS).join(queries.select(*QUERY_KEYS).distinct(), QUERY_KEYS, "left_semi")
    offered = rows.select(*ROW_KEYS).distinct().withColumn("_offered", F.lit(1))
    counted = positives.join(offered, ROW_KEYS, "left").agg(
        F.count("*").alias("total_pos"), F.count("_offered").alias("hits"))
    return counted.withColumn("recall", F.try_divide("hits", "total_pos"))
