"""The shared inputs of the registered queries, built from the star tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.functions.durable import materialize
from basketloom.operators import baskets, candidates, cleaning, features, labels, splits
from basketloom.operators.catalog import predictions_catalog, product_info
from basketloom.operators.personalization import top_k_per_query
from basketloom.schema import ROW_KEYS
from basketloom.sources.files import unblocked
from basketloom.sources.star import StarTables

MIN_COOC = 2
MIN_LIFT = 1.2
TOP_K = 100
LABEL_DAYS = 7
CATALOG_K = 20
REPORT_K = 5


class Stages:
    """Tables of each stage, built on demand for one query.

    Stages that later steps read several times are written once (products,
    stores, cleaned orders, baskets, candidates, label pairs, judged rows), as
    a plan over a real order history would; the rest is lazy.
    """

    def __init__(self, spark: SparkSession, directory: str, min_lift: float = MIN_LIFT):
        self.spark = spark
        self.tables = StarTables(spark, directory)
        self.min_lift = min_lift

    @cached_property
    def raw(self) -> DataFrame:
        return self.tables.raw_orders()

    @cached_property
    def all_products(self) -> DataFrame:
        return materialize(self.tables.all_products())

    @property
    def products(self) -> DataFrame:
        return unblocked(self.all_products)

    @cached_property
    def commerces(self) -> DataFrame:
        return materialize(self.tables.commerces())

    @cached_property
    def clean(self) -> DataFrame:
        return cleaning.preprocess_orders(self.raw)

    @cached_property
    def active(self) -> tuple[DataFrame, DataFrame]:
        return cleaning.filter_active_kiosks(self.clean, self.commerces)

    @property
    def kept_orders(self) -> DataFrame:
        blocked = cleaning.blocked_product_ids(self.all_products)
        return cleaning.filter_blocked_products(self.active[0], blocked)

    @cached_property
    def orders(self) -> DataFrame:
        return materialize(self.kept_orders)

    @cached_property
    def split(self) -> splits.OrderSplit:
        return splits.split_orders_by_time(self.orders, train_ratio=0.8, val_ratio=0.1, test_ratio=0.1)

    @property
    def train(self) -> DataFrame:
        return self.split.train

    @property
    def test(self) -> DataFrame:
        return self.split.test

    @property
    def lazy_baskets(self) -> DataFrame:
        return baskets.build_baskets(self.train)

    @cached_property
    def baskets(self) -> DataFrame:
        return materialize(self.lazy_baskets)

    @cached_property
    def items(self) -> DataFrame:
        return baskets.explode_baskets(self.baskets)

    @cached_property
    def candidates(self) -> DataFrame:
        return candidates.generate_candidates(self.baskets, MIN_COOC)

    @cached_property
    def topk(self) -> DataFrame:
        return materialize(self.lazy_topk)

    @property
    def lazy_topk(self) -> DataFrame:
        return candidates.select_top_k_candidates(self.candidates, TOP_K, self.min_lift)

    @cached_property
    def queries(self) -> DataFrame:
        """Queries of the test period."""
        return baskets.kiosk_anchor_queries(baskets.build_baskets(self.test))

    @cached_property
    def rows(self) -> DataFrame:
        return features.build_feature_table(None, self.topk, self.queries)

    @cached_property
    def features(self) -> DataFrame:
        return features.add_all_features(self.rows, orders=self.train, products=self.products,
                                         commerces=self.active[1], durable=True)

    @cached_property
    def pairs(self) -> DataFrame:
        return labels.build_label_pairs(self.test, window_days=LABEL_DAYS)

    @cached_property
    def labeled(self) -> DataFrame:
        return materialize(self.lazy_labeled)

    @property
    def lazy_labeled(self) -> DataFrame:
        return labels.label_rows(self.rows, self.pairs)

    @cached_property
    def popular_rows(self) -> DataFrame:
        return features.feat_pop_store(self.rows, self.train)

    @staticmethod
    def with_score(rows: DataFrame) -> DataFrame:
        """A score that SQL can state too, in place of a model's."""
        return rows.withColumn("score", F.round(F.col("cooc_cosine_sim") + 0.01 * F.col("pop_store"), 9))

    @cached_property
    def scored(self) -> DataFrame:
        """Test rows with score, popularity and novelty."""
        return self.with_score(features.feat_cand_is_new(self.popular_rows))

    @cached_property
    def judged(self) -> DataFrame:
        """Test rows with label and score."""
        return materialize(labels.label_rows(self.with_score(self.popular_rows), self.pairs).select(
            *ROW_KEYS, "label", "score"))

    @cached_property
    def info(self) -> DataFrame:
        return product_info(self.products)

    @cached_property
    def top(self) -> DataFrame:
        """The report lists, which most reports read twice."""
        return materialize(top_k_per_query(self.scored.select(*ROW_KEYS, "score"), REPORT_K))

    @cached_property
    def catalog(self) -> DataFrame:
        return predictions_catalog(self.scored, self.info, CATALOG_K)
