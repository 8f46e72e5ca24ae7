"""Scoring plan: recent orders and a trained model to the catalog and its three fallbacks."""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession

from basketloom.functions.durable import collected, materialize, scratch
from basketloom.functions.scaling import value_range
from basketloom.operators import catalog as ct
from basketloom.operators.baskets import build_baskets, kiosk_anchor_queries
from basketloom.operators.candidates import generate_candidates, select_top_k_candidates
from basketloom.operators.cleaning import (
    active_kiosk_ids,
    blocked_product_ids,
    filter_active_kiosks,
    filter_blocked_products,
    inference_window,
)
from basketloom.operators.features import feature_facts, feature_rows, sample_queries
from basketloom.operators.ranker import Ranker, predict_scores
from basketloom.schema import ROW_KEYS
from basketloom.sources.files import read_commerces, read_products, unblocked, write_parquet


@dataclass(frozen=True)
class ScoringParams:
    """The defaults of the scoring run."""

    last_n_days: int = 30
    max_rows: int = 0
    query_sample_n: int = 0
    min_cooc: int = 3
    min_lift: float = 2.0
    top_k_candidates: int = 250
    catalog_top_k: int = 100


@dataclass(frozen=True)
class CatalogTables:
    predictions: DataFrame
    anchors: DataFrame
    categories: DataFrame
    overall: DataFrame
    coverage: DataFrame

    WRITTEN: ClassVar[tuple[str, ...]] = ("predictions", "anchors", "categories", "overall")

    def write(self, folder: str) -> None:
        for name in self.WRITTEN:
            write_parquet(getattr(self, name), f"{folder}/{name}")


def build_catalog(orders: DataFrame, all_products: DataFrame, commerces: DataFrame, ranker: Ranker,
                  params: ScoringParams = ScoringParams()) -> CatalogTables:
    """Catalog, fallbacks and coverage from cleaned orders.

    Orders, baskets, top candidates and scores are read several times and
    written once; only keys and the score of the feature rows are kept.
    """
    known = active_kiosk_ids(commerces) if "active" in commerces.columns else None
    orders = filter_blocked_products(orders, blocked_product_ids(all_products))
    orders, commerces = filter_active_kiosks(orders, commerces)
    recent = materialize(inference_window(materialize(orders), params.last_n_days, params.max_rows))
    baskets = materialize(build_baskets(recent))
    candidates = generate_candidates(baskets, params.min_cooc)
    topk = materialize(select_top_k_candidates(candidates, params.top_k_candidates, params.min_lift))

    queries = kiosk_anchor_queries(baskets)
    if params.query_sample_n > 0:
        queries = sample_queries(materialize(queries), params.query_sample_n)
    products = unblocked(all_products)
    rows = feature_rows(queries, topk, feature_facts(recent, products, commerces, durable=True))
    scored = materialize(predict_scores(rows, ranker).select(*ROW_KEYS, "score"))

    info = ct.product_info(products)
    span = value_range(scored, "score")
    predictions = ct.predictions_catalog(scored, info, params.catalog_top_k)
    return CatalogTables(
        predictions,
        ct.anchor_fallback(topk, info, span, params.catalog_top_k),
        ct.category_fallback(recent, info, span, params.catalog_top_k),
        ct.global_fallback(recent, info, span, params.catalog_top_k),
        ct.catalog_coverage(scored, known, params.catalog_top_k))


def generate_predictions(spark: SparkSession, *, orders_path: str, products_path: str, commerces_path: str,
                         model_path: str, out_folder: str, params: ScoringParams = ScoringParams()) -> CatalogTables:
    """The scoring plan from files to four written tables."""
    with scratch(spark):
        tables = build_catalog(
            spark.read.parquet(orders_path), read_products(spark, products_path, filter_blocked=False),
            read_commerces(spark, commerces_path), Ranker.load(spark, model_path), params)
        tables.write(out_folder)
        written = [spark.read.parquet(f"{out_folder}/{name}") for name in CatalogTables.WRITTEN]
        return CatalogTables(*written, collected(tables.coverage))
