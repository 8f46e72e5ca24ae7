"""Headline queries, timed end to end from the parquet tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from dataclasses import replace

from basketloom.checks.model_queries import trained
from basketloom.checks.registry import BUILDERS
from basketloom.checks.stages import Stages
from basketloom.operators.baskets import build_baskets
from basketloom.operators.candidates import generate_candidates, select_top_k_candidates
from basketloom.operators.features import build_feature_table
from basketloom.plans.scoring import ScoringParams, build_catalog
from basketloom.session import local_session

# Every anchor keeps its candidates at a lift of 1, which gives the feature steps real load.
MIN_LIFT = 1.0
TREES = 869
WHOLE = ScoringParams(last_n_days=0, min_cooc=2, min_lift=MIN_LIFT, top_k_candidates=100, catalog_top_k=20)
HEADLINES = [
    "preprocess_orders", "build_baskets", "generate_candidates", "select_top_k_candidates", "add_all_features",
    "label_pairs_window", "build_labeled_split", "metrics_table", "predictions_catalog", "anchor_fallback",
    "category_fallback", "recommend_requests", "recommend_with_fallback", "baseline_overlap", "new_vs_repeat_totals",
    "train_ranker", "model_catalog",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "16g")

    def run(name: str) -> float:
        begin = time.perf_counter()
        BUILDERS[name](Stages(spark, folder, MIN_LIFT)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    run("preprocess_orders")    # starts the workers; not counted
    seconds = {name: round(run(name), 3) for name in HEADLINES}

    # The whole scoring job over the whole history: orders to catalog, every candidate row scored. The trained trees
    # are repeated up to TREES, as a model of that size costs.
    stages = Stages(spark, folder, MIN_LIFT)
    model = trained(stages)[1].ranker
    rounds = max(row[0] for row in model.curve)
    copies = -(-TREES // model.best_iteration)
    model = replace(model, nodes=[(row[0] + i * model.best_iteration, *row[1:]) for i in range(copies) for row in model.nodes])
    begin = time.perf_counter()
    tables = build_catalog(stages.clean, stages.all_products, stages.commerces, model, WHOLE)
    tables.predictions.write.format("noop").mode("overwrite").save()
    seconds["whole_history_catalog"] = round(time.perf_counter() - begin, 3)

    baskets = build_baskets(stages.orders)
    topk = select_top_k_candidates(generate_candidates(baskets, WHOLE.min_cooc), WHOLE.top_k_candidates, WHOLE.min_lift)
    rows = build_feature_table(baskets, topk).count()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")), "whole_history_feature_rows": rows,
        "trees_scored": copies * model.best_iteration, "boosting_rounds": rounds,
        "seconds_per_boosting_round_with_splits": round(seconds["train_ranker"] / rounds, 3), "model_nodes": len(model.nodes),
        "feature_rows_per_sec": round(rows / seconds["whole_history_catalog"])}))


if __name__ == "__main__":
    main()
