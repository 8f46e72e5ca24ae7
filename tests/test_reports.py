import pytest

from basketloom.operators import novelty as nv
from basketloom.operators import personalization as pz
from tests.conftest import rows_of

SCHEMA = ("kiosk_id string, anchor_product_id string, candidate_product_id string, score double, "
          "cand_is_new tinyint, pop_store bigint")


@pytest.fixture
def scored(spark):
    rows = [("k1", "a", "x", 0.9, 0, 4), ("k1", "a", "y", 0.8, 1, 0), ("k1", "a", "z", 0.1, 1, 0),
            ("k2", "a", "x", 0.9, 0, 2), ("k2", "a", "z", 0.8, 0, 6), ("k3", "a", "x", 0.9, 1, 0),
            ("k3", "a", "y", 0.8, 1, 0), ("k1", "b", "x", 0.5, 1, 0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_personalization(scored, spark):
    top = pz.top_k_per_query(scored, 2)
    assert pz.personalization_totals(top).first().asDict() == {"n_kiosks": 3, "n_queries": 4, "n_products": 3}
    diversity = pz.anchor_list_diversity(top, 2)
    assert rows_of(diversity) == [("a", 3, 2, pytest.approx(200 / 3)), ("b", 1, 1, 100.0)]
    assert [r["anchor_product_id"] for r in pz.top_anchors(diversity, 1).collect()] == ["a"]
    assert pz.anchor_diversity_summary(diversity).first()["median_pct"] == pytest.approx((200 / 3 + 100) / 2)
    assert rows_of(pz.global_baseline_topk(top, 2)) == [("a", "x"), ("a", "y"), ("b", "x")]
    overlap = pz.baseline_overlap(top, 2).first()
    assert overlap["mean_overlap"] == pytest.approx((100 + 50 + 100 + 100) / 4)
    assert overlap["p25"] == pytest.approx(87.5)
    jaccard = pz.pairwise_jaccard(top, 2).first()
    assert jaccard["n_pairs"] == 3 and jaccard["mean_jaccard"] == pytest.approx((1 / 3 + 1 + 1 / 3) / 3)
    assert pz.sampled_jaccard(top, 2).first()["mean_jaccard"] == pytest.approx(jaccard["mean_jaccard"])
    assert pz.sampled_jaccard(top, 2, max_pairs=2).first()["n_pairs"] == 2
    assert ("k1", "x", 2) in rows_of(pz.kiosk_rec_sets(top))
    names = spark.createDataFrame([("x", "X", "c")], "productid string, name string, category string")
    examples = pz.example_recs(top, names, 2, n_kiosks=2)
    assert examples.select("kiosk_id").distinct().count() == 2
    assert {r["candidate_name"] for r in examples.filter("rank = 1").collect()} == {"X"}


def test_query_lists_are_cut_by_score_and_sorted_by_product(scored):
    lists = pz._query_lists(scored, 2)
    assert rows_of(lists) == [("k1", "a", ["x", "y"]), ("k1", "b", ["x"]), ("k2", "a", ["x", "z"]), ("k3", "a", ["x", "y"])]
    assert "ObjectHashAggregate" not in lists._jdf.queryExecution().executedPlan().toString()


def test_novelty(scored, spark):
    totals = nv.new_vs_repeat_totals(scored, 2).first()
    assert (totals["total"], totals["n_new"], totals["n_repeat"]) == (7, 4, 3)
    assert nv.new_vs_repeat_pool(scored).first()["new_pct"] == pytest.approx(100 * 5 / 8)
    assert rows_of(nv.new_share_by_position(scored, 5)) == [
        (1, 4, 50.0), (2, 3, pytest.approx(200 / 3)), (3, 1, 100.0)]
    pop = nv.avg_pop_store(scored, 2).first()
    assert (pop["avg_all"], pop["avg_top"], pop["avg_top_repeat"]) == (1.5, pytest.approx(12 / 7), 4.0)
    assert rows_of(nv.mixed_queries(scored, 2)) == [("k1", "a", 1, 2)]
    names = spark.createDataFrame([("x", "X", "c"), ("a", "A", "c")], "productid string, name string, category string")
    shown = nv.mixed_query_examples(scored, names, 2).orderBy("rank").collect()
    assert [(r["anchor_name"], r["tag"], r["candidate_name"]) for r in shown] == [("A", "", "X"), ("A", "NEW", None)]
