"""DuckDB SQL with the meaning of each registered query, over whole tables."""

from __future__ import annotations

import re

# Named building blocks, each using only names above it.
STEPS: dict[str, str] = {
    "raw": """
        SELECT CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'order' END AS documenttype,
               CAST(o_orderkey AS VARCHAR) AS orderid, CAST(o_custkey AS VARCHAR) AS userid,
               p_brand || '-' || p_type AS productid, o_orderdate AS orderdt, l_quantity AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "all_products": """
        SELECT p_brand || '-' || p_type AS productid, min(p_name) AS name, min(p_type) AS category,
               min(p_brand) = 'Brand#13' AS blocked
        FROM part GROUP BY 1""",
    "products": "SELECT * FROM all_products WHERE NOT blocked",
    "commerces": """
        SELECT CAST(c_custkey AS VARCHAR) AS userid, c_mktsegment AS channel, r_name AS region,
               c_acctbal >= 0 AS active
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "clean": """
        SELECT orderid AS order_id, userid AS kiosk_id, productid AS product_id, orderdt AS order_dt, quantity
        FROM raw WHERE documenttype = 'order' AND quantity > 0""",
    "active_stores": "SELECT * FROM commerces WHERE active",
    "active_orders": "SELECT * FROM clean WHERE kiosk_id IN (SELECT userid FROM active_stores)",
    "history": """
        SELECT * FROM active_orders
        WHERE product_id NOT IN (SELECT productid FROM all_products WHERE blocked)""",
    "recent": """
        SELECT * FROM history
        WHERE order_dt >= (SELECT max(order_dt) FROM history) - INTERVAL 90 DAY""",
    "span": "SELECT min(order_dt) AS low, epoch(max(order_dt)) - epoch(min(order_dt)) AS secs FROM history",
    "cuts": """
        SELECT low + to_seconds(CAST(floor(secs * CAST(0.8 AS DOUBLE)) AS BIGINT)) AS cut1,
               low + to_seconds(CAST(floor(secs * (CAST(0.8 AS DOUBLE) + CAST(0.1 AS DOUBLE))) AS BIGINT)) AS cut2
        FROM span""",
    "parts": """
        SELECT history.*, CASE WHEN order_dt < cut1 THEN 'train' WHEN order_dt < cut2 THEN 'val'
                               ELSE 'test' END AS split
        FROM history, cuts""",
    "train": "SELECT * EXCLUDE (split) FROM parts WHERE split = 'train'",
    "test": "SELECT * EXCLUDE (split) FROM parts WHERE split = 'test'",
    "train_sets": """
        SELECT kiosk_id, order_id, count(DISTINCT product_id) AS n,
               string_agg(DISTINCT product_id, ',' ORDER BY product_id) AS products
        FROM train GROUP BY ALL""",
    "baskets": "SELECT * FROM train_sets WHERE n BETWEEN 2 AND 200",
    "items": """
        SELECT DISTINCT train.order_id, train.kiosk_id, train.product_id
        FROM train JOIN baskets USING (kiosk_id, order_id)""",
    "product_counts": "SELECT product_id, count(*) AS product_count FROM items GROUP BY ALL",
    "cooc": """
        SELECT a.product_id AS anchor_product_id, c.product_id AS candidate_product_id, count(*) AS cooc_count
        FROM items a JOIN items c ON a.order_id = c.order_id AND a.product_id <> c.product_id
        WHERE a.product_id IN (SELECT product_id FROM product_counts WHERE product_count >= 2)
          AND c.product_id IN (SELECT product_id FROM product_counts WHERE product_count >= 2)
        GROUP BY ALL HAVING count(*) >= 2""",
    "total": "SELECT CAST(count(*) AS DOUBLE) AS n FROM baskets",
    "cands": """
        SELECT anchor_product_id, candidate_product_id, cooc_count, a.product_count AS anchor_count,
               c.product_count AS candidate_count, cooc_count / n AS support,
               CAST(cooc_count AS DOUBLE) / a.product_count AS confidence,
               (cooc_count / n) / ((a.product_count / n) * (c.product_count / n)) AS lift,
               cooc_count / sqrt(CAST(a.product_count * c.product_count AS DOUBLE)) AS cooc_cosine_sim
        FROM cooc JOIN product_counts a ON a.product_id = anchor_product_id
        JOIN product_counts c ON c.product_id = candidate_product_id, total""",
    "topk": """
        SELECT anchor_product_id, candidate_product_id, cooc_cosine_sim FROM cands WHERE lift >= 1.2
        QUALIFY row_number() OVER (PARTITION BY anchor_product_id
                                   ORDER BY lift DESC, cooc_count DESC, candidate_product_id) <= 100""",
    "test_lines": """
        SELECT DISTINCT kiosk_id, order_id, product_id FROM test""",
    "test_sets": "SELECT kiosk_id, order_id, count(*) AS n FROM test_lines GROUP BY ALL",
    "wanted": """
        SELECT DISTINCT kiosk_id, product_id AS anchor_product_id
        FROM test_lines JOIN test_sets USING (kiosk_id, order_id) WHERE n BETWEEN 2 AND 200""",
    "cells": """
        SELECT kiosk_id, anchor_product_id, candidate_product_id, cooc_cosine_sim
        FROM wanted JOIN topk USING (anchor_product_id)""",
    "store_pop": "SELECT kiosk_id, product_id, count(*) AS pop_store FROM train GROUP BY ALL",
    "global_pop": "SELECT product_id, count(*) AS pop_global FROM train GROUP BY ALL",
    "volume": "SELECT kiosk_id, count(*) AS kiosk_product_cnt FROM train GROUP BY ALL",
    "popular": """
        SELECT cells.*, coalesce(pop_store, 0) AS pop_store
        FROM cells LEFT JOIN store_pop
        ON store_pop.kiosk_id = cells.kiosk_id AND store_pop.product_id = candidate_product_id""",
    "features": """
        SELECT p.*, coalesce(pop_global, 0) AS pop_global, coalesce(kiosk_product_cnt, 0) AS kiosk_product_cnt,
               CAST(p.pop_store = 0 AS INTEGER) AS cand_is_new,
               CAST(pa.category = pc.category AS INTEGER) AS same_category, channel, region
        FROM popular p LEFT JOIN global_pop g ON g.product_id = candidate_product_id
        LEFT JOIN volume v ON v.kiosk_id = p.kiosk_id
        LEFT JOIN products pa ON pa.productid = anchor_product_id
        LEFT JOIN products pc ON pc.productid = candidate_product_id
        LEFT JOIN active_stores s ON s.userid = p.kiosk_id""",
    "gaps": """
        SELECT * REPLACE (CASE WHEN channel <> 'BUILDING' THEN channel END AS channel) FROM features""",
    "pairs": """
        SELECT a.kiosk_id, a.product_id AS anchor_product_id, c.product_id AS candidate_product_id,
               count(*) AS cooc_count
        FROM test a JOIN test c ON a.kiosk_id = c.kiosk_id AND a.product_id <> c.product_id
         AND c.order_dt >= a.order_dt AND c.order_dt <= a.order_dt + INTERVAL 7 DAY
        GROUP BY ALL""",
    "labeled": """
        SELECT cells.*, CASE WHEN cooc_count IS NULL THEN 0 ELSE 1 END AS label
        FROM cells LEFT JOIN pairs USING (kiosk_id, anchor_product_id, candidate_product_id)""",
    "good": """
        SELECT * FROM labeled
        QUALIFY count(*) OVER (PARTITION BY kiosk_id, anchor_product_id) > 1
            AND sum(label) OVER (PARTITION BY kiosk_id, anchor_product_id) > 0""",
    "scored": """
        SELECT popular.*, CAST(pop_store = 0 AS INTEGER) AS cand_is_new,
               round(cooc_cosine_sim + CAST(0.01 AS DOUBLE) * pop_store, 9) AS score
        FROM popular""",
    "judged": """
        SELECT kiosk_id, anchor_product_id, candidate_product_id, score,
               CASE WHEN cooc_count IS NULL THEN 0 ELSE 1 END AS label
        FROM scored LEFT JOIN pairs USING (kiosk_id, anchor_product_id, candidate_product_id)""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY kiosk_id, anchor_product_id
                                     ORDER BY score DESC, candidate_product_id) AS rank,
               sum(label) OVER (PARTITION BY kiosk_id, anchor_product_id) AS n_pos
        FROM judged""",
    "valid": "SELECT * FROM ranked WHERE n_pos > 0",
    "ks": "SELECT unnest([5, 10, 20, 50]) AS k",
    "ideal": """
        SELECT k, n, (SELECT sum(1.0 / log2(CAST(j + 1 AS DOUBLE))) FROM range(1, n + 1) t(j)) AS idcg
        FROM ks, range(1, 51) r(n) WHERE n <= k""",
    "per_query": """
        SELECT v.kiosk_id, v.anchor_product_id, v.k, any_value(n_pos) AS n_pos,
               count(*) FILTER (rank <= v.k AND label = 1) AS hits,
               coalesce(sum(1.0 / log2(CAST(rank + 1 AS DOUBLE))) FILTER (rank <= v.k AND label = 1), 0) AS dcg,
               min(rank) FILTER (rank <= v.k AND label = 1) AS first
        FROM (SELECT * FROM valid, ks) v GROUP BY ALL""",
    "metrics": """
        SELECT q.k, avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END) AS "HitRate",
               avg(CAST(hits AS DOUBLE) / n_pos) AS "Recall", avg(dcg / idcg) AS "NDCG",
               avg(CASE WHEN first IS NULL THEN 0.0 ELSE 1.0 / first END) AS "MRR",
               avg(CAST(hits AS DOUBLE) / q.k) AS "Precision", avg(CAST(hits AS DOUBLE)) AS "Positives"
        FROM per_query q JOIN ideal i ON i.k = q.k AND i.n = least(n_pos, q.k) GROUP BY q.k""",
    "catalog": """
        SELECT r.kiosk_id, r.anchor_product_id, pa.name AS anchor_name, r.candidate_product_id,
               pc.name AS candidate_name, pc.category, r.score
        FROM (SELECT * FROM scored
              QUALIFY row_number() OVER (PARTITION BY kiosk_id, anchor_product_id
                                         ORDER BY score DESC, candidate_product_id) <= 20) r
        LEFT JOIN products pa ON pa.productid = r.anchor_product_id
        LEFT JOIN products pc ON pc.productid = r.candidate_product_id""",
    "lookup": """
        SELECT anchor_product_id AS anchor_id, kiosk_id,
               string_agg(candidate_product_id, ',' ORDER BY score DESC, candidate_product_id) AS recs
        FROM catalog GROUP BY ALL""",
    "catalog_at": """
        SELECT anchor_product_id AS anchor_id, kiosk_id, candidate_product_id AS product_id,
               row_number() OVER (PARTITION BY anchor_product_id, kiosk_id
                                  ORDER BY score DESC, candidate_product_id) AS position
        FROM catalog""",
    "other_catalog": """
        SELECT kiosk_id, anchor_product_id, candidate_product_id, round(cooc_cosine_sim, 9) AS score FROM popular
        QUALIFY row_number() OVER (PARTITION BY kiosk_id, anchor_product_id
                                   ORDER BY round(cooc_cosine_sim, 9) DESC, candidate_product_id) <= 20""",
    "ranks_of_two": """
        SELECT kiosk_id, anchor_product_id, candidate_product_id, old_rank, new_rank,
               CASE WHEN old_rank IS NULL THEN 'entered' WHEN new_rank IS NULL THEN 'left' WHEN old_rank > new_rank THEN 'up'
                    WHEN old_rank < new_rank THEN 'down' ELSE 'same' END AS change, old_rank - new_rank AS moved_up
        FROM (SELECT kiosk_id, anchor_product_id, candidate_product_id, row_number() OVER (
                  PARTITION BY kiosk_id, anchor_product_id ORDER BY score DESC, candidate_product_id) AS old_rank FROM catalog)
        FULL JOIN (SELECT kiosk_id, anchor_product_id, candidate_product_id, row_number() OVER (
                  PARTITION BY kiosk_id, anchor_product_id ORDER BY score DESC, candidate_product_id) AS new_rank FROM other_catalog)
        USING (kiosk_id, anchor_product_id, candidate_product_id)""",
    "bought": """
        SELECT kiosk_id, product_id, CAST(order_dt AS DATE) AS day, count(*) AS lines, sum(quantity) AS quantity FROM history GROUP BY ALL""",
    "gapped": """
        SELECT *, CAST(day - lag(day) OVER (PARTITION BY kiosk_id, product_id ORDER BY day) AS INTEGER) AS gap_days,
               CAST(lead(day) OVER (PARTITION BY kiosk_id, product_id ORDER BY day) - day AS INTEGER) AS next_gap_days,
               CAST(sum(lines) OVER (PARTITION BY kiosk_id, product_id ORDER BY day
                                     RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS recent_lines
        FROM bought""",
    "zoned": """
        SELECT history.*, CASE region WHEN 'AFRICA' THEN 'Africa/Lagos' WHEN 'AMERICA' THEN 'America/New_York' WHEN 'ASIA' THEN 'Asia/Tokyo'
                                      WHEN 'EUROPE' THEN 'Europe/Berlin' ELSE 'UTC' END AS zone
        FROM history LEFT JOIN commerces ON userid = kiosk_id""",
    "local_lines": """
        SELECT *, CAST(timezone(zone, timezone('UTC', CAST(order_dt AS TIMESTAMP))) AS DATE) AS day FROM zoned""",
    "requests": """
        SELECT DISTINCT product_id AS anchor_id, kiosk_id,
               CASE WHEN kiosk_id LIKE '%7' THEN 3 ELSE 20 END AS "limit"
        FROM history""",
    "anchor_best": """
        SELECT * FROM topk
        QUALIFY row_number() OVER (PARTITION BY anchor_product_id
                                   ORDER BY cooc_cosine_sim DESC, candidate_product_id) <= 20""",
    "sold": "SELECT product_id, count(*) AS times, ln(1 + count(*)) AS pop FROM history GROUP BY ALL",
    "category_best": """
        SELECT category, product_id, name, pop FROM sold JOIN products ON productid = product_id
        WHERE category IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY category ORDER BY times DESC, product_id) <= 20""",
    "global_best": """
        SELECT product_id, pop, name, category FROM (SELECT * FROM sold ORDER BY times DESC, product_id LIMIT 20)
        LEFT JOIN products ON productid = product_id""",
    "top": """
        SELECT * FROM scored
        QUALIFY row_number() OVER (PARTITION BY kiosk_id, anchor_product_id
                                   ORDER BY score DESC, candidate_product_id) <= 5""",
    "top_at": """
        SELECT *, row_number() OVER (PARTITION BY kiosk_id, anchor_product_id
                                     ORDER BY score DESC, candidate_product_id) AS rank
        FROM top""",
    "lists": """
        SELECT kiosk_id, anchor_product_id, list(candidate_product_id ORDER BY candidate_product_id) AS recs
        FROM top GROUP BY ALL""",
    "diversity": """
        SELECT anchor_product_id, count(DISTINCT kiosk_id) AS n_kiosks,
               count(DISTINCT array_to_string(recs, ',')) AS n_unique_lists
        FROM lists GROUP BY ALL""",
    "baseline": """
        SELECT anchor_product_id, candidate_product_id
        FROM (SELECT anchor_product_id, candidate_product_id, round(avg(score), 9) AS s FROM top GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY anchor_product_id ORDER BY s DESC, candidate_product_id) <= 5""",
    "overlap": """
        SELECT t.kiosk_id, t.anchor_product_id,
               CAST(count(b.candidate_product_id) AS DOUBLE) / count(*) * 100 AS pct
        FROM top t LEFT JOIN baseline b USING (anchor_product_id, candidate_product_id) GROUP BY ALL""",
    "favourite": """
        SELECT anchor_product_id FROM diversity ORDER BY n_kiosks DESC, anchor_product_id LIMIT 1""",
    "mixed": """
        SELECT kiosk_id, anchor_product_id, CAST(sum(cand_is_new) AS BIGINT) AS n_new, count(*) AS n_total
        FROM top GROUP BY ALL HAVING sum(cand_is_new) > 0 AND sum(cand_is_new) < count(*)""",
}


def with_steps(query: str) -> str:
    """``query`` preceded by the steps it needs, directly or through other steps."""
    needed: set[str] = set()
    waiting = [query]
    while waiting:
        text = waiting.pop()
        for name, body in STEPS.items():
            if name not in needed and re.search(rf"(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                waiting.append(body)
    if not needed:
        return query
    parts = [f"{name} AS MATERIALIZED ({body})" for name, body in STEPS.items() if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + query


def _scaled(value: str, table: str, low: str = "-8.0", high: str = "4.0") -> str:
    """Min-max scaling as SQL over the whole of ``table``."""
    lo, hi = f"(SELECT min({value}) FROM {table})", f"(SELECT max({value}) FROM {table})"
    return (f"CASE WHEN {hi} = {lo} THEN CAST({low} AS DOUBLE) ELSE ({value} - {lo}) / ({hi} - {lo})"
            f" * (CAST({high} AS DOUBLE) - CAST({low} AS DOUBLE)) + CAST({low} AS DOUBLE) END")


def _draw(seed: int, *names: str) -> str:
    return f"md5('{seed}|' || " + " || '|' || ".join(names) + ")"


def _counts(table: str) -> str:
    return f"""
        SELECT count(*) AS total, count(*) FILTER (cand_is_new = 1) AS n_new,
               count(*) FILTER (cand_is_new = 0) AS n_repeat,
               round(100.0 * count(*) FILTER (cand_is_new = 1) / count(*), 6) AS new_pct,
               round(100.0 * count(*) FILTER (cand_is_new = 0) / count(*), 6) AS repeat_pct
        FROM {table}"""


def _code(expr: str) -> str:
    return f"CAST(('0x' || substr(md5({expr}), 1, 13)) AS BIGINT)::DOUBLE"


def _label_summary(table: str) -> str:
    return f"""count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg,
               round(100.0 * sum(label) / count(*), 6) AS pos_pct,
               count(DISTINCT kiosk_id || '::' || anchor_product_id) AS queries,
               round(count(*) / count(DISTINCT kiosk_id || '::' || anchor_product_id), 6) AS avg_group
        FROM {table}"""


def _long_metrics() -> str:
    names = ["HitRate", "Recall", "NDCG", "MRR", "Precision", "Positives"]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS metric, CAST(k AS INTEGER) AS k, round("{name}", 6) AS value FROM metrics"""
        for name in names)


def _one_metric(name: str, out: str) -> str:
    return f'SELECT round("{name}", 6) AS {out} FROM metrics WHERE k = 20'


ROW = "kiosk_id, anchor_product_id, candidate_product_id"
FEATURE_LIST = f"""{ROW}, round(cooc_cosine_sim, 9) AS cooc_cosine_sim, pop_store, pop_global, kiosk_product_cnt,
                   cand_is_new"""
ORDER_RANK = f"row_number() OVER (ORDER BY order_dt, {_draw(0, 'order_id', 'product_id')}, quantity)"

# The two trees of the fixed model.
FIXED_SCORE = """(CASE WHEN cooc_cosine_sim <= 0.05 THEN -1.0 WHEN pop_store <= 2 THEN 0.25 ELSE 1.5 END
            + CASE WHEN cand_is_new <= 0 THEN 0.5 WHEN cooc_cosine_sim <= 0.1 THEN -0.125 ELSE 2.0 END)::DOUBLE"""
# Its lists, for the reports made from files.
STEPS["fixed_top"] = f"""
        SELECT * EXCLUDE (score), row_number() OVER (PARTITION BY kiosk_id, anchor_product_id
                                                     ORDER BY {FIXED_SCORE} DESC, candidate_product_id) AS rank
        FROM scored QUALIFY rank <= 5"""


def _yearly(way: str) -> str:
    """The same number of first (or last) lines of each year's file."""
    columns = ["orderdt", "orderid", "productid", "quantity", "documenttype", "userid"]
    return f"""
        SELECT * EXCLUDE (place, years) FROM (
            SELECT *, row_number() OVER (PARTITION BY substr(orderdt, 1, 4) ORDER BY {", ".join(f"{c} {way}" for c in columns)}) AS place,
                   (SELECT count(DISTINCT year(orderdt)) FROM raw) AS years
            FROM (SELECT * REPLACE (CAST(orderdt AS VARCHAR) AS orderdt) FROM raw))
        WHERE place <= greatest(1, 1000 // years)"""


QUERIES: dict[str, str] = {
    "first_orders": f"""
        SELECT * FROM raw QUALIFY row_number() OVER (
            ORDER BY orderdt, {_draw(0, 'orderid', 'productid')}, orderid, productid, quantity) <= 1000""",
    "last_orders": f"""
        SELECT * FROM raw QUALIFY row_number() OVER (
            ORDER BY orderdt DESC, {_draw(0, 'orderid', 'productid')} DESC, orderid DESC, productid DESC,
                     quantity DESC) <= 1000""",
    "read_orders_csv": "SELECT * REPLACE (CAST(orderdt AS VARCHAR) AS orderdt) FROM raw",
    "ingest_orders_incremental": "SELECT * FROM clean",
    "write_parquet": "SELECT * FROM clean",
    "read_orders_parquet": "SELECT * FROM orders",
    "sample_orders_head": _yearly(""),
    "sample_orders_tail": _yearly("DESC"),
    "read_products": "SELECT * FROM products",
    "read_commerces": "SELECT * FROM commerces",
    "star_products": "SELECT * FROM products",
    "star_commerces": "SELECT * FROM commerces",
    "preprocess_orders": "SELECT * FROM clean",
    "assert_not_null": """
        SELECT count(*) - count(order_id) AS order_id, count(*) FILTER (quantity = 11) AS kiosk_id,
               count(*) FILTER (quantity = 7) AS product_id, count(*) FILTER (ends_with(kiosk_id, '3')) AS order_dt
        FROM clean""",
    "null_ratios": """
        SELECT round(count(*) FILTER (ends_with(kiosk_id, '3')) / CAST(count(*) AS DOUBLE), 6) AS order_dt,
               round(count(*) FILTER (NOT quantity < 25) / CAST(count(*) AS DOUBLE), 6) AS quantity FROM clean""",
    "filter_active_kiosks": "SELECT * FROM active_orders",
    "blocked_product_ids": "SELECT productid AS product_id FROM all_products WHERE blocked",
    "filter_blocked_products": "SELECT * FROM history",
    "inference_window": "SELECT * FROM recent",
    "orders_profile": """
        SELECT split, count(*) AS n_rows, count(DISTINCT kiosk_id) AS n_kiosks, min(order_dt) AS min_dt,
               max(order_dt) AS max_dt
        FROM (SELECT * FROM parts UNION ALL SELECT *, 'all' AS split FROM history) GROUP BY split""",
    "orders_profile_sketched": """
        SELECT split, count(*) AS n_rows, min(order_dt) AS min_dt, max(order_dt) AS max_dt, count(DISTINCT kiosk_id) AS n_kiosks,
               true AS kiosks_ok, count(DISTINCT product_id) AS n_products, true AS products_ok FROM parts GROUP BY split""",
    "basket_sizes_sketched": """
        SELECT CAST(year AS INTEGER) AS year, count(*) AS n_baskets, round(avg(n), 6) AS mean_size, true AS median_size_ok,
               true AS p95_size_ok, true AS p99_size_ok
        FROM (SELECT kiosk_id, order_id, any_value(year(order_dt)) AS year, count(DISTINCT product_id) AS n FROM history GROUP BY ALL)
        GROUP BY ALL""",
    "catalog_changes": """
        SELECT * REPLACE (coalesce(old_rank, -1000000) AS old_rank, coalesce(new_rank, -1000000) AS new_rank,
                          coalesce(moved_up, -1000000) AS moved_up) FROM ranks_of_two""",
    "catalog_change_summary": """
        SELECT kiosk_id, anchor_product_id, count(*) FILTER (change = 'entered') AS n_entered, count(*) FILTER (change = 'left') AS n_left,
               count(*) FILTER (change IN ('up', 'down')) AS n_moved, count(*) FILTER (change = 'same') AS n_same,
               CAST(coalesce(sum(abs(moved_up)), 0) AS BIGINT) AS places_moved
        FROM ranks_of_two GROUP BY ALL""",
    "catalog_rows_in_one": """
        SELECT kiosk_id, anchor_product_id, candidate_product_id, CASE change WHEN 'left' THEN 'before' ELSE 'after' END AS catalog
        FROM ranks_of_two WHERE change IN ('left', 'entered')""",
    "repurchase_gaps": """
        SELECT * REPLACE (CAST(day AS VARCHAR) AS day, coalesce(gap_days, -1000000) AS gap_days,
                          coalesce(next_gap_days, -1000000) AS next_gap_days) FROM gapped""",
    "repurchase_summary": """
        SELECT kiosk_id, product_id, count(*) AS n_days, coalesce(min(gap_days), -1000000) AS min_gap,
               coalesce(round(avg(gap_days), 6), -1000000) AS mean_gap, coalesce(max(gap_days), -1000000) AS max_gap,
               CAST(max(day) AS VARCHAR) AS last_day FROM gapped GROUP BY ALL""",
    "local_daily_totals": """
        SELECT kiosk_id, zone, CAST(day AS VARCHAR) AS day, count(*) AS lines, sum(quantity) AS quantity,
               CAST((epoch(timezone(zone, CAST(day + 1 AS TIMESTAMP))) - epoch(timezone(zone, CAST(day AS TIMESTAMP)))) / 3600 AS DOUBLE) AS hours
        FROM local_lines GROUP BY local_lines.kiosk_id, local_lines.zone, local_lines.day""",
    "inference_window_local": """
        SELECT * EXCLUDE (day) FROM local_lines
        WHERE day > (SELECT CAST(timezone(zone, timezone('UTC', CAST(max(order_dt) AS TIMESTAMP))) AS DATE) - 90 FROM history)""",
    "split_by_local_day": """
        SELECT * EXCLUDE (day), CASE WHEN day < DATE '1997-03-30' THEN 'train' WHEN day < DATE '1998-01-01' THEN 'val' ELSE 'test' END AS split
        FROM local_lines""",
    "split_orders_by_time": "SELECT * FROM parts",
    "split_orders_by_rows": f"""
        SELECT * EXCLUDE (rn, n), CASE WHEN rn <= CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'train'
            WHEN rn <= CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT)
                       + CAST(floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT *, {ORDER_RANK} AS rn, count(*) OVER () AS n FROM history)""",
    "split_orders_by_rows_radix": f"""
        SELECT * EXCLUDE (rn, n), CASE WHEN rn <= CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'train'
            WHEN rn <= CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT)
                       + CAST(floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT *, {ORDER_RANK.replace("order_dt,", "order_dt NULLS FIRST,")} AS rn, count(*) OVER () AS n
              FROM (SELECT * REPLACE (CASE WHEN NOT ends_with(kiosk_id, '3') THEN order_dt END AS order_dt) FROM history))""",
    "split_feature_label": """
        SELECT train.*, CASE WHEN order_dt < start THEN 'feature' ELSE 'label' END AS part
        FROM train, (SELECT order_dt AS start
            FROM (SELECT order_dt, row_number() OVER (ORDER BY order_dt) - 1 AS place, count(*) OVER () AS n
                  FROM (SELECT DISTINCT order_dt FROM train))
            WHERE place = least(greatest(1, CAST(floor(n * (CAST(1 AS DOUBLE) - CAST(0.3 AS DOUBLE))) AS BIGINT)), n - 1))""",
    "build_baskets": "SELECT kiosk_id, order_id, products FROM baskets",
    "basket_size_stats": """
        SELECT min(n) AS min_size, round(avg(n), 6) AS mean_size, round(quantile_cont(n, 0.5), 6) AS median_size,
               round(quantile_cont(n, 0.95), 6) AS p95_size, round(quantile_cont(n, 0.99), 6) AS p99_size,
               max(n) AS max_size FROM baskets""",
    "basket_filter_counts": """
        SELECT count(*) AS total_before, count(*) FILTER (n < 2) AS too_small, count(*) FILTER (n > 5) AS too_large,
               count(*) FILTER (n BETWEEN 2 AND 5) AS kept FROM train_sets""",
    "explode_baskets": "SELECT order_id, product_id FROM items",
    "product_basket_counts": "SELECT * FROM product_counts",
    "frequent_products": """
        SELECT order_id, product_id FROM items
        WHERE product_id IN (SELECT product_id FROM product_counts WHERE product_count >= 40)""",
    "pair_cooccurrence": "SELECT * FROM cooc",
    "pair_cooccurrence_shared": """
        SELECT a.product_id AS anchor_product_id, c.product_id AS candidate_product_id, count(*) AS cooc_count
        FROM items a JOIN items c ON CAST(a.order_id AS BIGINT) // 10 = CAST(c.order_id AS BIGINT) // 10
         AND a.product_id <> c.product_id GROUP BY ALL HAVING count(*) >= 2""",
    "generate_candidates": """
        SELECT * REPLACE (round(support, 9) AS support, round(confidence, 9) AS confidence, round(lift, 9) AS lift,
                          round(cooc_cosine_sim, 9) AS cooc_cosine_sim) FROM cands""",
    "select_top_k_candidates": "SELECT * REPLACE (round(cooc_cosine_sim, 9) AS cooc_cosine_sim) FROM topk",
    "topk_candidate_stats": """
        SELECT count(*) AS n_anchors, min(n) AS min_cands, round(avg(n), 6) AS mean_cands,
               round(median(n), 6) AS median_cands, max(n) AS max_cands, count(*) FILTER (n >= 30) AS n_full,
               round(100.0 * count(*) FILTER (n >= 30) / count(*), 6) AS pct_full
        FROM (SELECT count(*) AS n FROM topk GROUP BY anchor_product_id)""",
    "kiosk_anchor_queries": "SELECT * FROM wanted",
    "add_query_id": "SELECT *, kiosk_id || '::' || anchor_product_id AS query_id FROM wanted",
    "sample_queries": f"""
        SELECT * FROM wanted ORDER BY {_draw(42, 'kiosk_id', 'anchor_product_id')}, kiosk_id, anchor_product_id
        LIMIT 500""",
    "sample_kiosks": f"""
        SELECT * FROM wanted WHERE kiosk_id IN (
            SELECT kiosk_id FROM (SELECT DISTINCT kiosk_id FROM wanted)
            ORDER BY {_draw(42, 'kiosk_id')}, kiosk_id LIMIT 100)""",
    "build_feature_table": "SELECT * REPLACE (round(cooc_cosine_sim, 9) AS cooc_cosine_sim) FROM cells",
    "build_feature_table_by_kiosk": """
        SELECT cells.* REPLACE (round(cooc_cosine_sim, 9) AS cooc_cosine_sim)
        FROM cells JOIN store_pop ON store_pop.kiosk_id = cells.kiosk_id AND product_id = candidate_product_id""",
    "feat_pop_store": "SELECT * REPLACE (round(cooc_cosine_sim, 9) AS cooc_cosine_sim) FROM popular",
    "feat_pop_global": f"SELECT {ROW}, pop_global FROM features",
    "feat_kiosk_product_cnt": f"SELECT {ROW}, kiosk_product_cnt FROM features",
    "feat_cand_is_new": f"SELECT {ROW}, pop_store, cand_is_new FROM features",
    "feat_same_category": f"SELECT {ROW}, same_category FROM features",
    "feat_kiosk_meta": f"SELECT {ROW}, channel, region FROM features",
    "add_all_features": f"SELECT {FEATURE_LIST}, same_category, channel, region FROM features",
    "feature_rows": f"SELECT {FEATURE_LIST}, same_category, channel, region FROM features",
    "fill_missing_features": f"""
        SELECT {FEATURE_LIST}, coalesce(same_category, 0) AS same_category,
               coalesce(channel, '__MISSING__') AS channel, coalesce(region, '__MISSING__') AS region FROM gaps""",
    "ensure_feature_columns": f"""
        SELECT {ROW}, round(cooc_cosine_sim, 9) AS cooc_cosine_sim, pop_store, CAST(0 AS INTEGER) AS pop_global,
               '__MISSING__' AS channel FROM popular""",
    "encode_features": f"""
        SELECT {ROW}, cand_is_new::DOUBLE AS cand_is_new, round(cooc_cosine_sim, 9) AS cooc_cosine_sim,
               kiosk_product_cnt::DOUBLE AS kiosk_product_cnt, pop_global::DOUBLE AS pop_global,
               pop_store::DOUBLE AS pop_store, coalesce(same_category, 0)::DOUBLE AS same_category,
               {_code("coalesce(channel, '__MISSING__')")} AS channel,
               {_code("coalesce(region, '__MISSING__')")} AS region FROM gaps""",
    "zero_only_features": """
        SELECT feature FROM (
            SELECT unnest(['cand_is_new', 'cooc_cosine_sim', 'kiosk_product_cnt', 'pop_global', 'pop_store',
                           'same_category', 'never']) AS feature,
                   unnest([max(abs(cand_is_new)), max(abs(cooc_cosine_sim)), max(abs(kiosk_product_cnt)),
                           max(abs(pop_global)), max(abs(pop_store)), max(abs(same_category)), 0.0]) AS peak
            FROM features)
        WHERE peak IS NULL OR peak = 0""",
    "label_pairs_same_order": """
        SELECT a.kiosk_id, a.product_id AS anchor_product_id, c.product_id AS candidate_product_id,
               count(*) AS cooc_count
        FROM test_lines a JOIN test_lines c
          ON a.kiosk_id = c.kiosk_id AND a.order_id = c.order_id AND a.product_id <> c.product_id GROUP BY ALL""",
    "label_pairs_window": "SELECT * FROM pairs",
    "label_pairs_same_order_large": """
        SELECT a.kiosk_id, a.product_id AS anchor_product_id, c.product_id AS candidate_product_id,
               count(*) AS cooc_count
        FROM test_lines a JOIN test_lines c
          ON a.kiosk_id = c.kiosk_id AND a.order_id = c.order_id AND a.product_id <> c.product_id GROUP BY ALL""",
    "label_pairs_window_busy": "SELECT * FROM pairs",
    "label_pairs_stream": """
        SELECT pairs.*, (SELECT count(*) FROM test, (
            SELECT min(order_dt) AS low, CAST(floor(epoch(max(order_dt)) - epoch(min(order_dt))) AS BIGINT) // 6 + 1 AS width FROM test)
            WHERE epoch(order_dt) - epoch(low) < width) AS late_lines FROM pairs""",
    "running_candidates": """
        SELECT * FROM (
            WITH later AS (
                SELECT * FROM history WHERE CAST(order_dt AS DATE) > (SELECT min(CAST(order_dt AS DATE)) FROM history)),
            day_lines AS (SELECT DISTINCT CAST(order_dt AS DATE) AS day, kiosk_id, order_id, product_id FROM later),
            day_baskets AS (
                SELECT day, kiosk_id, order_id FROM day_lines GROUP BY ALL HAVING count(*) BETWEEN 2 AND 200),
            kept AS (SELECT day_lines.* FROM day_lines JOIN day_baskets USING (day, kiosk_id, order_id)),
            often AS (SELECT product_id, count(*) AS times FROM kept GROUP BY ALL HAVING count(*) >= 2),
            met AS (
                SELECT a.product_id AS anchor_product_id, c.product_id AS candidate_product_id, count(*) AS cooc_count
                FROM kept a JOIN kept c ON a.day = c.day AND a.order_id = c.order_id AND a.product_id <> c.product_id
                GROUP BY ALL HAVING count(*) >= 2),
            size AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM day_baskets)
            SELECT anchor_product_id, candidate_product_id, cooc_count, a.times AS anchor_count, c.times AS candidate_count,
                   round(cooc_count / n, 9) AS support, round(CAST(cooc_count AS DOUBLE) / a.times, 9) AS confidence,
                   round((cooc_count / n) / ((a.times / n) * (c.times / n)), 9) AS lift,
                   round(cooc_count / sqrt(CAST(a.times * c.times AS DOUBLE)), 9) AS cooc_cosine_sim
            FROM met JOIN often a ON a.product_id = anchor_product_id JOIN often c ON c.product_id = candidate_product_id, size)""",
    "build_label_pairs": """
        SELECT a.kiosk_id, a.product_id AS anchor_product_id, c.product_id AS candidate_product_id,
               count(*) AS cooc_count
        FROM history a JOIN history c ON a.kiosk_id = c.kiosk_id AND a.product_id <> c.product_id
         AND c.order_dt >= a.order_dt AND c.order_dt <= a.order_dt + INTERVAL 30 DAY
        GROUP BY ALL HAVING count(*) >= 2""",
    "build_labels": "SELECT * REPLACE (round(cooc_cosine_sim, 9) AS cooc_cosine_sim) FROM labeled",
    "queries_with_positives": """
        SELECT * FROM wanted WHERE (kiosk_id, anchor_product_id) IN (SELECT (kiosk_id, anchor_product_id) FROM pairs)""",
    "filter_good_queries": "SELECT * REPLACE (round(cooc_cosine_sim, 9) AS cooc_cosine_sim) FROM good",
    "sample_negatives": f"""
        SELECT * REPLACE (round(cooc_cosine_sim, 9) AS cooc_cosine_sim) FROM labeled
        QUALIFY label = 1 OR row_number() OVER (PARTITION BY kiosk_id, anchor_product_id, label
            ORDER BY {_draw(42, 'kiosk_id', 'anchor_product_id', 'candidate_product_id')}, candidate_product_id) <= 20""",
    "shuffle_within_query": f"""
        SELECT {ROW}, row_number() OVER (PARTITION BY kiosk_id, anchor_product_id
            ORDER BY {_draw(42, 'kiosk_id', 'anchor_product_id', 'candidate_product_id')}, candidate_product_id)
            AS shuffle_rank FROM cells""",
    "label_stats": """
        SELECT count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS positives,
               CAST(count(*) - sum(label) AS BIGINT) AS negatives,
               round(sum(label) / CAST(count(*) AS DOUBLE), 6) AS pos_ratio,
               count(DISTINCT kiosk_id || '::' || anchor_product_id) AS queries FROM labeled""",
    "split_summary": f"""
        SELECT 'good' AS split, {_label_summary('good')} UNION ALL
        SELECT 'test' AS split, {_label_summary('labeled')}""",
    "build_labeled_split": f"""
        SELECT {FEATURE_LIST}, same_category, channel, region, g.label
        FROM features JOIN (SELECT * FROM good
            QUALIFY label = 1 OR row_number() OVER (PARTITION BY kiosk_id, anchor_product_id, label
            ORDER BY {_draw(42, 'kiosk_id', 'anchor_product_id', 'candidate_product_id')},
                     candidate_product_id) <= 60) g
        USING ({ROW})""".replace("cooc_cosine_sim, 9", "features.cooc_cosine_sim, 9"),
    "query_group_sizes": """
        SELECT kiosk_id || '::' || anchor_product_id AS query_id, count(*) AS q_size FROM cells GROUP BY ALL""",
    "candidate_recall": """
        SELECT count(*) AS total_pos, count(c.candidate_product_id) AS hits,
               round(count(c.candidate_product_id) / CAST(count(*) AS DOUBLE), 6) AS recall
        FROM (SELECT * FROM pairs WHERE (kiosk_id, anchor_product_id) IN
                (SELECT (kiosk_id, anchor_product_id) FROM cells)) p
        LEFT JOIN cells c USING (kiosk_id, anchor_product_id, candidate_product_id)""",
    "hitrate_at_k": _one_metric("HitRate", "hitrate"),
    "ndcg_at_k": _one_metric("NDCG", "ndcg"),
    "positives_at_k": _one_metric("Positives", "positives"),
    "recall_at_k": _one_metric("Recall", "recall"),
    "precision_at_k": _one_metric("Precision", "precision"),
    "mrr_at_k": _one_metric("MRR", "mrr"),
    "quantity_captured_at_k": """
        SELECT round(avg(q), 6) AS quantity_captured FROM (
            SELECT v.kiosk_id, v.anchor_product_id, sum(t.quantity) AS q
            FROM test t JOIN valid v ON v.kiosk_id = t.kiosk_id AND v.candidate_product_id = t.product_id
            WHERE v.rank <= 20 AND (t.order_id, t.kiosk_id) IN (
                SELECT (o.order_id, o.kiosk_id)
                FROM test o JOIN valid w ON w.kiosk_id = o.kiosk_id AND w.anchor_product_id = o.product_id)
            GROUP BY ALL)""",
    "quantity_captured_per_order_at_k": """
        SELECT round(avg(q / n), 6) AS quantity_per_order
        FROM (SELECT o.kiosk_id, o.anchor_product_id, sum(t.quantity) AS q
              FROM (SELECT DISTINCT t.order_id, w.kiosk_id, w.anchor_product_id
                    FROM test t JOIN valid w ON w.kiosk_id = t.kiosk_id AND w.anchor_product_id = t.product_id) o
              JOIN test t ON t.kiosk_id = o.kiosk_id AND t.order_id = o.order_id
              JOIN valid v ON v.kiosk_id = o.kiosk_id AND v.anchor_product_id = o.anchor_product_id
                          AND v.candidate_product_id = t.product_id AND v.rank <= 20
              GROUP BY ALL)
        JOIN (SELECT w.kiosk_id, w.anchor_product_id, count(DISTINCT t.order_id) AS n
              FROM test t JOIN valid w ON w.kiosk_id = t.kiosk_id AND w.anchor_product_id = t.product_id
              GROUP BY ALL) USING (kiosk_id, anchor_product_id)""",
    "category_coverage_lift_at_k": """
        SELECT round(avg(CAST(shown AS DOUBLE) / true_kinds), 6) AS coverage_lift
        FROM (SELECT kiosk_id, anchor_product_id,
                     count(DISTINCT coalesce(category, '?')) FILTER (rank <= 20) AS shown,
                     count(DISTINCT coalesce(category, '?')) FILTER (label = 1) AS true_kinds
              FROM ranked LEFT JOIN products ON productid = candidate_product_id GROUP BY ALL)
        WHERE true_kinds > 0""",
    "metrics_table": _long_metrics(),
    "eval_query_coverage": """
        SELECT count(*) AS n_queries, count(*) FILTER (best = 1) AS n_with_pos,
               round(100.0 * count(*) FILTER (best = 1) / count(*), 6) AS pct_with_pos
        FROM (SELECT max(label) AS best FROM judged GROUP BY kiosk_id, anchor_product_id)""",
    "product_info": "SELECT productid AS product_id, name AS product_name, category FROM products",
    "predict_scores": f"SELECT kiosk_id, anchor_product_id, candidate_product_id, {FIXED_SCORE} AS score FROM scored",
    "ranker_save_load": f"SELECT kiosk_id, anchor_product_id, candidate_product_id, {FIXED_SCORE} AS score FROM scored",
    "fixed_score_stats": f"""
        SELECT round(min(s), 6) AS min_score, round(max(s), 6) AS max_score, round(avg(s), 6) AS mean_score
        FROM (SELECT {FIXED_SCORE} AS s FROM scored)""",
    "lambda_gradients": """
        SELECT * FROM (WITH placed AS (
            SELECT *, row_number() OVER (PARTITION BY kiosk_id, anchor_product_id ORDER BY candidate_product_id) AS place,
                   count(*) FILTER (label = 1) OVER (PARTITION BY kiosk_id, anchor_product_id) AS n_pos FROM labeled),
        pairs AS (
            SELECT a.kiosk_id, a.anchor_product_id, a.candidate_product_id, a.label,
                   abs(1 / log2(a.place + 1) - 1 / log2(b.place + 1))
                   / list_sum(list_transform(range(1, a.n_pos + 1), lambda i: 1 / log2(i + 1))) AS swap
            FROM placed a JOIN placed b
              ON a.kiosk_id = b.kiosk_id AND a.anchor_product_id = b.anchor_product_id AND a.label <> b.label)
        SELECT kiosk_id, anchor_product_id, candidate_product_id,
               round(sum(swap / 2) * CASE WHEN label = 1 THEN 1 ELSE -1 END, 6) AS push, round(sum(swap / 4), 6) AS curve
        FROM pairs GROUP BY kiosk_id, anchor_product_id, candidate_product_id, label)""",
    "score_stats": """
        SELECT round(min(score), 6) AS min_score, round(max(score), 6) AS max_score,
               round(avg(score), 6) AS mean_score FROM scored""",
    "predictions_catalog": "SELECT * FROM catalog",
    "catalog_coverage": """
        SELECT count(*) AS n_rows, count(DISTINCT kiosk_id || '::' || anchor_product_id) AS n_queries,
               count(DISTINCT kiosk_id) AS n_kiosks, (SELECT count(DISTINCT userid) FROM active_stores) AS n_active,
               round(100.0 * count(DISTINCT kiosk_id) / (SELECT count(DISTINCT userid) FROM active_stores), 6)
                   AS coverage_pct FROM catalog""",
    "anchor_fallback": f"""
        SELECT anchor_product_id, pa.name AS anchor_name, candidate_product_id, pc.name AS candidate_name,
               pc.category, round({_scaled('cooc_cosine_sim', 'anchor_best', '(SELECT min(score) FROM scored)',
                                           '(SELECT max(score) FROM scored)')}, 6) AS score
        FROM anchor_best LEFT JOIN products pa ON pa.productid = anchor_product_id
        LEFT JOIN products pc ON pc.productid = candidate_product_id""",
    "category_fallback": f"""
        SELECT category, product_id AS candidate_product_id, name AS candidate_name,
               round({_scaled('pop', 'category_best')}, 6) AS score FROM category_best""",
    "global_fallback": f"""
        SELECT product_id AS candidate_product_id, name AS candidate_name, category,
               round({_scaled('pop', 'global_best')}, 6) AS score FROM global_best""",
    "minmax_scale_to_range": f"""
        SELECT anchor_product_id, candidate_product_id, round(cooc_cosine_sim, 6) AS cooc_cosine_sim,
               round({_scaled('cooc_cosine_sim', 'topk')}, 6) AS score FROM topk""",
    "build_lookup": "SELECT * FROM lookup",
    "recommend_requests": """
        SELECT r.anchor_id, r.kiosk_id, c.product_id, CAST(c.position AS INTEGER) AS position, 'ranker' AS model_id
        FROM requests r JOIN catalog_at c USING (anchor_id, kiosk_id) WHERE c.position <= r."limit" """,
    "recommend_multi": """
        SELECT r.anchor_id, r.kiosk_id, coalesce(l.recs, '') AS recs, 'ranker' AS model_id
        FROM requests r LEFT JOIN lookup l USING (anchor_id, kiosk_id)""",
    "recommend_with_fallback": """
        SELECT anchor_id, kiosk_id, level, CAST(position AS INTEGER) AS position, product_id FROM (
            SELECT r.anchor_id, r.kiosk_id, r."limit" AS cap, a.level, a.position, a.product_id,
                   min(a.level) OVER (PARTITION BY r.anchor_id, r.kiosk_id) AS best
            FROM requests r JOIN (
                SELECT 1 AS level, anchor_id, kiosk_id, product_id, position FROM catalog_at
                UNION ALL
                SELECT 2, anchor_product_id, NULL, candidate_product_id,
                       row_number() OVER (PARTITION BY anchor_product_id
                                          ORDER BY cooc_cosine_sim DESC, candidate_product_id) FROM anchor_best
                UNION ALL
                SELECT 3, p.productid, NULL, b.product_id, b.position
                FROM all_products p JOIN (
                    SELECT *, row_number() OVER (PARTITION BY category ORDER BY pop DESC, product_id) AS position
                    FROM category_best) b ON b.category = p.category
                UNION ALL
                SELECT 4, NULL, NULL, product_id, row_number() OVER (ORDER BY pop DESC, product_id) FROM global_best
            ) a ON (a.anchor_id = r.anchor_id OR a.anchor_id IS NULL)
               AND (a.kiosk_id = r.kiosk_id OR a.kiosk_id IS NULL))
        WHERE level = best AND position <= cap""",
    "top_k_per_query": f"SELECT {ROW}, score FROM top",
    "personalization_totals": """
        SELECT count(DISTINCT kiosk_id) AS n_kiosks, count(DISTINCT kiosk_id || '::' || anchor_product_id) AS n_queries,
               count(DISTINCT candidate_product_id) AS n_products FROM top""",
    "kiosk_rec_sets": "SELECT kiosk_id, candidate_product_id, count(*) AS times FROM top GROUP BY ALL",
    "anchor_list_diversity": """
        SELECT *, round(CAST(n_unique_lists AS DOUBLE) / n_kiosks * 100, 6) AS pct_unique FROM diversity""",
    "anchor_diversity_summary": """
        SELECT round(avg(p), 6) AS avg_pct, round(median(p), 6) AS median_pct
        FROM (SELECT CAST(n_unique_lists AS DOUBLE) / n_kiosks * 100 AS p FROM diversity)""",
    "global_baseline_topk": "SELECT * FROM baseline",
    "baseline_overlap": """
        SELECT round(avg(pct), 6) AS mean_overlap, round(quantile_cont(pct, 0.25), 6) AS p25,
               round(quantile_cont(pct, 0.5), 6) AS median, round(quantile_cont(pct, 0.75), 6) AS p75 FROM overlap""",
    "pairwise_jaccard": """
        SELECT count(*) AS n_pairs, round(avg(j), 6) AS mean_jaccard FROM (
            SELECT CAST(len(list_intersect(a.recs, b.recs)) AS DOUBLE)
                   / len(list_distinct(list_concat(a.recs, b.recs))) AS j
            FROM lists a JOIN lists b ON a.anchor_product_id = b.anchor_product_id AND a.kiosk_id < b.kiosk_id
            WHERE a.anchor_product_id = (SELECT anchor_product_id FROM favourite))""",
    "sampled_jaccard": f"""
        SELECT count(*) AS n_pairs, round(avg(j), 6) AS mean_jaccard FROM (
            SELECT CAST(len(list_intersect(a.recs, b.recs)) AS DOUBLE)
                   / len(list_distinct(list_concat(a.recs, b.recs))) AS j
            FROM (SELECT * FROM lists WHERE anchor_product_id = (SELECT anchor_product_id FROM favourite)
                  ORDER BY {_draw(42, 'kiosk_id')}, kiosk_id LIMIT 200) a
            JOIN (SELECT * FROM lists WHERE anchor_product_id = (SELECT anchor_product_id FROM favourite)
                  ORDER BY {_draw(42, 'kiosk_id')}, kiosk_id LIMIT 200) b ON a.kiosk_id < b.kiosk_id
            ORDER BY {_draw(42, 'a.kiosk_id', 'b.kiosk_id')}, a.kiosk_id, b.kiosk_id LIMIT 1000)""",
    "example_recs": f"""
        SELECT t.kiosk_id, t.anchor_product_id, CAST(t.rank AS INTEGER) AS rank, t.candidate_product_id,
               p.name AS candidate_name
        FROM top_at t LEFT JOIN products p ON p.productid = t.candidate_product_id
        WHERE t.anchor_product_id = (SELECT anchor_product_id FROM favourite) AND t.kiosk_id IN (
            SELECT kiosk_id FROM (SELECT DISTINCT kiosk_id FROM top
                                  WHERE anchor_product_id = (SELECT anchor_product_id FROM favourite))
            ORDER BY {_draw(123, 'kiosk_id')}, kiosk_id LIMIT 3)""",
    "new_vs_repeat_totals": _counts("top"),
    "new_share_by_position": """
        SELECT CAST(rank AS INTEGER) AS rank, count(*) AS n,
               round(100.0 * count(*) FILTER (cand_is_new = 1) / count(*), 6) AS new_pct FROM top_at GROUP BY ALL""",
    "new_vs_repeat_pool": _counts("scored"),
    "avg_pop_store": """
        SELECT round(avg(pop_store), 6) AS avg_all, round((SELECT avg(pop_store) FROM top), 6) AS avg_top,
               round((SELECT avg(pop_store) FROM top WHERE cand_is_new = 0), 6) AS avg_top_repeat FROM scored""",
    "mixed_queries": "SELECT * FROM mixed",
    "mixed_query_examples": """
        SELECT t.kiosk_id, t.anchor_product_id, pa.name AS anchor_name, CAST(t.rank AS INTEGER) AS rank,
               CASE WHEN cand_is_new = 1 THEN 'NEW' ELSE '' END AS tag, pop_store, t.candidate_product_id,
               pc.name AS candidate_name
        FROM top_at t JOIN (SELECT * FROM mixed ORDER BY kiosk_id, anchor_product_id LIMIT 3) m
          USING (kiosk_id, anchor_product_id)
        LEFT JOIN products pa ON pa.productid = t.anchor_product_id
        LEFT JOIN products pc ON pc.productid = t.candidate_product_id""",
}


def _stump(result: str) -> str:
    """One boosting round with learning rate 1, L2 1 and the split of ``same_brand`` at 0.5."""
    return f"""
        SELECT * FROM (WITH placed AS (
            SELECT kiosk_id, anchor_product_id, candidate_product_id, label, 
                   CAST(split_part(anchor_product_id, '-', 1) = split_part(candidate_product_id, '-', 1) AS INTEGER) AS same_brand,
                   row_number() OVER (PARTITION BY kiosk_id, anchor_product_id ORDER BY candidate_product_id) AS place,
                   count(*) FILTER (label = 1) OVER (PARTITION BY kiosk_id, anchor_product_id) AS n_pos FROM labeled),
        pushed AS (
            SELECT a.same_brand, CASE WHEN a.label = 1 THEN 1 ELSE -1 END * abs(1 / log2(a.place + 1) - 1 / log2(b.place + 1))
                       / list_sum(list_transform(range(1, a.n_pos + 1), lambda i: 1 / log2(i + 1))) AS swap
            FROM placed a JOIN placed b
              ON a.kiosk_id = b.kiosk_id AND a.anchor_product_id = b.anchor_product_id AND a.label <> b.label),
        leaves AS (
            SELECT same_brand, sum(swap / 2) AS push, sum(abs(swap) / 4) AS curve, push / (curve + 1) AS value FROM pushed GROUP BY same_brand),
        gains AS (
            SELECT sum(push * push / curve) - sum(push) * sum(push) / sum(curve) AS gain FROM leaves),
        ranked AS (
            SELECT p.*, row_number() OVER (PARTITION BY kiosk_id, anchor_product_id ORDER BY value DESC, candidate_product_id) AS spot
            FROM placed p JOIN leaves USING (same_brand) WHERE n_pos > 0),
        graded AS (
            SELECT k, coalesce(sum(1 / log2(spot + 1)) FILTER (label = 1 AND spot <= k), 0)
                   / list_sum(list_transform(range(1, least(k, any_value(n_pos)) + 1), lambda i: 1 / log2(i + 1))) AS ndcg
            FROM ranked, (VALUES (5), (10)) AS cuts(k) GROUP BY k, kiosk_id, anchor_product_id)
        {result})"""


QUERIES["stump_nodes"] = _stump("""SELECT 1 AS tree, 0 AS node, 0 AS feature, 0.5::DOUBLE AS threshold, 1 AS low, 2 AS high, 0.0::DOUBLE AS value,
               round(gain, 6) AS gain FROM gains
        UNION ALL SELECT 1, 1 + same_brand, -1, 0.0, 0, 0, round(value, 6), 0.0 FROM leaves""")
QUERIES["stump_importance"] = _stump("SELECT 'same_brand' AS feature, round(gain, 6) AS gain FROM gains")
QUERIES["stump_eval_curve"] = _stump("""SELECT 1 AS iteration, dataset, 'ndcg@' || k AS metric, round(avg(ndcg), 6) AS value
        FROM graded, (VALUES ('train'), ('valid')) AS parts(dataset) GROUP BY k, dataset""")
QUERIES["personalization_report_files"] = QUERIES["kiosk_rec_sets"].replace("FROM top", "FROM fixed_top")
QUERIES["novelty_report_files"] = QUERIES["new_share_by_position"].replace("FROM top_at", "FROM fixed_top")
QUERIES["recommend_requests_bucketed"] = QUERIES["recommend_requests"]
QUERIES["recommend_requests_stream"] = QUERIES["recommend_requests"]


def all_oracles() -> dict[str, str]:
    return {name: with_steps(query.strip()) for name, query in QUERIES.items()}
