"""

Every query reads the driver tables of ``sf_dir`` -- the ``events`` table,
mapped row for row onto ad events by :mod:`adevents.plans.adapter` -- or
data Spark derives from them (the prepared event store and its summary
tables, CSV parts and zip archives rendered from the same rows, a store
built by streaming those parts).  See :mod:`adevents.plans.catalog`.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
from collections.abc import Callable

# The package lives next to this file; make it importable however this
# module was loaded (by path, from another working directory).
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from adevents.plans import catalog  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily impression revenue from the prepared store (sf0.001)."""
    return catalog.flagship(spark, SMOKE_DIR)


def _optional(name: str):
    """The module, or None where it (or its package) isn't installed."""
    try:
        found = importlib.util.find_spec(name)
    except ModuleNotFoundError:
        return None
    return importlib.import_module(name) if found else None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(catalog.queries())
    if llm := _optional("adevents.llm.queries"):
        out |= llm.QUERIES
        if pipeline := _optional("corpus_pipeline"):
            out["pipeline"] = pipeline.run
    return out


# --------------------------------------------------------------------------
# DuckDB oracles
# --------------------------------------------------------------------------

# The same row-for-row mapping of the driver's events as the adapter.
AD_EVENTS = """
WITH ad_events AS (
  SELECT
    ts,
    CAST(date_trunc('week', ts) AS TIMESTAMP) AS week,
    CAST(ts AS DATE) AS day,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour,
    strftime(ts, '%Y-%m-%d %H:%M') AS minute,
    CASE event_type WHEN 'view' THEN 'impression' WHEN 'signup' THEN 'serve' ELSE event_type END AS type,
    'a' || CAST(event_id AS VARCHAR) AS auction_id,
    CAST(user_id % 20 AS INTEGER) AS advertiser_id,
    TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS publisher_id,
    CASE WHEN event_type = 'view' AND event_id % 89 <> 0 THEN value END AS bid_price,
    user_id,
    CASE WHEN event_type = 'purchase' AND event_id % 83 <> 0 THEN value END AS total_price,
    CASE user_id % 6 WHEN 0 THEN 'US' WHEN 1 THEN 'JP' WHEN 2 THEN 'DE' WHEN 3 THEN 'BR' WHEN 4 THEN 'IN' END AS country
  FROM events
),
-- the same rows after a trip through text parts: ts keeps whole milliseconds
ad_text AS (
  SELECT * REPLACE (make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts) FROM ad_events
)"""

_RV = """, rv AS (
  SELECT minute, day, publisher_id, country, SUM(bid_price) AS total_revenue
  FROM ad_events WHERE type = 'impression' GROUP BY minute, day, publisher_id, country
)"""
_PU = """, pu AS (
  SELECT country, SUM(total_price) AS s, COUNT(total_price) AS c
  FROM ad_events WHERE type = 'purchase' GROUP BY country
)"""
_CT = """, ct AS (
  SELECT advertiser_id, type, COUNT(*) AS event_count FROM ad_events GROUP BY advertiser_id, type
)"""

_ALL = "ts, week, day, hour, minute, type, auction_id, advertiser_id, publisher_id, bid_price, user_id, total_price, country"
_ROW = "auction_id, type, day, advertiser_id, publisher_id, bid_price, country"

_Q = {
    "q1": """
SELECT day, ROUND(SUM(bid_price), 4) AS sum_bid_price
FROM {src} WHERE type = 'impression' GROUP BY day""",
    "q2": """
SELECT publisher_id, ROUND(SUM(bid_price), 4) AS sum_bid_price
FROM {src}
WHERE type = 'impression' AND country = 'JP' AND day BETWEEN DATE '2024-01-20' AND DATE '2024-01-23'
GROUP BY publisher_id""",
    "q3": """
SELECT country, ROUND(AVG(total_price), 6) AS avg_total_price
FROM {src} WHERE type = 'purchase' GROUP BY country
ORDER BY avg_total_price DESC NULLS LAST""",
    "q4": """
SELECT advertiser_id, type, COUNT(*) AS count_star
FROM {src} GROUP BY advertiser_id, type ORDER BY count_star DESC""",
    "q5": """
SELECT minute, ROUND(SUM(bid_price), 4) AS sum_bid_price
FROM {src} WHERE type = 'impression' AND day = DATE '2024-01-15'
GROUP BY minute ORDER BY minute""",
}
_R = {
    "r1": _RV + """
SELECT day, ROUND(SUM(total_revenue), 4) AS sum_bid_price FROM rv GROUP BY day""",
    "r2": _RV + """
SELECT publisher_id, ROUND(SUM(total_revenue), 4) AS sum_bid_price FROM rv
WHERE country = 'JP' AND day BETWEEN DATE '2024-01-20' AND DATE '2024-01-23'
GROUP BY publisher_id""",
    "r3": _PU + """
SELECT country, ROUND(s / NULLIF(c, 0), 6) AS avg_total_price FROM pu
ORDER BY avg_total_price DESC NULLS LAST""",
    "r4": _CT + """
SELECT advertiser_id, type, event_count AS count_star FROM ct ORDER BY count_star DESC""",
    "r5": _RV + """
SELECT minute, ROUND(SUM(total_revenue), 4) AS sum_bid_price FROM rv
WHERE day = DATE '2024-01-15' GROUP BY minute ORDER BY minute""",
}
_LABELS = {"1": "daily_revenue", "2": "publisher_revenue", "3": "avg_purchase", "4": "event_counts", "5": "minute_revenue"}

_FILTERS = {
    "filter_eq": "country = 'JP'",
    "filter_neq": "country <> 'US'",
    "filter_range": "bid_price > 10 AND bid_price <= 80 AND advertiser_id >= 3 AND advertiser_id < 15",
    "filter_between": "minute BETWEEN '2024-01-05 00:00' AND '2024-01-06 12:00'",
    "filter_in": "country IN ('US', 'JP')",
    "filter_fraction": "advertiser_id < 12.5 AND advertiser_id >= 2.5 AND publisher_id BETWEEN -0.5 AND 60.25 AND advertiser_id <> 7.5",
    "filter_wide": "advertiser_id < 3000000000 AND publisher_id > -3000000000 AND user_id <= 400",
    "filter_hours": "hour BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-05 18:00:00' "
    "AND type IN ('impression', 'click', 'purchase')",
    "filter_and": "type = 'impression' AND country IN ('DE', 'BR', 'IN') "
    "AND day BETWEEN DATE '2024-01-03' AND DATE '2024-01-25' AND publisher_id >= 20",
}

_DAILY = "SELECT day, ROUND(SUM(bid_price), 4) AS sum_bid_price, '{source}' AS source FROM ad_events WHERE type = 'impression' AND {cond} GROUP BY day"

_OTHER = {
    "answer_routed": _DAILY.format(source="daily_revenue", cond="country IN ('US', 'DE')"),
    "answer_fallback": _DAILY.format(source="events", cond="user_id < 500"),
    "answer_empty_count": "SELECT COUNT(*) AS count_star, 'counts' AS source FROM ad_events WHERE type = 'no such type'",
    "reload_day": """
SELECT type, day, COUNT(*) AS n_rows FROM ad_events
WHERE NOT (type = 'click' AND day = DATE '2024-01-10') OR type IS NULL OR day IS NULL OR advertiser_id < 7.5
GROUP BY type, day""",
    "view_report": "SELECT type, COUNT(*) AS n_rows, COUNT(DISTINCT country) AS n_countries FROM ad_events GROUP BY type",
    "scalar_items": """
SELECT lower(country) AS lower_country, CAST(month(day) AS INTEGER) AS month_day, CAST(length(type) AS INTEGER) AS length_type,
       COUNT(*) AS count_star
FROM ad_events GROUP BY ALL""",
    "rollup_snapshot": _DAILY.format(source="daily_revenue", cond="TRUE"),
    "streamed_rollups": """
SELECT day, publisher_id, country, ROUND(SUM(bid_price), 4) AS total_revenue FROM ad_text WHERE type = 'impression' GROUP BY ALL""",
    "answer_hybrid": """
SELECT country, ROUND(SUM(bid_price), 4) AS sum_bid_price, 'daily_revenue+events' AS source FROM ad_events
WHERE type = 'impression' AND hour BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 17:00:00' GROUP BY country""",
    "distinct_from_rollup": """
SELECT country, COUNT(DISTINCT user_id) AS count_distinct_user_id FROM ad_events
WHERE day BETWEEN DATE '2024-01-04' AND DATE '2024-01-22' GROUP BY country""",
    "spread_from_rollup": """
SELECT advertiser_id, ROUND(STDDEV_SAMP(bid_price), 6) AS stddev_bid_price, ROUND(VAR_SAMP(total_price), 6) AS variance_total_price,
       ROUND(STDDEV_POP(total_price), 6) AS stddev_pop_total_price, ROUND(VAR_POP(bid_price), 6) AS var_pop_bid_price
FROM ad_events WHERE day BETWEEN DATE '2024-01-04' AND DATE '2024-01-22' GROUP BY advertiser_id""",
    # the exact quantile's bucket, and how many values lie below and in it
    "quantile_from_rollup": """,
v AS (
  SELECT country, bid_price AS x FROM ad_events
  WHERE type = 'impression' AND day BETWEEN DATE '2024-01-04' AND DATE '2024-01-22' AND bid_price IS NOT NULL
),
s AS (SELECT country, x, row_number() OVER (PARTITION BY country ORDER BY x) AS r, COUNT(*) OVER (PARTITION BY country) AS n FROM v),
e AS (SELECT country, n, r AS rank, x FROM s WHERE r = GREATEST(CAST(ceil(0.9 * n) AS BIGINT), 1)),
p AS (
  SELECT *, CASE WHEN pow(2.0, floor(log2(x))) > x THEN floor(log2(x)) - 1
                 WHEN pow(2.0, floor(log2(x)) + 1) <= x THEN floor(log2(x)) + 1 ELSE floor(log2(x)) END AS k FROM e
),
b AS (
  SELECT *, pow(2.0, k) * (1 + floor((x / pow(2.0, k) - 1) * 16) / 16) AS low,
    pow(2.0, k) * (1 + (floor((x / pow(2.0, k) - 1) * 16) + 1) / 16) AS high FROM p
)
SELECT b.country, b.n, b.rank, COUNT(*) FILTER (v.x < b.low) + 1 AS first_rank, COUNT(*) FILTER (v.x < b.high) AS last_rank, b.low, b.high
FROM b JOIN v ON b.country IS NOT DISTINCT FROM v.country
GROUP BY b.country, b.n, b.rank, b.low, b.high""",
    "compare_keyed": """,
a AS (
  SELECT advertiser_id, country, ROUND(SUM(bid_price), 4) AS s, COUNT(*) AS c FROM ad_events
  WHERE type = 'impression' AND day BETWEEN DATE '2024-01-01' AND DATE '2024-01-15' AND advertiser_id <> 3 GROUP BY ALL
),
b AS (
  SELECT advertiser_id, country, ROUND(SUM(bid_price), 4) AS s, COUNT(*) AS c FROM ad_events
  WHERE type = 'impression' AND day BETWEEN DATE '2024-01-16' AND DATE '2024-01-31' AND country <> 'BR' GROUP BY ALL
),
j AS (
  SELECT COALESCE(a.advertiser_id, b.advertiser_id) AS advertiser_id, COALESCE(a.country, b.country) AS country,
    a.c IS NOT NULL AS in_a, b.c IS NOT NULL AS in_b, a.s AS sa, b.s AS sb, a.c AS ca, b.c AS cb
  FROM a FULL JOIN b ON a.advertiser_id IS NOT DISTINCT FROM b.advertiser_id AND a.country IS NOT DISTINCT FROM b.country
),
d AS (
  SELECT *, CASE WHEN in_a AND in_b THEN
      CAST(NOT (sa IS NOT DISTINCT FROM sb OR COALESCE(abs(sb - sa) <= 10 OR abs(sb - sa) <= 0.3 * GREATEST(abs(sa), abs(sb)), FALSE)) AS INTEGER)
      + CAST(NOT (abs(cb - ca) <= 10 OR abs(cb - ca) <= 0.3 * GREATEST(ca, cb)) AS INTEGER) ELSE 0 END AS n_changed
  FROM j
)
SELECT advertiser_id, country, CASE WHEN NOT in_b THEN 'missing' WHEN NOT in_a THEN 'added' ELSE 'changed' END AS status, n_changed,
  sa AS sum_bid_price_a, sb AS sum_bid_price_b, ROUND(sb - sa, 4) AS sum_bid_price_diff,
  ROUND((sb - sa) / NULLIF(GREATEST(abs(sa), abs(sb)), 0), 6) AS sum_bid_price_rel,
  ca AS count_star_a, cb AS count_star_b, CAST(cb - ca AS DOUBLE) AS count_star_diff, ROUND((cb - ca) / GREATEST(ca, cb)::DOUBLE, 6) AS count_star_rel
FROM d WHERE n_changed > 0 OR NOT in_a OR NOT in_b""",
    "quarantine": """
SELECT auction_id, CASE WHEN n % 97 = 0 OR n % 103 = 0 THEN 'wrong number of fields' WHEN n % 101 = 0 THEN 'malformed total_price' END AS reason
FROM (SELECT auction_id, CAST(substr(auction_id, 2) AS BIGINT) AS n FROM ad_events)""",
    "clustered_scan": "\nUNION ALL\n".join(
        f"SELECT auction_id, day, country, publisher_id, minute, bid_price, '{d}' AS dimension FROM ad_events WHERE {cond}"
        for d, cond in {
            "country": "country = 'JP'",
            "publisher_id": "publisher_id BETWEEN 20 AND 29",
            "minute": "minute BETWEEN '2024-01-15 06:00' AND '2024-01-15 11:59'",
        }.items()
    ),
    "input_guards": """
SELECT 'no parts' AS "case", 'not found' AS outcome, CAST(NULL AS BIGINT) AS n_rows UNION ALL SELECT 'no store', 'not found', NULL
UNION ALL SELECT 'store', 'opened', NULL UNION ALL SELECT 'parts', 'opened', COUNT(*) FROM ad_events""",
    "csv_roundtrip": f"SELECT {_ALL} FROM ad_text",
    "zip_roundtrip": f"SELECT {_ALL} FROM ad_text",
    "incremental_ingest": f"SELECT {_ALL} FROM ad_text",
    "incremental_ingest_by_name": f"SELECT {_ALL} FROM ad_text",
    "store_roundtrip": f"SELECT {_ALL} FROM ad_events",
    "store_pruned_scan": """
SELECT ts, day, publisher_id, country, bid_price FROM ad_events
WHERE type = 'impression' AND day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND country <> 'BR'""",
    "store_inventory": "SELECT type, day, COUNT(*) AS n_rows FROM ad_events GROUP BY type, day",
    "row_count": "SELECT COUNT(*) AS row_count FROM ad_events",
    "project": "SELECT auction_id, advertiser_id, user_id, country FROM ad_events",
    "derive_time": "SELECT auction_id, ts, week, day, hour, minute FROM ad_text",
    "clean_ids": "SELECT auction_id, advertiser_id, publisher_id, user_id FROM ad_text",
    "clean_prices": "SELECT auction_id, bid_price, total_price FROM ad_text",
    "weekly_revenue": """
SELECT week, ROUND(SUM(bid_price), 4) AS sum_bid_price FROM ad_events WHERE type = 'impression' GROUP BY week""",
    "hourly_revenue": """
SELECT hour, ROUND(SUM(bid_price), 4) AS sum_bid_price FROM ad_events WHERE type = 'impression' GROUP BY hour""",
    "global_agg": """
SELECT ROUND(SUM(bid_price), 4) AS sum_bid_price, ROUND(AVG(bid_price), 6) AS avg_bid_price,
       MIN(bid_price) AS min_bid_price, MAX(bid_price) AS max_bid_price,
       COUNT(bid_price) AS count_bid_price, COUNT(*) AS count_star
FROM ad_events""",
    "agg_misc": """
SELECT country, MIN(bid_price) AS min_bid_price, MAX(bid_price) AS max_bid_price,
       ROUND(STDDEV_SAMP(bid_price), 6) AS stddev_bid_price, ROUND(VAR_SAMP(bid_price), 6) AS variance_bid_price,
       ROUND(MEDIAN(bid_price), 6) AS median_bid_price, COUNT(DISTINCT user_id) AS count_distinct_user_id,
       ROUND(MEDIAN(total_price), 6) AS median_total_price
FROM ad_events GROUP BY country""",
    "agg_variants": """
SELECT type, ROUND(STDDEV_POP(bid_price), 6) AS stddev_pop_bid_price, ROUND(VAR_POP(bid_price), 6) AS var_pop_bid_price,
       ROUND(AVG(total_price), 6) AS avg_total_price, CAST(SUM(DISTINCT advertiser_id) AS BIGINT) AS sum_distinct_advertiser_id,
       COUNT(DISTINCT country) AS count_distinct_country
FROM ad_events GROUP BY type""",
    "distinct_pairs": "SELECT DISTINCT advertiser_id, type FROM ad_events",
    "rollup_counts": "SELECT advertiser_id, type, COUNT(*) AS event_count FROM ad_events GROUP BY advertiser_id, type",
    "rollup_revenue": """
SELECT minute, day, publisher_id, country, ROUND(SUM(bid_price), 4) AS total_revenue
FROM ad_events WHERE type = 'impression' GROUP BY minute, day, publisher_id, country""",
    "rollup_purchases": """
SELECT country, ROUND(SUM(total_price), 4) AS sum_of_price, COUNT(total_price) AS count_of_purchases
FROM ad_events WHERE type = 'purchase' GROUP BY country""",
    "topk_bids": """
SELECT auction_id, advertiser_id, bid_price FROM ad_events WHERE type = 'impression'
ORDER BY bid_price DESC NULLS LAST, auction_id ASC NULLS LAST LIMIT 20""",
    "topk_advertisers": """
SELECT advertiser_id, COUNT(*) AS count_star FROM ad_events WHERE type = 'impression'
GROUP BY advertiser_id ORDER BY count_star DESC, advertiser_id ASC NULLS LAST LIMIT 5""",
    "adhoc_report": """
SELECT country, type, ROUND(SUM(bid_price), 4) AS sum_bid_price, COUNT(*) AS count_star,
       ROUND(AVG(total_price), 6) AS avg_total_price, MAX(minute) AS max_minute
FROM ad_events
WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-01-27' AND type <> 'error'
GROUP BY country, type
ORDER BY count_star DESC, country ASC NULLS LAST, type ASC NULLS LAST LIMIT 10""",
    "q1_sql_names": """
SELECT day, ROUND(SUM(bid_price), 4) AS "sum(bid_price)" FROM ad_events WHERE type = 'impression' GROUP BY day""",
    "compare_q3": """,
qa AS (SELECT country, ROUND(AVG(total_price), 6) AS v FROM ad_events WHERE type = 'purchase' GROUP BY country),
qb AS (SELECT country, ROUND(SUM(total_price) / NULLIF(COUNT(total_price), 0), 6) AS v
       FROM ad_events WHERE type = 'purchase' GROUP BY country),
counts AS (
  SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM qa)) AS rows_a,
         (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM qb)) AS rows_b,
         (SELECT COUNT(*) FROM (SELECT * FROM qa EXCEPT SELECT * FROM qb)) AS only_a,
         (SELECT COUNT(*) FROM (SELECT * FROM qb EXCEPT SELECT * FROM qa)) AS only_b
)
SELECT rows_a, rows_b, only_a, only_b, TRUE AS same_header, (only_a = 0 AND only_b = 0) AS matched FROM counts""",
}


def _verify_sql() -> str:
    parts = []
    for q in ("q1", "q2", "q3", "q4", "q5"):
        body = _Q[q].format(src="ad_events")
        body = body.split("ORDER BY")[0]
        parts.append(
            f"SELECT '{q}' AS query, n AS rows_a, n AS rows_b, CAST(0 AS BIGINT) AS only_a, "
            f"CAST(0 AS BIGINT) AS only_b, TRUE AS same_header, TRUE AS matched, 'PASS' AS status "
            f"FROM (SELECT COUNT(*) AS n FROM ({body}))"
        )
    parts.append("SELECT 'missing', NULL, NULL, NULL, NULL, FALSE, FALSE, 'FAIL'")  # in neither folder
    return "\n" + "\nUNION ALL\n".join(parts)


def _advice_sql() -> str:
    """The greedy choice as a recursion: ``b`` has the rows that each report reads so far."""
    from adevents.operators.advice import candidates, needed
    from adevents.plans.reports import SPECS

    needs = [needed(q) for q in SPECS.values()]
    grains = candidates(needs)
    rows = "\nUNION ALL\n".join(
        f"SELECT '{','.join(g)}' AS name, {len(g)} AS size, {[set(n) <= set(g) for n in needs]} AS covers, "
        f"(SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(g)} FROM ad_events)) AS k"
        for g in grains
    )
    gain = "list_sum(list_transform(range(1, len(s.b) + 1), lambda i: CASE WHEN c.covers[i] THEN greatest(s.b[i] - c.k, 0) ELSE 0 END))"
    after = "list_transform(range(1, len(s.b) + 1), lambda i: CASE WHEN c.covers[i] THEN least(s.b[i], c.k) ELSE s.b[i] END)"
    return f""",
c AS MATERIALIZED ({rows}),
total AS (SELECT COUNT(*) AS n FROM ad_events),
step AS (
  SELECT 0 AS nth, '' AS grain, CAST(0 AS BIGINT) AS n_rows, CAST(0 AS DOUBLE) AS saved_rows,
    list_transform(range({len(needs)}), lambda i: n) AS b, n // 5 AS budget
  FROM total
  UNION ALL
  SELECT nth + 1, name, k, gain, after, budget - k FROM (
    SELECT s.nth, s.budget, c.name, c.k, CAST({gain} AS DOUBLE) AS gain, {after} AS after,
      row_number() OVER (PARTITION BY s.nth ORDER BY {gain} / greatest(c.k, 1)::DOUBLE DESC, c.k, c.size, c.name) AS place
    FROM step s, c WHERE c.k <= s.budget AND {gain} > 0
  ) WHERE place = 1
),
single AS (
  SELECT 1 AS nth, c.name AS grain, c.k AS n_rows, CAST({gain} AS DOUBLE) AS saved_rows
  FROM step s, c WHERE s.nth = 0 AND c.k <= s.budget ORDER BY {gain} DESC, c.k, c.size, c.name LIMIT 1
),
better AS (SELECT COALESCE((SELECT saved_rows FROM single), 0) > (SELECT SUM(saved_rows) FROM step) AS one)
SELECT nth, grain, n_rows, saved_rows FROM step WHERE nth > 0 AND NOT (SELECT one FROM better)
UNION ALL SELECT nth, grain, n_rows, saved_rows FROM single WHERE (SELECT one FROM better)"""


def oracle_sql() -> dict[str, str]:
    a = AD_EVENTS
    out: dict[str, str] = {}
    for q, sql in _Q.items():
        label = _LABELS[q[1]]
        out[f"{q}_{label}"] = a + sql.format(src="ad_events")
        out[f"csv_{q}_{label}"] = a + sql.format(src="ad_text")
    for r, sql in _R.items():
        out[f"{r}_{_LABELS[r[1]]}"] = a + sql
    for key, cond in _FILTERS.items():
        out[key] = a + f"\nSELECT {_ROW} FROM ad_events WHERE {cond}"
    for key, sql in _OTHER.items():
        out[key] = a + ("\n" + sql if not sql.startswith(",") else sql)
    out["verify_reports"] = a + _verify_sql()
    out["advised_rollups"] = a.replace("WITH ad_events", "WITH RECURSIVE ad_events", 1) + _advice_sql()
    if llm := _optional("adevents.llm.oracles"):
        out |= llm.ORACLES
        pipeline = _optional("corpus_pipeline")
        if pipeline and pipeline.ORACLE_SQL:
            out["pipeline"] = pipeline.ORACLE_SQL
    return out
