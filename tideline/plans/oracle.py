"""DuckDB SQL equivalents of the registered queries (views = driver tables).

Written independently of the Spark code paths where possible: the expiring
dedup uses a closed form with a RANGE frame here and a merged timer/arrival
LAG in Spark; sessions number rows with a running count here and carry
session starts forward in Spark; the idle watermark takes a running max of
idle jumps here and forward-fills the last jump in Spark. Agreement is a real
cross-check.

Double literals are cast to DOUBLE: DuckDB would otherwise compare against a
DECIMAL and round differently at the thresholds.
"""

from __future__ import annotations

from tideline.functions.scalar import WHITESPACE_RUN_RE2
from tideline.sources.generators import LEHMER_MOD, LEHMER_MUL, T0_MS

_H_US = 3_600_000_000

_SIGNAL_CASE = """
    CASE WHEN prev = 0 AND {p} > 0 THEN 'SELL'
         WHEN prev = 0 AND {p} < 0 THEN 'BUY'
         WHEN prev = 0 THEN NULL
         WHEN isnan({p} / prev) THEN NULL
         WHEN {p} / prev < 0.95::DOUBLE THEN 'BUY'
         WHEN {p} / prev > 1.05::DOUBLE THEN 'SELL'
    END"""

def _avg6(col: str) -> str:
    """Exact AVG rounded half-up to 6 decimals, matching the Spark side step by step.

    The sum is exact in DECIMAL(38,8) (as integer units of 1e-8); the mean is
    rounded half-up to 12 places (Spark's decimal AVG), then to 6; the exact
    decimal becomes a double by one correctly rounded division.
    """
    s8 = f"CAST(SUM(CAST({col} AS DECIMAL(38,8))) * 100000000 AS HUGEINT)"
    q12 = f"(sign({s8}) * ((2 * abs({s8}) * 10000 + COUNT({col})) // (2 * COUNT({col}))))"
    q6 = f"(sign({q12}) * ((2 * abs({q12}) + 1000000) // 2000000))"
    return f"(CAST({q6} AS DOUBLE) / 1000000.0)"


_WORD_COUNT = f"""
SELECT word, COUNT(*) AS "count"
FROM (SELECT unnest(regexp_split_to_array(text, '{WHITESPACE_RUN_RE2}')) AS word FROM documents) t
WHERE word <> ''
GROUP BY word
"""


def _sessions(gap_us_sql: str) -> str:
    return f"""
WITH e AS (
  SELECT user_id, event_id, ts, value, epoch_us(ts) AS t, epoch_us(ts) + ({gap_us_sql}) AS e_us FROM events),
f AS (
  SELECT *, MAX(e_us) OVER (PARTITION BY user_id ORDER BY ts, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM e),
g AS (
  SELECT *, SUM(CASE WHEN prev_end IS NULL OR t > prev_end THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id, make_timestamp(MIN(t)) AS window_start, make_timestamp(MAX(e_us)) AS window_end,
       COUNT(*) AS n, CAST(ROUND(SUM(CAST(value AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_value
FROM g GROUP BY user_id, sid
"""


def _dedup_expiring(ttl: str) -> str:
    return f"""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *,
         LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts,
         MAX(ts) OVER (PARTITION BY user_id ORDER BY ts
                       RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL {ttl} PRECEDING) AS b
  FROM events) t
WHERE prev_ts IS NULL OR (b IS NOT NULL AND prev_ts < b + INTERVAL {ttl})
"""


def _trace(src_sql: str, ooo_ms: int, idle_ms: int, align_ms: int, delay_ms: int) -> str:
    """Watermark trace over ``src(src_key, rid, ts_ms, arrival_ms, ...)``."""
    return f"""
a AS ({src_sql}),
b AS (
  SELECT *, MAX(ts_ms) OVER (PARTITION BY src_key ORDER BY arrival_ms, rid
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mb,
            LAG(arrival_ms) OVER (PARTITION BY src_key ORDER BY arrival_ms, rid) AS pa
  FROM a),
c AS (
  SELECT *, MAX(CASE WHEN arrival_ms - pa > {idle_ms} THEN (mb // {align_ms}) * {align_ms} + {ooo_ms + 1} END)
              OVER (PARTITION BY src_key ORDER BY arrival_ms, rid ROWS UNBOUNDED PRECEDING) AS q
  FROM b),
tr AS (
  SELECT *, mb - {delay_ms} AS wm_bounded_ms,
         CASE WHEN q IS NULL THEN mb - {ooo_ms + 1}
              WHEN mb IS NULL THEN q
              ELSE greatest(mb - {ooo_ms + 1}, q) END AS wm_idle_ms
  FROM c)"""


_DAY_MS = 86_400_000
_REPLAY_SRC = """
  SELECT o_orderpriority AS src_key, (l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rid,
         o_orderpriority, l_orderkey, l_linenumber, l_quantity,
         epoch_us(o_orderdate) // 1000 AS ts_ms, epoch_us(l_shipdate) // 1000 AS arrival_ms
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
_REPLAY_TRACE = "WITH " + _trace(_REPLAY_SRC, 90 * _DAY_MS, _DAY_MS // 2, _DAY_MS, 90 * _DAY_MS)
_W_MS = 30 * _DAY_MS
_LATE = f"((ts_ms // {_W_MS}) * {_W_MS} + {_W_MS}) - 1 <= wm_bounded_ms"
_BOUNDS = f"(ts_ms // {_W_MS}) * {_W_MS} AS window_start_ms, (ts_ms // {_W_MS}) * {_W_MS} + {_W_MS} AS window_end_ms"

# Each ship year is one micro-batch; its watermark is the largest order date of the years before, less 90 days.
_SHIPPED = f"""
WITH s AS (
  SELECT o_orderpriority, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(o_orderdate AS TIMESTAMP) AS ts,
         CAST(year(l_shipdate) AS INTEGER) AS ship_year
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
b AS (
  SELECT ship_year, row_number() OVER (ORDER BY ship_year) - 1 AS epoch,
         MAX(MAX(ts)) OVER (ORDER BY ship_year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 90 DAY AS wm
  FROM s GROUP BY ship_year),
m AS (
  SELECT s.*, b.epoch, (epoch_ms(ts) // {_W_MS}) * 30 AS window_start_day,
         coalesce(make_timestamp(((epoch_ms(ts) // {_W_MS}) + 1) * {_W_MS} * 1000) <= wm, FALSE) AS is_late
  FROM s JOIN b USING (ship_year))"""

ORACLE_SQL: dict[str, str] = {
    "word_count_changelog": _WORD_COUNT,
    "late_rows_stream": _SHIPPED + """
SELECT o_orderpriority, l_orderkey, l_linenumber, l_partkey, l_suppkey, ts, ship_year, epoch FROM m WHERE is_late
""",
    "on_time_stream": _SHIPPED + """
SELECT o_orderpriority, window_start_day, COUNT(*) AS n,
       CAST(ROUND(SUM(CAST(l_quantity AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_quantity
FROM m WHERE NOT is_late GROUP BY 1, 2
""",
    "price_signals": f"""
SELECT user_id, signal, value, ts FROM (
  SELECT user_id, value, ts, {_SIGNAL_CASE.format(p="value")} AS signal
  FROM (SELECT user_id, value, ts,
               LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
        FROM events) t
) s
WHERE signal IS NOT NULL
""",
    "signals_kafka_value": f"""
SELECT CAST(user_id AS VARCHAR) AS key,
       '{{"user_id":' || user_id || ',"signal":"' || signal || '","value":' || CAST(value AS VARCHAR)
         || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '"}}' AS value
FROM (
  SELECT user_id, value, ts, {_SIGNAL_CASE.format(p="value")} AS signal
  FROM (SELECT user_id, value, ts,
               LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
        FROM events) t
) s
WHERE signal IS NOT NULL
""",
    "lag_price": """
SELECT event_id, user_id, ts, value,
       LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_value
FROM events
""",
    "upper_names": "SELECT UPPER(c_name) AS f0 FROM customer",
    "add_one": "SELECT o_orderkey + 1 AS id, o_orderstatus AS data FROM orders",
    "word_count": _WORD_COUNT,
    "word_count_udtf": _WORD_COUNT,
    "tumbling_avg": f"""
SELECT user_id, make_timestamp(w) AS window_start, make_timestamp(w + {_H_US}) AS window_end,
       COUNT(*) AS n, {_avg6('value')} AS avg_value
FROM (SELECT user_id, value, (epoch_us(ts) // {_H_US}) * {_H_US} AS w FROM events) t
GROUP BY user_id, w
""",
    "tumbling_sum": f"""
SELECT event_type, make_timestamp(w) AS window_start, make_timestamp(w + {_H_US}) AS window_end,
       CAST(SUM(epoch_us(ts) // 1000) AS BIGINT) AS sum_ts_ms
FROM (SELECT event_type, ts, (epoch_us(ts) // {_H_US}) * {_H_US} AS w FROM events) t
GROUP BY event_type, w
""",
    "sliding_avg": f"""
SELECT event_type, make_timestamp(w) AS window_start, make_timestamp(w + {2 * _H_US}) AS window_end,
       COUNT(*) AS n, {_avg6('value')} AS avg_value
FROM (SELECT event_type, value, (epoch_us(ts) // {_H_US // 2} - k) * {_H_US // 2} AS w
      FROM events CROSS JOIN range(4) AS r(k)) t
GROUP BY event_type, w
""",
    "session_stats": _sessions(str(6 * _H_US)),
    "session_native": _sessions(str(6 * _H_US)),
    "session_dynamic": _sessions(
        f"CASE event_type WHEN 'purchase' THEN 12 WHEN 'error' THEN 1 ELSE 6 END * {_H_US}"),
    "dedup_first": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) t
WHERE rn = 1
""",
    "dedup_unique": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) t
WHERE rn = 1
""",
    "dedup_duplicates": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) t
WHERE rn > 1
""",
    "dedup_expiring": _dedup_expiring("10 MINUTE"),
    "dedup_expiring_day": _dedup_expiring("1 DAY"),
    "watermark_trace": _REPLAY_TRACE + """
SELECT o_orderpriority, l_orderkey, l_linenumber, ts_ms, arrival_ms, wm_bounded_ms, wm_idle_ms FROM tr
""",
    "late_rows": _REPLAY_TRACE + f"""
SELECT o_orderpriority, l_orderkey, l_linenumber, ts_ms, arrival_ms, {_BOUNDS}, wm_bounded_ms
FROM tr WHERE {_LATE}
""",
    "on_time_tumbling": _REPLAY_TRACE + f"""
SELECT o_orderpriority, {_BOUNDS}, COUNT(*) AS n,
       CAST(ROUND(SUM(CAST(l_quantity AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_quantity
FROM tr WHERE NOT COALESCE({_LATE}, FALSE)
GROUP BY 1, 2, 3
""",
    "lag_watermark": f"""
SELECT o_orderpriority, l_orderkey, l_linenumber, ts_ms, arrival_ms, {_BOUNDS}, arrival_ms - {60 * _DAY_MS} AS wm_ms,
       ((ts_ms // {_W_MS}) * {_W_MS} + {_W_MS}) - 1 <= arrival_ms - {60 * _DAY_MS} AS is_late
FROM ({_REPLAY_SRC}) a
""",
    "json_roundtrip": """
SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
""",
}
