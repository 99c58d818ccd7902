"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables and runs over them whole. Column names
match the SQL in ``tideline.plans.oracle`` one for one. Parameters that the
reference states in seconds are scaled to the ``events`` table, which spans 30
days (see ``EVENTS_*`` below); the reference's own values are the library
defaults.

Averages and sums are computed in decimal and rounded half-up to 6 decimals,
so the comparison does not depend on summation order; the operators themselves
take any aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalar import from_json_record, plus_one, to_json_record
from tideline.operators.dedup import dedup_expiring, keep_first, split_duplicates
from tideline.operators.signals import price_signals, with_previous
from tideline.operators import partials
from tideline.operators.watermark import mark_late, system_lag_watermark, to_ms, watermark_trace
from tideline.operators.windows import session_intervals, session_intervals_native, sliding_panes, tumbling
from tideline.operators.wordcount import word_counts, word_counts_sql
from tideline.plans.replays import q_late_rows_stream, q_on_time_stream, q_word_count_changelog
from tideline.session import written
from tideline.sources.tables import documents, events, table

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries over `events` (30 days of ticks).
EVENTS_TUMBLE = "1 hour"
EVENTS_SLIDE_SIZE, EVENTS_SLIDE_STEP = "2 hours", "30 minutes"
EVENTS_SESSION_GAP = "6 hours"
# Per-row gap for the custom session window: hours by event type.
EVENTS_DYNAMIC_GAP_H = {"purchase": 12, "error": 1}
EVENTS_DYNAMIC_GAP_DEFAULT_H = 6
EVENTS_DEDUP_KEYS = ["user_id", "event_type"]
# Replays: a line item's event time is its order's date, and it arrives when it ships. Days instead of seconds.
REPLAY_OOO, REPLAY_IDLE, REPLAY_ALIGN, REPLAY_WINDOW = "90 days", "12 hours", "1 day", "30 days"
REPLAY_LAG = "60 days"



def _sum6(col: str):
    """SUM rounded to 6 decimals, exact in decimal arithmetic (see ``_avg6``)."""
    return F.round(F.sum(F.col(col).cast("decimal(28,8)")), 6).cast("double")


def _avg6(col: str):
    """AVG rounded half-up to 6 decimals, computed exactly in decimal arithmetic.

    A double average can sit exactly on a rounding tie (n = 64 gives
    x.xxxxxx5), and then the last bit of a summation-order-dependent double
    decides the digit. Summing in DECIMAL(38,8) and dividing in decimal (HALF_UP
    at 12 places, as Spark's decimal AVG does) removes that dependence.
    """
    return F.round(F.avg(F.col(col).cast("decimal(38,8)")), 6).cast("double")


def _divided(total, n):
    """Decimal quotient at 18 places, rounded half-up to 12 as Spark's decimal AVG does."""
    return F.round(total.cast("decimal(28,8)") / n.cast("decimal(10,0)"), 12)


def _mean6(col: str, name: str) -> partials.Agg:
    """``_avg6`` in two steps."""
    return partials.mapped(partials.mean(F.col(col).cast("decimal(38,8)"), name, _divided), lambda c: F.round(c, 6).cast("double"))


def _total6(col: str, name: str) -> partials.Agg:
    """``_sum6`` in two steps."""
    return partials.mapped(partials.total(F.col(col).cast("decimal(28,8)"), name), lambda c: F.round(c, 6).cast("double"))


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the order in which they ship, each with its order's date as event time."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                                    F.col("l_shipdate").alias("arrival"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderdate").alias("ts"))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


# --- signals (W1, W2, P3-P5) -------------------------------------------------

def q_price_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: BUY/SELL when a user's value moves >5% from the previous event."""
    ev = events(spark, sf_dir)
    return price_signals(ev, key="user_id", price="value", time="ts", tie="event_id")


def q_lag_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous value per user in event-time order (LAG ... OVER)."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    return with_previous(ev, "user_id", "value", "ts", tie="event_id", name="prev_value")


def q_signals_kafka_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship's signals as the sink writes them: Kafka ``(key, value)`` with ISO-8601 JSON."""
    from tideline.sinks.writers import to_kafka_records
    sig = q_price_signals(spark, sf_dir)
    return to_kafka_records(sig, ["user_id", "signal", "value", "ts"], key_col="user_id")


# --- projections and tables (P1, P2, S3, X1-X3) -------------------------------

def q_upper_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table -> temp view -> ``SELECT UPPER(f0)`` -> rows."""
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("f0"))
    return spark.sql("SELECT UPPER(f0) AS f0 FROM {names}", names=names)


def q_add_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT id + 1, data``: a sequence column shifted by one, payload passed."""
    o = table(spark, sf_dir, "orders")
    return o.select(plus_one(F.col("o_orderkey")).alias("id"), F.col("o_orderstatus").alias("data"))


# --- word count (P7, J1, A1, U1, U2) -------------------------------------------

def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts(documents(spark, sf_dir), "text")


def q_word_count_udtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts_sql(spark, documents(spark, sf_dir), "text")


# --- windows (A2, A3, T8-T11) ----------------------------------------------------

def q_tumbling_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, window_start, window_end, AVG over 1-hour tumbling windows."""
    ev = events(spark, sf_dir)
    return tumbling(ev, ["user_id"], "ts", EVENTS_TUMBLE,
                    [F.count(F.lit(1)).alias("n"), _avg6("value").alias("avg_value")])


def q_tumbling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of the epoch-ms time field per key and window (the reference's ``sum(1)``)."""
    ev = events(spark, sf_dir)
    ev = ev.withColumn("ts_ms", to_ms(ev, "ts"))
    return tumbling(ev, ["event_type"], "ts", EVENTS_TUMBLE, [F.sum("ts_ms").alias("sum_ts_ms")])


def q_sliding_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return sliding_panes(ev, ["event_type"], "ts", EVENTS_SLIDE_SIZE, EVENTS_SLIDE_STEP,
                         [partials.count("n"), _mean6("value", "avg_value")])


def q_session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return session_intervals(ev, ["user_id"], "ts", EVENTS_SESSION_GAP, [partials.count("n"), _total6("value", "total_value")])


def q_session_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions through Spark's ``session_window`` (the form streaming uses), over intervals."""
    ev = events(spark, sf_dir)
    return session_intervals_native(ev, ["user_id"], "ts", EVENTS_SESSION_GAP, [partials.count("n"), _total6("value", "total_value")])


def dynamic_gap_us():
    expr = F.lit(EVENTS_DYNAMIC_GAP_DEFAULT_H)
    cases = None
    for t, h in EVENTS_DYNAMIC_GAP_H.items():
        cases = (F.when(F.col("event_type") == t, F.lit(h)) if cases is None
                 else cases.when(F.col("event_type") == t, F.lit(h)))
    hours = cases.otherwise(expr) if cases is not None else expr
    return hours.cast("long") * F.lit(3_600_000_000)


def q_session_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions whose gap depends on the row (custom windowing)."""
    ev = events(spark, sf_dir)
    return session_intervals(ev, ["user_id"], "ts", dynamic_gap_us(), [partials.count("n"), _total6("value", "total_value")])


# --- dedup (T1-T3) ----------------------------------------------------------------

def q_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(events(spark, sf_dir), EVENTS_DEDUP_KEYS, "event_id", unique=True)


def q_dedup_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_duplicates(events(spark, sf_dir), EVENTS_DEDUP_KEYS, "event_id", "event_id")[0]


def q_dedup_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_duplicates(events(spark, sf_dir), EVENTS_DEDUP_KEYS, "event_id", "event_id")[1]


def q_dedup_expiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expiring dedup per user with the reference's 10-minute timers."""
    return dedup_expiring(events(spark, sf_dir), "user_id", "ts", "10 minutes", tie="event_id")


def q_dedup_expiring_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_expiring(events(spark, sf_dir), "user_id", "ts", "1 day", tie="event_id")


# --- watermarks and late rows (T4, T5, T7, T12, T13) ----------------------------------

def _trace(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    # The join is done once; the trace reads its rows up to three times.
    rows = written(replayed(spark, sf_dir), "replayed", compression="zstd")
    return watermark_trace(rows, "o_orderpriority", "ts", "arrival",
                           tie=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                           out_of_orderness=REPLAY_OOO, idle=REPLAY_IDLE, align=REPLAY_ALIGN, keep=["o_orderpriority", *keep])


def q_watermark_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    tr = _trace(spark, sf_dir, "l_orderkey", "l_linenumber")
    return tr.select("o_orderpriority", "l_orderkey", "l_linenumber", "ts_ms", "arrival_ms", "wm_bounded_ms", "wm_idle_ms")


def q_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a 30-day tumbling window would drop: their window fired before they arrived."""
    m = mark_late(_trace(spark, sf_dir, "l_orderkey", "l_linenumber"), "ts_ms", "wm_bounded_ms", REPLAY_WINDOW)
    return m.filter("is_late").select("o_orderpriority", "l_orderkey", "l_linenumber", "ts_ms", "arrival_ms",
                                      "window_start_ms", "window_end_ms", "wm_bounded_ms")


def q_on_time_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed result the stream would emit: late rows silently dropped."""
    m = mark_late(_trace(spark, sf_dir, "l_quantity"), "ts_ms", "wm_bounded_ms", REPLAY_WINDOW)
    return (m.filter(~F.col("is_late"))
             .groupBy("o_orderpriority", "window_start_ms", "window_end_ms")
             .agg(F.count(F.lit(1)).alias("n"), _sum6("l_quantity").alias("total_quantity")))


def q_lag_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing-time-lag watermark: a row is late when ``arrival - lag`` passed its window."""
    w = system_lag_watermark(replayed(spark, sf_dir), "arrival", REPLAY_LAG)
    w = w.withColumn("ts_ms", to_ms(w, "ts")).withColumn("arrival_ms", to_ms(w, "arrival"))
    m = mark_late(w, "ts_ms", "wm_ms", REPLAY_WINDOW)
    return m.select("o_orderpriority", "l_orderkey", "l_linenumber", "ts_ms", "arrival_ms", "window_start_ms",
                    "window_end_ms", "wm_ms", "is_late")


# --- JSON (P8) ----------------------------------------------------------------------

def q_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode ``props``; encode a record as ISO-8601 JSON (ms precision); decode it back."""
    ev = events(spark, sf_dir)
    dec = ev.withColumn("k", from_json_record(F.col("props"), "k bigint").getField("k"))
    enc = dec.select(to_json_record("event_id", "ts", "value", "k").alias("json"))
    back = enc.select(from_json_record(F.col("json"), "event_id bigint, ts timestamp_ntz, value double, k bigint",
                                       "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("r"))
    return back.select("r.event_id", "r.ts", "r.value", "r.k")


QUERIES: dict[str, Query] = {
    "price_signals": q_price_signals,
    "lag_price": q_lag_price,
    "signals_kafka_value": q_signals_kafka_value,
    "upper_names": q_upper_names,
    "add_one": q_add_one,
    "word_count": q_word_count,
    "word_count_udtf": q_word_count_udtf,
    "tumbling_avg": q_tumbling_avg,
    "tumbling_sum": q_tumbling_sum,
    "sliding_avg": q_sliding_avg,
    "session_stats": q_session_stats,
    "session_dynamic": q_session_dynamic,
    "session_native": q_session_native,
    "dedup_first": q_dedup_first,
    "dedup_unique": q_dedup_unique,
    "dedup_duplicates": q_dedup_duplicates,
    "dedup_expiring": q_dedup_expiring,
    "dedup_expiring_day": q_dedup_expiring_day,
    "watermark_trace": q_watermark_trace,
    "late_rows": q_late_rows,
    "on_time_tumbling": q_on_time_tumbling,
    "lag_watermark": q_lag_watermark,
    "json_roundtrip": q_json_roundtrip,
    "word_count_changelog": q_word_count_changelog,
    "late_rows_stream": q_late_rows_stream,
    "on_time_stream": q_on_time_stream,
}
