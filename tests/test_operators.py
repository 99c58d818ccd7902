"""Operator-level checks against Spark built-ins and Python."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF001, SF01, bag
from tideline.functions.scalar import split_whitespace
from tideline.operators.dedup import keep_first, tag_duplicates
from tideline.operators.windows import session_window_native, sessionize, sliding, tumbling
from tideline.operators.wordcount import word_counts, word_counts_sql
from tideline.plans.queries import dynamic_gap_us
from tideline.sources import generators as gen
from tideline.sources.tables import documents, events


def _sessions_both(spark, gap, native_gap, split):
    ev = events(spark, SF01)
    aggs = [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("s")]
    ours = sessionize(ev, ["user_id"], "ts", gap, aggs, tie="event_id", split=split).collect()
    native = session_window_native(ev, ["user_id"], "ts", native_gap, aggs).collect()
    return ours, native


def test_sessions_match_spark_session_window(spark):
    for split in (None, "2 days"):
        ours, native = _sessions_both(spark, "6 hours", "6 hours", split)
        assert bag(ours) == bag(native)


def test_dynamic_gap_sessions_match_spark(spark):
    native_gap = F.when(F.col("event_type") == "purchase", F.lit("12 hours")) \
        .when(F.col("event_type") == "error", F.lit("1 hours")).otherwise(F.lit("6 hours"))
    for split in (None, "3 days"):
        ours, native = _sessions_both(spark, dynamic_gap_us(), native_gap, split)
        assert bag(ours) == bag(native)


def test_tumbling_and_sliding_cover_rows(spark):
    ev = events(spark, SF01)
    t = tumbling(ev, ["event_type"], "ts", "1 hour", [F.count(F.lit(1)).alias("n")])
    assert t.agg(F.sum("n")).first()[0] == 10000
    s = sliding(ev, ["event_type"], "ts", "2 hours", "30 minutes", [F.count(F.lit(1)).alias("n")])
    assert s.agg(F.sum("n")).first()[0] == 40000
    row = t.first()
    assert (row.window_end - row.window_start).total_seconds() == 3600


def test_split_matches_python_on_every_bmp_char(spark):
    chars = [chr(c) for c in range(1, 0x10000) if not (0xD800 <= c <= 0xDFFF)]
    text = "a".join(chars)
    want = text.split()
    got = spark.createDataFrame([(text,)], "t string").select(split_whitespace(F.col("t")).alias("w")).first().w
    assert got == want
    edge = "  lead　mid\x1ctrail  "
    got = spark.createDataFrame([(edge,)], "t string").select(split_whitespace(F.col("t")).alias("w")).first().w
    assert got == edge.split()


def test_udtf_matches_native_word_count(spark):
    docs = documents(spark, SF001)
    a = word_counts(docs, "text").collect()
    b = word_counts_sql(spark, docs, "text").collect()
    assert bag(a) == bag(b)
    want = {}
    for r in docs.select("text").collect():
        for w in (r.text or "").split():
            want[w] = want.get(w, 0) + 1
    assert {r.word: r["count"] for r in a} == want


def test_tag_duplicates_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4), (2, 5)], "k int, i int")
    got = {r.i: r.is_duplicate for r in tag_duplicates(df, "k", "i", "i").collect()}
    assert got == {1: False, 2: True, 3: False, 4: True, 5: False}


def test_generators(spark):
    seq = spark.range(0, 100).withColumnRenamed("id", "n")
    inc = gen.incremental(seq).orderBy("n").collect()
    assert inc[3].name == "Event3" and inc[3].ts_ms - inc[2].ts_ms == 1000 and inc[3].arrival_ms - inc[2].arrival_ms == 500
    idle = gen.idle_cycle(seq).orderBy("n").collect()
    assert idle[20].name == "Event0" and idle[20].arrival_ms - idle[19].arrival_ms == 51_000
    assert idle[20].ts_ms - idle[19].ts_ms == 1000
    rnd = gen.out_of_order(seq).collect()
    assert all(0 <= r.arrival_ms - r.ts_ms < 10_000 for r in rnd)
    assert len({r.name for r in rnd}) > 50


def test_scale_conf():
    from tideline.session import scale_conf
    big = scale_conf(100 * 10 ** 12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) * (256 << 20) >= 100 * 10 ** 12
    assert big["spark.sql.files.maxPartitionBytes"] == str(512 << 20)
    small = scale_conf(10 ** 6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_edges_window_end_session_gap_empty_line_negative_duration(spark):
    import pytest as _pytest
    from tideline.functions.time import duration_us
    from tideline.operators.wordcount import words
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 01:00:00"), (3, "2024-01-01 01:59:59.999999")],
                               "i int, t string").withColumn("t", F.col("t").cast("timestamp_ntz")).withColumn("k", F.lit(1))
    # A row exactly at a window end opens the next window: [start, end).
    t = {r.window_start.hour: r.n for r in tumbling(df, ["k"], "t", "1 hour", [F.count(F.lit(1)).alias("n")]).collect()}
    assert t == {0: 1, 1: 2}
    # A row exactly one gap after the previous stays in the session (Spark's rule); one microsecond more splits it.
    s = sessionize(df, ["k"], "t", "1 hour", [F.count(F.lit(1)).alias("n")], tie="i").collect()
    assert [r.n for r in s] == [3]
    s2 = sessionize(df, ["k"], "t", 3_599_999_999, [F.count(F.lit(1)).alias("n")], tie="i").collect()
    assert sorted(r.n for r in s2) == [1, 2]  # gap 1 h - 1 us: 0:00 -> 1:00 splits, 1:00 -> 1:59:59.999999 stays
    # Empty and blank lines produce no words (the lateral join drops the row).
    lines = spark.createDataFrame([("",), ("   ",), (None,), (" a  b ",)], "line string")
    assert sorted(r.word for r in words(lines, "line").collect()) == ["a", "b"]
    # Negative durations are rejected, as the reference rejects negative lateness/idleness.
    with _pytest.raises(ValueError):
        duration_us("-5 seconds")
    with _pytest.raises(ValueError):
        duration_us(-1)


def test_bucketed_table_avoids_shuffle(spark):
    import tempfile
    from tideline.operators.signals import with_previous
    from tideline.sources.tables import save_bucketed
    ev = events(spark, SF01)
    save_bucketed(ev, "tideline_events_by_user", ["user_id"], 8, tempfile.mkdtemp(prefix="tideline-bkt-"),
                  sort_by=["ts", "event_id"])
    t = spark.table("tideline_events_by_user")
    out = with_previous(t, "user_id", "value", "ts", tie="event_id", split=None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert bag(out.collect()) == bag(with_previous(ev, "user_id", "value", "ts", tie="event_id", split=None).collect())


def test_tag_duplicates_fast_path_equals_general(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (1, 3, "c"), (2, 5, "d"), (2, 4, "e"), (3, None, "f")],
                               "k int, i int, tag string")
    fast = {r.tag: r.is_duplicate for r in tag_duplicates(df, "k", "i", "i").collect()}
    general = {r.tag: r.is_duplicate for r in tag_duplicates(df, "k", ["i", "tag"], "i").collect()}
    assert fast == general == {"a": False, "b": True, "c": True, "d": True, "e": False, "f": False}


def test_keep_first_unique_equals_general(spark):
    ev = events(spark, SF01)
    keys = ["user_id", "event_type"]
    fast = keep_first(ev, keys, "event_id", unique=True)
    assert bag(fast.collect()) == bag(keep_first(ev, keys, "event_id").collect())
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
