"""Stream = batch: replay files as micro-batches and compare with the batch forms."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import time
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001, bag
from tideline.operators.dedup import keep_first
from tideline.operators.signals import price_signals, with_previous
from tideline.operators.windows import tumbling
from tideline.session import checkpoint_location
from tideline.sinks.writers import memory, parquet_batch_writer, two_sinks
from tideline.sources import literals
from tideline.sources.files import read_csv, read_parquet_stream
from tideline.sources.tables import events
from tideline.streaming.dedup import stream_dedup_expiring, stream_keep_first, stream_tag_duplicates
from tideline.streaming.signals import stream_price_signals, stream_with_previous
from tideline.streaming.windows import stream_window_aggregate, stream_word_counts


@pytest.fixture(scope="module")
def event_files(spark):
    """events sf0.001 as 5 time-ordered parquet files (5 micro-batches)."""
    d = os.path.join(tempfile.mkdtemp(prefix="tideline-ev-"), "events")
    events(spark, SF001).repartitionByRange(5, "event_id").sortWithinPartitions("event_id").write.parquet(d)
    # The file source takes files oldest first: order modification times by part number.
    parts = sorted(f for f in os.listdir(d) if f.endswith(".parquet"))
    now = time.time()
    for i, f in enumerate(parts):
        os.utime(os.path.join(d, f), (now - 100 + i, now - 100 + i))
    return d


def _stream(spark, path, files_per_trigger=1):
    schema = events(spark, SF001).schema
    return read_parquet_stream(spark, path, schema, files_per_trigger)


def _run(df, name, mode="append"):
    q = memory(df, name, mode, availableNow=True)
    q.awaitTermination(300)
    return df.sparkSession.sql(f"SELECT * FROM {name}")


def test_stream_keep_first_equals_batch(spark, event_files):
    keys = ["user_id", "event_type"]
    got = _run(stream_keep_first(_stream(spark, event_files), keys, "event_id"), "t1_first").collect()
    want = keep_first(events(spark, SF001), keys, "event_id").collect()
    assert bag(got) == bag(want)


@pytest.mark.parametrize("engine", ["group_state", "state_v2"])
def test_stream_lag_equals_batch(spark, event_files, engine):
    s = stream_with_previous(_stream(spark, event_files), "user_id", "value", "ts", tie="event_id",
                             delay="5 seconds", engine=engine)
    got = {r.event_id: r.prev for r in _run(s, "t6_lag_" + engine).collect()}
    batch = with_previous(events(spark, SF001), "user_id", "value", "ts", tie="event_id").collect()
    want = {r.event_id: r.prev for r in batch}
    max_ts = max(r.ts for r in batch)
    held = {r.event_id for r in batch if (max_ts - r.ts).total_seconds() <= 5}
    assert set(got) | held == set(want)  # only rows behind the final watermark are still held
    assert all(got[i] == want[i] for i in got)
    assert len(got) >= len(want) - len(held)


def test_stream_signals_equal_batch(spark, event_files):
    s = stream_price_signals(_stream(spark, event_files), "user_id", "value", "ts", tie="event_id")
    got = {(r.user_id, r.value, r.signal) for r in _run(s, "t6_sig").collect()}
    want = {(r.user_id, r.value, r.signal)
            for r in price_signals(events(spark, SF001), "user_id", "value", "ts", tie="event_id").collect()}
    assert got <= want and len(want - got) <= 2


def test_stream_tumbling_equals_batch(spark, event_files):
    aggs = [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("s")]
    s = stream_window_aggregate(_stream(spark, event_files), ["event_type"], "ts", "1 hour", aggs, delay="5 seconds")
    got = _run(s, "t8_tumble").collect()
    want = tumbling(events(spark, SF001), ["event_type"], "ts", "1 hour", aggs).collect()
    last_end = max(r.window_end for r in want)
    want_closed = [tuple(r) for r in want if r.window_end < last_end]
    got_t = [(r.event_type, r.window_start.replace(tzinfo=None), r.window_end.replace(tzinfo=None), r.n, r.s)
             for r in got]
    assert bag(want_closed) == bag([g for g in got_t if g[2] < last_end])


def test_stream_word_count_final_state(spark):
    d = tempfile.mkdtemp(prefix="tideline-wc-")
    for i, chunk in enumerate(["Hi\nHello Hi\n", "Hi\nHey\nHi\n"]):
        with open(os.path.join(d, f"part{i}.csv"), "w") as f:
            f.write(chunk)
    s = stream_word_counts(read_csv(spark, d, "word string", stream=True, max_files_per_trigger=1), "word")
    out = _run(s, "a1_wc", mode="complete").collect()
    assert {r.word: r["count"] for r in out} == {"Hi": 4, "Hello": 1, "Hey": 1}


def test_side_output_two_sinks(spark):
    base = tempfile.mkdtemp(prefix="tideline-side-")
    src = os.path.join(base, "orders")
    o = literals.orders(spark)
    o.filter("seq < 3").coalesce(1).write.parquet(os.path.join(src, "b0"))
    o.filter("seq >= 3").coalesce(1).write.parquet(os.path.join(src, "b1"))
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    tagged = stream_tag_duplicates(stream, ["orderId"], "seq")
    main, side = os.path.join(base, "unique"), os.path.join(base, "dups")
    q = (tagged.writeStream.foreachBatch(two_sinks("is_duplicate", parquet_batch_writer(main), parquet_batch_writer(side)))
         .option("checkpointLocation", checkpoint_location(spark, "side")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert sorted(r.orderId for r in spark.read.parquet(main).collect()) == [1, 2, 3, 4]
    assert sorted(r.orderId for r in spark.read.parquet(side).collect()) == [1, 3]


def test_stream_expiring_dedup_processing_time(spark):
    base = tempfile.mkdtemp(prefix="tideline-exp-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    o = literals.orders(spark)
    schema = o.schema
    name = "t3_" + uuid.uuid4().hex[:8]

    def drop_file(tag):
        o.coalesce(1).write.parquet(os.path.join(base, "stage", tag))
        f = [x for x in os.listdir(os.path.join(base, "stage", tag)) if x.endswith(".parquet")][0]
        os.rename(os.path.join(base, "stage", tag, f), os.path.join(src, f"{tag}.parquet"))

    def rows_in() -> int:
        return sum(p.get("numInputRows", 0) for p in q.recentProgress)

    def wait_until(pred, timeout=90.0):
        end = time.time() + timeout
        while time.time() < end:
            if pred():
                return True
            time.sleep(0.25)
        return False

    drop_file("a")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    # processAllAvailable() does not return for processing-time timers; poll progress instead.
    q = memory(stream_dedup_expiring(stream, ["orderId"], "seq", ttl="10 seconds"), name,
               processingTime="500 milliseconds")
    try:
        assert wait_until(lambda: rows_in() >= 6)
        drop_file("b")  # within the ttl: all duplicates
        assert wait_until(lambda: rows_in() >= 12)
        time.sleep(11)  # timers fire, state cleared
        drop_file("c")
        assert wait_until(lambda: rows_in() >= 18)
        assert wait_until(lambda: spark.sql(f"SELECT count(*) FROM {name}").first()[0] >= 8, 30)
    finally:
        q.stop()
    got = sorted(r.orderId for r in spark.sql(f"SELECT * FROM {name}").collect())
    assert got == [1, 1, 2, 2, 3, 3, 4, 4]


def test_stream_generators(spark):
    from tideline.sources import generators as gen
    s = gen.incremental(gen.stream_sequence(spark, rows_per_batch=5))
    q = memory(s, "s8_inc", processingTime="200 milliseconds")
    try:
        end = time.time() + 60
        while time.time() < end and spark.sql("SELECT count(*) FROM s8_inc").first()[0] < 15:
            time.sleep(0.25)
    finally:
        q.stop()
    rows = spark.sql("SELECT * FROM s8_inc ORDER BY n").collect()
    assert [r.n for r in rows[:15]] == list(range(15))
    assert rows[3].name == "Event3" and rows[3].ts_ms - rows[0].ts_ms == 3000


def test_system_lag_late_filter(spark):
    from tideline.streaming.watermark import drop_system_lag_late
    df = spark.createDataFrame([(1, "2024-01-01 00:00:01"), (2, "2024-01-01 00:00:09"), (3, "2024-01-01 00:00:12")],
                               "i int, t string").withColumn("t", F.col("t").cast("timestamp"))
    now = F.lit("2024-01-01 00:01:00").cast("timestamp")
    # lag 50 s: wm = 00:00:10; window [0,5) and [5,10) end-1ms <= wm are late; [10,15) is not.
    kept = drop_system_lag_late(df, "t", "5 seconds", "50 seconds", now=now).collect()
    assert [r.i for r in kept] == [3]


def test_stream_tag_duplicates_equals_batch(spark, event_files):
    from tideline.operators.dedup import tag_duplicates
    keys = ["user_id", "event_type"]
    s = stream_tag_duplicates(_stream(spark, event_files), keys, "event_id")
    got = {r.event_id: r.is_duplicate for r in _run(s, "t2_tag").collect()}
    want = {r.event_id: r.is_duplicate
            for r in tag_duplicates(events(spark, SF001), keys, "event_id", "event_id").collect()}
    assert got == want


def test_stream_sessions_and_sliding_equal_batch(spark, event_files):
    from tideline.operators.windows import sessionize, sliding
    from tideline.streaming.windows import stream_session_aggregate
    aggs = [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("s")]
    ev = events(spark, SF001)
    max_ts = ev.agg(F.max("ts")).first()[0]

    def closed(rows, horizon):
        return bag([(r[0], r.window_start.replace(tzinfo=None), r.window_end.replace(tzinfo=None), r.n, r.s)
                    for r in rows if r.window_end.replace(tzinfo=None) < horizon])

    s = stream_session_aggregate(_stream(spark, event_files), ["user_id"], "ts", "6 hours", aggs, delay="5 seconds")
    got = _run(s, "t10_sess").collect()
    want = sessionize(ev, ["user_id"], "ts", "6 hours", aggs, tie="event_id").collect()
    horizon = max_ts - dt.timedelta(hours=7)
    assert closed(got, horizon) == closed(want, horizon) and len(got) > 0

    s2 = stream_window_aggregate(_stream(spark, event_files), ["event_type"], "ts", "2 hours", aggs,
                                 slide="30 minutes", delay="5 seconds")
    got2 = _run(s2, "t9_slide").collect()
    want2 = sliding(ev, ["event_type"], "ts", "2 hours", "30 minutes", aggs).collect()
    horizon2 = max_ts - dt.timedelta(hours=1)
    assert closed(got2, horizon2) == closed(want2, horizon2)


def test_append_to_table(spark):
    from tideline.sinks.writers import append_to_table
    from tideline.sources import generators as gen
    loc = tempfile.mkdtemp(prefix="tideline-sink-")
    spark.sql("DROP TABLE IF EXISTS tideline_sink_table")
    spark.sql(f"CREATE TABLE tideline_sink_table (id INT, data STRING) USING parquet LOCATION '{loc}'")
    src = gen.sequence_table(spark, 1, 10)
    append_to_table(src.select((F.col("id") + 1).alias("id"), "data"), "tideline_sink_table")
    assert sorted(r.id for r in spark.table("tideline_sink_table").collect()) == list(range(2, 12))


def test_stream_udtf_word_count(spark):
    from tideline.operators.wordcount import word_counts_sql
    d = tempfile.mkdtemp(prefix="tideline-udtf-")
    for i, chunk in enumerate(["Hi\nHello Hi\n", "Hi\nHey\nHi\n"]):
        with open(os.path.join(d, f"part{i}.csv"), "w") as f:
            f.write(chunk)
    lines = read_csv(spark, d, "word string", stream=True, max_files_per_trigger=1)
    counts = word_counts_sql(spark, lines, "word")
    out = _run(counts, "j1_udtf_stream", mode="complete").collect()
    assert {r.word: r["count"] for r in out} == {"Hi": 4, "Hello": 1, "Hey": 1}


def test_stream_dynamic_gap_sessions_equal_batch(spark, event_files):
    from tideline.operators.windows import sessionize
    from tideline.plans.queries import dynamic_gap_us
    from tideline.streaming.windows import stream_session_aggregate
    aggs = [F.count(F.lit(1)).alias("n")]
    gap = (F.when(F.col("event_type") == "purchase", F.lit("12 hours"))
            .when(F.col("event_type") == "error", F.lit("1 hours")).otherwise(F.lit("6 hours")))
    got = _run(stream_session_aggregate(_stream(spark, event_files), ["user_id"], "ts", gap, aggs, delay="5 seconds"),
               "t11_sess").collect()
    ev = events(spark, SF001)
    want = sessionize(ev, ["user_id"], "ts", dynamic_gap_us(), aggs, tie="event_id").collect()
    horizon = ev.agg(F.max("ts")).first()[0] - dt.timedelta(hours=13)

    def closed(rows):
        return bag([(r.user_id, r.window_start.replace(tzinfo=None), r.window_end.replace(tzinfo=None), r.n)
                    for r in rows if r.window_end.replace(tzinfo=None) < horizon])
    assert closed(got) == closed(want) and len(got) > 0


def test_stream_lag_drops_late_rows(spark):
    base = tempfile.mkdtemp(prefix="tideline-late-")
    src = os.path.join(base, "in")
    rows = [[("A", "2024-01-01 00:00:00", 1, 10.0), ("A", "2024-01-01 00:01:00", 2, 11.0)],
            [("A", "2024-01-01 00:00:30", 3, 99.0), ("A", "2024-01-01 00:02:00", 4, 12.0)],  # 00:00:30 is late
            [("A", "2024-01-01 00:10:00", 5, 13.0)]]
    now = time.time()
    for i, chunk in enumerate(rows):
        df = spark.createDataFrame(chunk, "sym string, t string, i long, p double") \
            .withColumn("t", F.col("t").cast("timestamp"))
        d = os.path.join(base, "stage", str(i))
        df.coalesce(1).write.parquet(d)
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        os.makedirs(src, exist_ok=True)
        os.rename(os.path.join(d, f), os.path.join(src, f"{i}.parquet"))
        os.utime(os.path.join(src, f"{i}.parquet"), (now - 100 + i, now - 100 + i))
    stream = read_parquet_stream(spark, src, "sym string, t timestamp, i long, p double", 1)
    out = stream_with_previous(stream, "sym", "p", "t", tie="i", delay="5 seconds")
    got = {r.i: r.prev for r in _run(out, "t6_late").collect()}
    assert 3 not in got                      # behind the watermark (00:00:55) when it arrived
    assert got[1] is None and got[2] == 10.0 and got[4] == 11.0


def _files(spark, chunks, schema, order=None):
    """One parquet file per chunk, modified in the order given (file number by default)."""
    base = tempfile.mkdtemp(prefix="tideline-files-")
    src, now = os.path.join(base, "in"), time.time()
    os.makedirs(src)
    for i, chunk in enumerate(chunks):
        d = os.path.join(base, "stage", str(i))
        spark.createDataFrame(chunk, schema).coalesce(1).write.parquet(d)
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        os.rename(os.path.join(d, f), os.path.join(src, f"{i}.parquet"))
        t = now - 100 + (order[i] if order else i)
        os.utime(os.path.join(src, f"{i}.parquet"), (t, t))
    return src


def test_stream_keep_first_takes_the_smallest_arrival_of_shuffled_files(spark):
    import random
    rows = [(i % 5, i) for i in range(40)]
    random.Random(1).shuffle(rows)
    src = _files(spark, [rows[i * 5:i * 5 + 5] for i in range(8)], "k int, seq int")
    stream = read_parquet_stream(spark, src, "k int, seq int", 8)  # one micro-batch
    got = _run(stream_keep_first(stream, ["k"], "seq"), "t1_shuffled").collect()
    assert sorted((r.k, r.seq) for r in got) == [(k, k) for k in range(5)]


def test_stream_keep_first_goes_on_after_a_restart(spark):
    base = tempfile.mkdtemp(prefix="tideline-restart-")
    src, out = os.path.join(base, "in"), []
    os.makedirs(src)

    def run(i, rows):
        staged = _files(spark, [rows], "orderId int, seq int")
        os.rename(os.path.join(staged, "0.parquet"), os.path.join(src, f"{i}.parquet"))
        from tideline.plans.jobs import dedup_job
        stream = read_parquet_stream(spark, src, "orderId int, seq int", 1)
        q = dedup_job(stream, mode="first", job="restarted", availableNow=True,
                      main=lambda b, _: out.extend((r.orderId, r.seq) for r in b.collect()))
        q.awaitTermination(300)

    run(0, [(1, 0), (2, 1), (1, 2)])
    run(1, [(2, 3), (3, 4), (None, 5), (1, 6)])
    assert sorted(out, key=str) == [(1, 0), (2, 1), (3, 4), (None, 5)]


@pytest.mark.parametrize("engine", ["group_state", "state_v2"])
def test_stream_lag_survives_bad_rows(spark, engine):
    """Null keys, times and prices: the stream equals the batch over the valid rows."""
    from tideline.streaming.signals import split_valid
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s) if s is not None else None
    rows = [[("A", t(0), 1, 10.0), (None, t(1), 2, 5.0), ("A", None, 3, 7.0), ("A", t(2), 4, None)],
            [("A", t(3), 5, 11.5), ("B", t(3), 6, float("nan")), ("B", t(4), 7, 2.0), ("A", t(4), 8, 9.0)],
            [("Z", t(600), 9, 1.0)]]
    schema = "sym string, t timestamp, i long, p double"
    src = _files(spark, rows, schema)
    valid, rejected = split_valid(read_parquet_stream(spark, src, schema, 1), "sym", "t")
    q = memory(stream_with_previous(valid, "sym", "p", "t", tie="i", engine=engine), f"t6_bad_{engine}", availableNow=True)
    q.awaitTermination(300)
    got = {r.i: repr((r.p, r.prev)) for r in spark.sql(f"SELECT * FROM t6_bad_{engine}").collect()}
    batch = spark.createDataFrame([r for c in rows for r in c if r[0] and r[1]], schema)
    want = {r.i: repr((r.p, r.prev)) for r in with_previous(batch, "sym", "p", "t", tie="i", name="prev").collect()}
    assert got == {i: v for i, v in want.items() if i != 9}
    counted = [p["observedMetrics"]["input"] for p in q.recentProgress if "input" in p["observedMetrics"]]
    assert sum(c["rejected"] for c in counted) == 2 and sum(c["valid"] for c in counted) == 7
    assert sorted(r.i for r in _run(rejected, f"t6_rejected_{engine}").collect()) == [2, 3]


@pytest.mark.parametrize("engine", ["group_state", "state_v2"])
def test_stream_lag_counts_and_keeps_late_rows(spark, engine):
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    schema = "sym string, t timestamp, i long, p double"
    src = _files(spark, [[("A", t(0), 1, 1.0), ("A", t(60), 2, 2.0)], [("A", t(30), 3, 9.0), ("A", t(120), 4, 4.0)],
                         [("A", t(600), 5, 5.0)]], schema)
    stream = read_parquet_stream(spark, src, schema, 1)
    q = memory(stream_with_previous(stream, "sym", "p", "t", tie="i", engine=engine, emit_late=True), f"t6_late_{engine}",
               availableNow=True)
    q.awaitTermination(300)
    got = {r.i: (r.prev, r.late) for r in spark.sql(f"SELECT * FROM t6_late_{engine}").collect()}
    assert got == {1: (None, False), 2: (1.0, False), 3: (None, True), 4: (2.0, False)}
    counted = [p["observedMetrics"]["lag"]["late"] for p in q.recentProgress if "lag" in p["observedMetrics"]]
    assert sum(counted) == 1


def test_print_sink_prints_every_row(spark):
    from tideline.sinks.writers import console, print_table
    lines: list[str] = []
    print_table(spark.range(1000), "Order", lines.append)
    assert sorted(lines) == sorted(f"Order> {i}" for i in range(1000))
    src = _files(spark, [[(i,) for i in range(1000)]], "id int")
    streamed: list[str] = []
    q = console(read_parquet_stream(spark, src, "id int"), "print-all", write=streamed.append, availableNow=True)
    q.awaitTermination(300)
    assert sorted(map(int, streamed)) == list(range(1000))


def test_jobs_need_a_shared_checkpoint_folder(spark, monkeypatch):
    from tideline import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
    assert session.checkpoint_location(spark, "a-job") == session.checkpoint_location(spark, "a-job")
    with pytest.raises(ValueError, match="name"):
        session.checkpoint_location(spark, "../elsewhere")
