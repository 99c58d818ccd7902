"""Changelog counts, late rows, several sources and joint commits on real streams."""

from __future__ import annotations

import datetime as dt
import os
import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import bag
from test_streaming import _files
from tideline.operators.wordcount import word_counts
from tideline.session import checkpoint_location
from tideline.sinks.writers import committed_epochs, joint_sinks, late_sinks, memory, parquet_batch_writer, read_committed
from tideline.sources.files import read_parquet_stream
from tideline.streaming.changelog import replayed_counts, stream_changelog_counts, stream_word_changelog
from tideline.streaming.signals import stream_with_previous
from tideline.streaming.watermark import dropped_by_watermark, union_sources
from tideline.streaming.windows import stream_window_aggregate


def at(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def lines(n, seed):
    rng = random.Random(seed)
    return [(" ".join(rng.choice(["Hi", "Hello", "Hey", "the", "the", "the", f"w{rng.randrange(400)}"]) for _ in range(rng.randrange(12))),)
            for _ in range(n)]


def test_replaying_the_changelog_gives_the_word_count(spark):
    chunks = [lines(120, i) for i in range(5)]
    src = _files(spark, chunks, "line string")
    q = memory(stream_word_changelog(read_parquet_stream(spark, src, "line string", 1), "line"), "a1_changelog", availableNow=True)
    q.awaitTermination(300)
    log = spark.sql("SELECT * FROM a1_changelog")
    assert log.columns == ["op", "word", "count"]
    whole = spark.createDataFrame([r for c in chunks for r in c], "line string")
    assert bag(replayed_counts(log, "word").collect()) == bag(word_counts(whole, "line").collect())
    # Every word is inserted once, and each retracted row was put in place before.
    ops = Counter((r.op, r.word) for r in log.collect())
    assert all(n == 1 for (op, _), n in ops.items() if op == "+I")
    assert all(ops["-U", w] == n for (op, w), n in ops.items() if op == "+U")
    assert max(n for (op, _), n in ops.items() if op == "+U") == 4  # five batches: one insert, four updates


def test_changelog_of_the_reference_lines(spark):
    src = _files(spark, [[("Hi",), ("Hello",), ("Hi",)], [("Hey",), ("Hi",)]], "word string")
    q = memory(stream_word_changelog(read_parquet_stream(spark, src, "word string", 1), "word"), "a1_lines", availableNow=True)
    q.awaitTermination(300)
    assert bag(spark.sql("SELECT op, word, `count` FROM a1_lines").collect()) == Counter(
        [("+I", "Hi", 2), ("+I", "Hello", 1), ("+I", "Hey", 1), ("-U", "Hi", 2), ("+U", "Hi", 3)])


def test_changelog_goes_on_after_a_restart(spark):
    src, out = _files(spark, [[(1,), (2,), (None,)]], "k int"), os.path.join(tempfile.mkdtemp(prefix="tideline-log-"), "out")

    def run():
        log = stream_changelog_counts(read_parquet_stream(spark, src, "k int", 1), "k")
        q = (log.writeStream.foreachBatch(parquet_batch_writer(out)).option("checkpointLocation", checkpoint_location(spark, "changelog-restart"))
             .trigger(availableNow=True).start())
        q.awaitTermination(300)

    run()
    more = _files(spark, [[(1,), (None,), (None,), (3,)]], "k int")
    os.rename(os.path.join(more, "0.parquet"), os.path.join(src, "1.parquet"))
    run()
    log = spark.read.parquet(out)
    assert bag(replayed_counts(log, "k").collect()) == Counter({(1, 2): 1, (2, 1): 1, (None, 3): 1, (3, 1): 1})
    assert bag(log.filter("op = '-U'").select("k", "count").collect()) == Counter({(1, 1): 1, (None, 1): 1})


def test_keys_of_any_type_keep_their_value(spark):
    """Times that differ by a microsecond are two keys, in the changelog and in the dedup; nulls, NaN and blanks too."""
    from tideline.streaming.dedup import stream_keep_first
    for n, (kind, values) in enumerate({
            "timestamp": [at(0), at(0) + dt.timedelta(microseconds=1), None, at(0)],
            "timestamp_ntz": [at(0), at(0) + dt.timedelta(microseconds=7), None, at(0)],
            "double": [0.1, float("nan"), None, 1e-300, float("nan"), 0.1],
            "string": ["", " ", None, "a\"b\n", "é", "", "null"],
            "decimal(30,10)": [None, 1, 2, 1]}.items()):
        from decimal import Decimal
        rows = [(Decimal(v).quantize(Decimal("1e-10")) if kind.startswith("dec") and v is not None else v, i) for i, v in enumerate(values)]
        src = _files(spark, [rows[:2], rows[2:]], f"k {kind}, i int")
        read = lambda: read_parquet_stream(spark, src, f"k {kind}, i int", 1)  # noqa: E731, B023
        memory(stream_changelog_counts(read(), "k"), f"keys_log_{n}", availableNow=True).awaitTermination(300)
        got = Counter({str(r.k): r["count"] for r in replayed_counts(spark.table(f"keys_log_{n}"), "k").collect()})
        assert got == Counter(str(v) for v, _ in rows), kind
        memory(stream_keep_first(read(), ["k"], "i"), f"keys_first_{n}", availableNow=True).awaitTermination(300)
        first = {}
        for v, i in rows:
            first.setdefault(str(v), i)
        assert {r.i for r in spark.table(f"keys_first_{n}").collect()} == set(first.values()), kind


def late_chunks():
    rng, chunks, now = random.Random(6), [], 0
    for b in range(7):
        now += 40
        chunks.append([(b * 100 + i, at(now - rng.choice([0, 1, 5, 15, 30, 70, 120]))) for i in range(25)])
    return chunks


def watermarks(chunks, delay):
    """In force while each batch runs: by the batches before it."""
    out, top = [], None
    for c in chunks:
        out.append(top - dt.timedelta(seconds=delay) if top else None)
        top = max([t for _, t in c] + ([top] if top else []))
    return out


def closed(t, watermark, size=20):
    s = (t - dt.datetime(2024, 1, 1)).total_seconds()
    return watermark is not None and at(s - s % size + size) <= watermark


def test_late_rows_of_windows_are_kept_and_counted(spark):
    chunks = late_chunks()
    chunks[3].append((399, None))
    src = _files(spark, chunks[:4], "i long, t timestamp")
    root = tempfile.mkdtemp(prefix="tideline-lates-")
    assert committed_epochs(spark, root) is None

    def run():
        stream = read_parquet_stream(spark, src, "i long, t timestamp", 1)
        q = (stream.writeStream.foreachBatch(late_sinks(root, "t", "20 seconds", "10 seconds"))
             .option("checkpointLocation", checkpoint_location(spark, "lates")).trigger(availableNow=True).start())
        q.awaitTermination(300)

    run()
    more = _files(spark, chunks[4:], "i long, t timestamp")  # a restart goes on with the watermark
    for i in range(len(chunks) - 4):
        os.rename(os.path.join(more, f"{i}.parquet"), os.path.join(src, f"{i + 4}.parquet"))
    run()
    timed = [[(i, t) for i, t in c if t] for c in chunks]
    want = {i: closed(t, w) for c, w in zip(timed, watermarks(timed, 10)) for i, t in c} | {399: False}
    late = {r.i for r in read_committed(spark, root, "late").collect()}
    on_time = {r.i for r in read_committed(spark, root, "on_time").collect()}
    assert late == {i for i, x in want.items() if x} and on_time == set(want) - late and len(late) > 20
    counts = {r.epoch: (r.main_rows, r.side_rows) for r in committed_epochs(spark, root).collect()}
    assert counts == {e: (sum(not want[i] for i, _ in c), sum(want[i] for i, _ in c)) for e, c in enumerate(chunks)}


def test_late_rows_of_the_lag_are_all_counted(spark):
    chunks = late_chunks()
    src = _files(spark, chunks, "i long, t timestamp")
    stream = read_parquet_stream(spark, src, "i long, t timestamp", 1).withColumn("k", F.lit("a")).withColumn("p", F.lit(1.0))
    q = memory(stream_with_previous(stream, "k", "p", "t", tie="i", delay="10 seconds", emit_late=True), "t12_lag", availableNow=True)
    q.awaitTermination(300)
    want = {i for c, w in zip(chunks, watermarks(chunks, 10)) for i, t in c if w is not None and t <= w}
    kept = {r.i for r in spark.sql("SELECT * FROM t12_lag WHERE late").collect()}
    assert kept <= want and len(kept) + sum(dropped_by_watermark(q).values()) == len(want)


def test_rows_dropped_by_the_windowed_aggregate_are_counted(spark):
    chunks = late_chunks()
    src = _files(spark, chunks, "i long, t timestamp")
    agg = stream_window_aggregate(read_parquet_stream(spark, src, "i long, t timestamp", 1), [], "t", "20 seconds",
                                  [F.count(F.lit(1)).alias("n"), F.sum("i").alias("s")], delay="10 seconds")
    q = memory(agg, "t12_windows", availableNow=True)
    q.awaitTermination(300)
    # Late rows are judged by the watermark of the batch before; partial aggregates are dropped, so windows are counted.
    late = {b: len({(t - at(0)) // dt.timedelta(seconds=20) for _, t in c if closed(t, w)})
            for b, (c, w) in enumerate(zip(chunks, [None, *watermarks(chunks, 10)[:-1]]))}
    got = dropped_by_watermark(q)
    assert {b: n for b, n in got.items() if n} == {b: n for b, n in late.items() if n} and sum(late.values()) > 0
    # What the query emits is what a batch over the rows that were not dropped gives.
    kept = [(i, t) for c, w in zip(chunks, [None, *watermarks(chunks, 10)[:-1]]) for i, t in c if not closed(t, w)]
    want = Counter()
    for _, t in kept:
        want[(t - at(0)) // dt.timedelta(seconds=20)] += 1
    rows = {(r.window_start - at(0)) // dt.timedelta(seconds=20): r.n for r in spark.sql("SELECT * FROM t12_windows").collect()}
    assert rows and all(want[w] == n for w, n in rows.items())


def test_a_slow_source_holds_windows_open(spark):
    fast = _files(spark, [[(1, at(0))], [(2, at(100))], [(3, at(200))], [(4, at(300))]], "i long, t timestamp")
    slow = _files(spark, [[(10, at(5))], [(11, at(30))], [(12, at(45))], [(13, at(50))]], "i long, when timestamp")

    def run(name, policy_sources):
        stream = union_sources(policy_sources, "t")
        agg = stream.groupBy(F.window("t", "20 seconds").alias("w")).agg(F.sum("i").alias("s")).select(F.col("w.start").alias("start"), "s")
        q = memory(agg, name, availableNow=True)
        q.awaitTermination(300)
        return {(r.start - at(0)).total_seconds(): r.s for r in spark.sql(f"SELECT * FROM {name}").collect()}, q

    read = lambda src, schema: read_parquet_stream(spark, src, schema, 1)
    both, q = run("t4_both", [(read(fast, "i long, t timestamp"), "t", "10 seconds"), (read(slow, "i long, when timestamp"), "when", "5 seconds")])
    # min(300 - 10, 50 - 5) = 45: windows up to 40 s are closed, with every row of the slow source.
    assert both == {0.0: 11, 20.0: 11}
    assert sum(dropped_by_watermark(q).values()) == 0
    alone, _ = run("t4_fast", [(read(fast, "i long, t timestamp"), "t", "10 seconds")])
    assert alone == {0.0: 1, 100.0: 2, 200.0: 3}
    with pytest.raises(ValueError):
        union_sources([])


def test_both_sinks_agree_after_a_failure_between_their_writes(spark, monkeypatch):
    chunks = [[(i, i % 3 == 0) for i in range(b * 10, b * 10 + 10)] for b in range(3)]
    src = _files(spark, chunks, "i int, dup boolean")
    root = tempfile.mkdtemp(prefix="tideline-joint-")
    body = joint_sinks("dup", root)
    from pyspark.sql import DataFrameWriter
    plain, failing = DataFrameWriter.parquet, {"on": True}

    def parquet(self, path, *a, **kw):
        if failing["on"] and path.endswith("side/epoch=1"):
            raise OSError("lost between the two writes")
        return plain(self, path, *a, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)

    def run():
        stream = read_parquet_stream(spark, src, "i int, dup boolean", 1)
        q = (stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint_location(spark, "joint"))
             .trigger(availableNow=True).start())
        q.awaitTermination(300)

    with pytest.raises(Exception, match="lost between"):
        run()
    assert os.path.isdir(f"{root}/main/epoch=1")  # one sink is ahead on disk
    shown = {n: sorted((r.i, r.epoch) for r in read_committed(spark, root, n).collect()) for n in ("main", "side")}
    assert shown["main"] == [(i, 0) for i, d in chunks[0] if not d] and shown["side"] == [(i, 0) for i, d in chunks[0] if d]
    failing["on"] = False
    run()
    for name, flag in (("main", False), ("side", True)):
        rows = sorted((r.i, r.epoch) for r in read_committed(spark, root, name).collect())
        assert rows == [(i, e) for e, c in enumerate(chunks) for i, d in c if d == flag]
