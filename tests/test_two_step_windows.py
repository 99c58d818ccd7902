"""Sliding windows from panes and sessions from intervals equal the forms over all rows; their plans move no raw rows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001, bag
from tideline.operators import partials
from tideline.operators.windows import (session_intervals, session_intervals_native, session_window_native, sessionize, sliding,
                                        sliding_panes)
from tideline.sources.tables import events


def single():
    return [F.count(F.lit(1)).alias("n"), F.count("v").alias("n_v"), F.sum("v").alias("s"), F.min("v").alias("low"), F.max("v").alias("high"),
            F.avg("v").alias("mean")]


def two_step():
    return [partials.count("n"), partials.count("n_v", "v"), partials.total("v", "s"), partials.smallest("v", "low"),
            partials.largest("v", "high"), partials.mean("v", "mean")]


def rows(spark, n=1500, seed=3):
    rng, out = random.Random(seed), []
    for i in range(n):
        key = rng.choice(["hot", "hot", "a", "b", None, f"k{rng.randrange(30)}"])
        t = rng.choice([rng.randrange(-200_000, 2_000_000), 500_000 + rng.randrange(60) * 1000, None if i % 40 == 0 else 7_000])
        out.append((i, key, t, rng.choice([None, float(rng.randrange(-50, 50))]), rng.choice([0, 1, 5, 60, 900])))
    df = spark.createDataFrame(out, "i int, k string, s long, v double, gap_s long")
    return df.withColumn("t", F.timestamp_millis("s")).withColumn("v", F.col("v").cast("decimal(20,2)"))


@pytest.mark.parametrize("size,slide", [("2 hours", "30 minutes"), ("90 seconds", "60 seconds"), ("7 seconds", "5 seconds"), ("1 hour", "1 hour"),
                                        ("10 minutes", "3 minutes")])
def test_sliding_windows_from_panes(spark, size, slide):
    df = rows(spark)
    got = sliding_panes(df, ["k"], "t", size, slide, two_step())
    want = sliding(df, ["k"], "t", size, slide, single())
    mean = F.round("mean", 4).alias("mean")
    names = [c for c in want.columns if c != "mean"]
    assert got.columns == want.columns
    assert bag(got.select(*names, mean).collect()) == bag(want.select(*names, mean).collect())


def test_sliding_refuses_gaps_between_windows(spark):
    with pytest.raises(ValueError, match="slide"):
        sliding_panes(rows(spark, 5), ["k"], "t", "1 minute", "2 minutes", two_step())


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("gap", ["1 second", "45 seconds", "20 minutes", "by row"])
@pytest.mark.parametrize("rows_per_split", [20, 4_000_000])
def test_sessions_from_intervals(spark, keys, gap, rows_per_split):
    df = rows(spark).filter("t is not null")
    us = F.col("gap_s") * 1_000_000 if gap == "by row" else gap
    names = [*keys, "window_start", "window_end", "n", "n_v", "s", "low", "high"]
    got = session_intervals(df, keys, "t", us, two_step(), rows_per_split=rows_per_split)
    want = sessionize(df, keys, "t", us, single(), tie="i", split=None)
    assert bag(got.select(*names).collect()) == bag(want.select(*names).collect())


def test_rows_without_time_or_gap_are_in_no_session(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", None, 5), ("a", 2, None)], "k string, t long, g long")
    got = session_intervals(df, ["k"], "t", F.col("g") * 1_000_000, [partials.count()]).collect()
    assert [tuple(r) for r in got] == [("a", 1, 5001, 1)]
    with pytest.raises(Exception, match="negative"):
        session_intervals(df, ["k"], "t", F.lit(-1), [partials.count()], split=None).collect()
    assert session_intervals(df.limit(0), ["k"], "t", "1 second", [partials.count()]).collect() == []


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_shuffle_partial_rows_only(spark):
    ev = events(spark, SF001)
    session = _plan(session_intervals(ev, ["user_id"], "ts", "6 hours", [partials.count()], split=None))
    slide = _plan(sliding_panes(ev, ["event_type"], "ts", "2 hours", "30 minutes", [partials.count()]))
    assert "Expand" not in slide
    native = _plan(session_intervals_native(ev, ["user_id"], "ts", "6 hours", [partials.count()]))
    for plan in (session, slide, native):
        lines = plan.split("\n")
        last = max(i for i, line in enumerate(lines) if "Exchange" in line)
        assert re.search(r"HashAggregate\(.*partial_", lines[last + 1]), plan  # the exchange nearest to the scan
    # The sort of the sessions is behind that exchange: it sorts intervals.
    assert session.index("Sort [") < session.rindex("Exchange")


@pytest.mark.parametrize("gap", ["45 seconds", "20 minutes"])
def test_native_sessions_from_intervals(spark, gap):
    df = rows(spark).filter("t is not null")
    got = session_intervals_native(df, ["k"], "t", gap, two_step()).drop("mean")
    want = session_window_native(df, ["k"], "t", gap, single()).drop("mean")
    assert bag(got.collect()) == bag(want.collect())


def test_words_of_a_batch_come_in_bounded_tables(monkeypatch):
    import pyarrow as pa
    from tideline.functions import udtf

    spaces = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    lines = [f"a{i} b{s}c " * 40 for i, s in enumerate(spaces)] + [None, "", " "] + ["long line " * 2_000]
    monkeypatch.setattr(udtf, "BLOCK_CHARS", 800)
    lists = list(udtf._word_lists(pa.chunked_array([pa.array(lines)])))
    assert [w for ws in lists for w in ws] == [w for line in lines if line for w in line.split()]
    assert len(lists) > 10 and max(sum(map(len, ws)) for ws in lists) < 3 * 800


def test_map_side_counts_are_added_up_over_batches(monkeypatch):
    import collections
    import pyarrow as pa
    from tideline.streaming import changelog

    batches = [pa.RecordBatch.from_arrays([pa.array([None, "a", f"w{i % 7}", "a"])], ["k"]) for i in range(100)]

    def counted():
        out = [r for b in changelog._counted_here(iter(batches)) for r in b.to_pylist()]
        total = collections.Counter()
        for r in out:
            total[r["k"]] += r["n"]
        assert total == collections.Counter(k for b in batches for k in b.column(0).to_pylist())
        return len(out)
    assert counted() == 9  # one row a key, where every batch once gave its own
    monkeypatch.setattr(changelog, "HELD_BYTES", 200)
    assert 9 < counted() <= 300
    assert list(changelog._counted_here(iter([]))) == []
