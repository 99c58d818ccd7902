"""Golden tests from the inputs embedded in the reference's jobs (FIXTURES.md)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from tideline.operators.dedup import dedup_expiring, keep_first, split_duplicates
from tideline.operators.signals import price_signals
from tideline.operators.watermark import mark_late, watermark_trace
from tideline.operators.wordcount import word_counts, word_counts_sql
from tideline.sources import generators as gen
from tideline.sources import literals
from tideline.sources.files import read_csv


def test_orders_dedup_keep_first(spark):
    got = keep_first(literals.orders(spark), "orderId", "seq").orderBy("orderId").collect()
    assert [(r.orderId, r.userName, r.product, r.seq) for r in got] == [
        (1, "John", "apple", 0), (2, "Chris", "tomato", 1), (3, "Ethan", "mango", 2), (4, "Chris", "banana", 4)]


def test_orders_side_output(spark):
    unique, dups = split_duplicates(literals.orders(spark), "orderId", "seq", "seq")
    assert sorted(r.orderId for r in unique.collect()) == [1, 2, 3, 4]
    assert sorted((r.orderId, r.seq) for r in dups.collect()) == [(1, 3), (3, 5)]


def test_orders_expiring_dedup_same_four(spark):
    # The whole list arrives within a second, long before the 10-minute timers.
    o = literals.orders(spark).withColumn("arrival", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq") / 10))
    got = dedup_expiring(o, "orderId", "arrival", "10 minutes", tie="seq").collect()
    assert sorted(r.orderId for r in got) == [1, 2, 3, 4]


def test_expiring_dedup_timer_semantics(spark):
    # Arrivals at 0, 5, 12, 15.5 min: emit (state set), drop, emit (cleared at 10 by the
    # first row's timer), emit (cleared at 15 by the duplicate's timer).
    rows = [(1, i, m) for i, m in enumerate([0.0, 5.0, 12.0, 15.5])]
    df = spark.createDataFrame(rows, "k int, i int, m double").withColumn(
        "arrival", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m") * 60))
    for split in (None, "3 minutes"):
        got = sorted(r.m for r in dedup_expiring(df, "k", "arrival", "10 minutes", tie="i", split=split).collect())
        assert got == [0.0, 12.0, 15.5]
    # A timer exactly at an arrival instant fires before it.
    df2 = spark.createDataFrame([(1, 0, 0.0), (1, 1, 10.0)], "k int, i int, m double").withColumn(
        "arrival", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m") * 60))
    assert len(dedup_expiring(df2, "k", "arrival", "10 minutes", tie="i").collect()) == 2


def test_last_seen_policy(spark):
    rows = [(1, i, m) for i, m in enumerate([0.0, 5.0, 12.0, 15.5, 30.0])]
    df = spark.createDataFrame(rows, "k int, i int, m double").withColumn(
        "arrival", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m") * 60))
    got = sorted(r.m for r in dedup_expiring(df, "k", "arrival", "10 minutes", tie="i", policy="last_seen").collect())
    assert got == [0.0, 30.0]


def test_upper_names(spark):
    literals.names(spark).createOrReplaceTempView("InputTable")
    got = [r[0] for r in spark.sql("SELECT UPPER(f0) FROM InputTable").collect()]
    assert got == ["ALICE", "BOB", "JOHN"]


def test_price_rows_keep_duplicates(spark):
    df = literals.price_rows(spark)
    assert dict(df.dtypes) == {"price": "bigint", "script": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [(788, "INFY"), (1760, "TCS"), (1760, "TCS")]


def test_sequence_plus_one(spark):
    src = gen.sequence_table(spark, 1, 10)
    out = src.select((F.col("id") + 1).alias("id"), "data")
    rows = out.collect()
    assert [r.id for r in sorted(rows)] == list(range(2, 12))
    assert all(len(r.data) == 100 for r in rows)
    assert dict(src.dtypes)["id"] == "int"


WORDS_CSV = "Hi\nHello Hi\nHi\nHey\nHi\n"


def test_word_count_csv(spark):
    d = tempfile.mkdtemp(prefix="tideline-words-")
    with open(os.path.join(d, "words.csv"), "w") as f:
        f.write(WORDS_CSV)
    words = read_csv(spark, d, "word string")
    want = {"Hi": 4, "Hello": 1, "Hey": 1}
    assert {r.word: r["count"] for r in word_counts(words, "word").collect()} == want
    assert {r.word: r["count"] for r in word_counts_sql(spark, words, "word").collect()} == want


def test_signals_hand_made(spark):
    prices = [100.0, 95.0, 99.75, 94.0, 100.0]
    df = spark.createDataFrame([("A", p, i) for i, p in enumerate(prices)], "sym string, price double, i long") \
        .withColumn("event_time", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("i")))

    def expect(prev, p):
        r = p / prev
        return "BUY" if r < 0.95 else ("SELL" if r > 1.05 else None)
    want = [(p, expect(prev, p)) for prev, p in zip(prices, prices[1:])]
    want = [(p, s) for p, s in want if s is not None]
    got = price_signals(df, "sym", "price", "event_time", tie="i").orderBy("event_time").collect()
    assert [(r.price, r.signal) for r in got] == want
    assert ("94.0", "BUY") in [(str(r.price), r.signal) for r in got]
    assert got[-1].signal == "SELL"


def test_signals_zero_and_nan(spark):
    rows = [("z", 0, 0.0), ("z", 1, 5.0), ("n", 0, 0.0), ("n", 1, -5.0), ("q", 0, 0.0), ("q", 1, 0.0),
            ("x", 0, 1.0), ("x", 1, float("nan")), ("y", 0, None), ("y", 1, 3.0)]
    df = spark.createDataFrame(rows, "sym string, i long, price double") \
        .withColumn("t", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("i")))
    got = {r.sym: r.signal for r in price_signals(df, "sym", "price", "t", tie="i").collect()}
    # +inf -> SELL, -inf -> BUY, 0/0 and NaN -> none, null previous -> none
    assert got == {"z": "SELL", "n": "BUY"}


def test_idle_watermark_fixture(spark):
    seq = spark.range(0, 45).withColumnRenamed("id", "n")
    src = gen.idle_cycle(seq, "n", 20_000, 50_000, t0_ms=0).withColumn("source", F.lit(0))
    tr = watermark_trace(src, "source", "ts_ms", "arrival_ms", tie="n",
                         out_of_orderness="10 seconds", idle="5 seconds", align="10 seconds")
    wm = {r.n: (r.wm_idle_ms, r.wm_bounded_ms) for r in tr.collect()}
    assert wm[0] == (None, None)
    assert wm[19] == (18_000 - 10_001, 18_000 - 10_000)
    assert wm[20][0] == 20_001          # after more than 5 s of silence
    assert wm[20][1] == 19_000 - 10_000  # the SQL-style bounded watermark does not jump
    assert wm[21][0] == 20_001
    # With t0 = 5.5 s the jump passes the next window's end: its rows are dropped as late.
    src2 = gen.idle_cycle(seq, "n", 20_000, 50_000, t0_ms=5_500).withColumn("source", F.lit(0))
    tr2 = watermark_trace(src2, "source", "ts_ms", "arrival_ms", tie="n",
                          out_of_orderness="10 seconds", idle="5 seconds", align="10 seconds")
    late = mark_late(tr2, "ts_ms", "wm_idle_ms", "5 seconds").filter("is_late").collect()
    assert sorted(r.n for r in late) == [20, 21, 22, 23, 24, 40, 41, 42, 43, 44]
