"""The reference's jobs end to end, with JSON folders and memory sinks in place of Kafka and print."""

from __future__ import annotations

import json
import os
import tempfile
import time

from tideline.plans import jobs
from tideline.sources import literals


def _wait(pred, timeout=90.0):
    end = time.time() + timeout
    while time.time() < end:
        if pred():
            return True
        time.sleep(0.25)
    return False


def test_stocks_signals_job_json(spark):
    base = tempfile.mkdtemp(prefix="tideline-stocks-")
    src, out = os.path.join(base, "in"), os.path.join(base, "out")
    os.makedirs(src)
    ticks = [("TCS", 100.0, 0), ("TCS", 94.0, 1), ("TCS", 99.0, 2), ("INFY", 10.0, 3), ("INFY", 10.2, 4),
             ("TCS", 104.5, 5), ("INFY", 11.0, 6), ("ZZZ", 1.0, 60)]  # the last one moves the watermark on
    with open(os.path.join(src, "ticks.json"), "w") as f:
        for sym, price, sec in ticks:
            f.write(json.dumps({"stock_symbol": sym, "price": price,
                                "event_time": f"2024-01-01T00:{sec // 60:02d}:{sec % 60:02d}.000"}) + "\n")
        f.write("{ not json\n")
        f.write(json.dumps({"stock_symbol": "TCS", "price": 1.0, "event_time": None}) + "\n")
        f.write(json.dumps({"stock_symbol": "OLD", "price": None, "event_time": "2024-01-01T00:00:02"}) + "\n")
    rejects = os.path.join(base, "rejects")
    for q in jobs.stocks_signals_job(spark, src, out, fmt="json", job="stocks-test", rejects=rejects, availableNow=True):
        q.awaitTermination(300)
    rejected = sorted(r.value for r in spark.read.text(rejects).collect())
    assert rejected == sorted(["{ not json", '{"stock_symbol":"TCS","price":1.0,"event_time":null}'])
    rows = [json.loads(r.value) for r in spark.read.text(out).collect()]
    got = sorted((r["stock_symbol"], r["signal"], r["price"], r["event_time"]) for r in rows)
    assert got == [("INFY", "SELL", 11.0, "2024-01-01T00:00:06.000"),
                   ("TCS", "BUY", 94.0, "2024-01-01T00:00:01.000"),
                   ("TCS", "SELL", 99.0, "2024-01-01T00:00:02.000"),
                   ("TCS", "SELL", 104.5, "2024-01-01T00:00:05.000")]  # 104.5 / 99 > 1.05


def test_dedup_jobs_with_side_output(spark):
    base = tempfile.mkdtemp(prefix="tideline-dedupjob-")
    src = os.path.join(base, "orders")
    literals.orders(spark).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(literals.orders(spark).schema).parquet(src)
    seen = {"main": [], "side": []}

    def collect(name):
        def write(batch, epoch_id):
            seen[name].extend(r.orderId for r in batch.collect())
        return write
    q = jobs.dedup_job(stream, mode="side_output", main=collect("main"), side=collect("side"), availableNow=True)
    q.awaitTermination(300)
    assert sorted(seen["main"]) == [1, 2, 3, 4] and sorted(seen["side"]) == [1, 3]


def test_word_count_and_datagen_jobs(spark):
    d = tempfile.mkdtemp(prefix="tideline-wcjob-")
    with open(os.path.join(d, "words.csv"), "w") as f:
        f.write("Hi\nHello Hi\nHi\nHey\nHi\n")
    q = jobs.word_count_job(spark, d, query_name="job_wc", availableNow=True)
    q.awaitTermination(300)
    latest = spark.sql("SELECT word, max(`count`) AS n FROM job_wc GROUP BY word").collect()  # counts only grow
    assert {r.word: r.n for r in latest} == {"Hi": 4, "Hello": 1, "Hey": 1}
    q2 = jobs.datagen_job(spark, end=10, query_name="job_gen", processingTime="200 milliseconds")
    try:
        assert _wait(lambda: spark.sql("SELECT count(*) FROM job_gen").first()[0] >= 10)
    finally:
        q2.stop()
    assert sorted(r.id for r in spark.sql("SELECT * FROM job_gen").collect()) == list(range(2, 12))


def test_table_print_job(spark):
    assert [r.f0 for r in jobs.table_print_job(spark).collect()] == ["ALICE", "BOB", "JOHN"]
