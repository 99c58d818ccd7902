"""Benchmark the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_QUERIES (comma list, default the headline set).
Each query runs once to warm up, then BENCH_RUNS times; the median wall time
of a full execution (``write.format('noop')``, no collect to the driver) is
reported. ``value`` is the sum of the medians.

With BENCH_SKEW=1 (default) ``skew`` times price_signals on a key holding a
third of all rows, with the hot-key split forced at this small size and with
the plain window, and on 12 million rows of which one key holds a third more
than the default threshold, at default settings. The difference is the
split's cost, which buys bounded tasks.

With BENCH_STREAMING=1 (default) the events table is also replayed as a
stream (10 time-ordered files, 5 per trigger) through the streaming dedup, the
event-time LAG and the changelog counts. ``streaming`` reports rows per second
of a whole replay (start of the query to its end) after one for warm-up, of
that first one (``_cold``), and of the warm one's micro-batches by its
progress (``_in_batches``).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["price_signals", "word_count", "tumbling_avg", "session_stats", "dedup_first",
            "dedup_expiring", "watermark_trace"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from tideline.plans.queries import QUERIES
    from tideline.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="tideline-bench", shuffle_partitions=cpus,
                          extra_conf={"spark.driver.memory": "16g"})
    results: dict[str, float] = {}
    for name in names:
        q = QUERIES[name]

        def once() -> float:
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()  # warm-up: JIT, file listing, Python workers
        results[name] = round(statistics.median(once() for _ in range(runs)), 4)
    skew = bench_skew(spark, sf_dir, runs) if os.environ.get("BENCH_SKEW", "1") == "1" else {}
    streaming = bench_streaming(spark, sf_dir) if os.environ.get("BENCH_STREAMING", "1") == "1" else {}
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "skew": skew,
        "streaming": streaming,
    }))


def bench_skew(spark, sf_dir: str, runs: int) -> dict[str, float]:
    """price_signals where one key holds a third of all rows: hot-key split vs plain window.

    ``rows_per_split`` is scaled so the hot key is split into about 8 buckets
    at this data size (at cluster scale the 4M-row default does the same).
    """
    from pyspark.sql import functions as F

    from tideline.operators.signals import price_signals
    from tideline.sources.tables import events

    ev = events(spark, sf_dir)
    ev = ev.withColumn("k", F.when(F.pmod(F.col("event_id"), F.lit(3)) == 0, F.lit(0)).otherwise(F.col("user_id") + 1))
    rows_per_split = max(100, ev.count() // 24)
    out = {}
    for label, kw in (("hot_key_split_sec", {"split": "auto", "rows_per_split": rows_per_split}),
                      ("plain_window_sec", {"split": None})):
        def once() -> float:
            t0 = time.perf_counter()
            price_signals(ev, "k", "value", "ts", tie="event_id", **kw).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        once()
        out[label] = round(statistics.median(once() for _ in range(runs)), 4)

    # Default settings: one key beyond the threshold of 4 million rows.
    import tempfile
    path = os.path.join(tempfile.mkdtemp(prefix="tideline-bench-"), "events")
    spark.range(12_900_000).selectExpr(
        "id event_id", "timestamp_micros(1704067200000000 + id * 200000) ts",
        "if(id % 3 = 0, 0, id % 1500 + 1) user_id", "cast(id * 7919 % 1000 as double) / 10 + 1 value").write.parquet(path)
    big = spark.read.parquet(path)
    for label, kw in (("default_settings_split_sec", {}), ("default_settings_plain_sec", {"split": None})):
        t0 = time.perf_counter()
        price_signals(big, "user_id", "value", "ts", tie="event_id", **kw).write.format("noop").mode("overwrite").save()
        out[label] = round(time.perf_counter() - t0, 4)
    return out


def bench_streaming(spark, sf_dir: str) -> dict[str, float]:
    """Rows/s of file replays through the stateful streaming operators."""
    import tempfile

    from tideline.sinks.writers import memory
    from tideline.sources.files import read_parquet_stream
    from tideline.sources.tables import events
    from tideline.streaming.changelog import stream_changelog_counts
    from tideline.streaming.dedup import stream_keep_first
    from tideline.streaming.signals import stream_with_previous

    ev = events(spark, sf_dir)
    d = os.path.join(tempfile.mkdtemp(prefix="tideline-bench-"), "events")
    ev.repartitionByRange(10, "event_id").sortWithinPartitions("event_id").write.parquet(d)
    now = time.time()
    for i, f in enumerate(sorted(f for f in os.listdir(d) if f.endswith(".parquet"))):
        os.utime(os.path.join(d, f), (now - 100 + i, now - 100 + i))  # replay in time order
    n = ev.count()
    jobs = {"dedup": lambda s: stream_keep_first(s, ["user_id", "event_type"], "event_id"),
            "lag": lambda s: stream_with_previous(s, "user_id", "value", "ts", tie="event_id"),
            "changelog": lambda s: stream_changelog_counts(s, "user_id")}
    out = {}
    for label, build in jobs.items():
        for run in ("cold", "warm"):  # the first run starts Python workers and compiles code, as the queries' warm-up does
            t0 = time.perf_counter()
            q = memory(build(read_parquet_stream(spark, d, ev.schema, 5)), f"bench_{label}_{run}", availableNow=True)
            q.awaitTermination(1800)
            seconds = time.perf_counter() - t0
            out[f"{label}_rows_per_sec" + ("_cold" if run == "cold" else "")] = round(n / seconds, 1)
        busy = [p for p in q.recentProgress if p["numInputRows"]]
        out[f"{label}_rows_per_sec_in_batches"] = round(n / sum(p["durationMs"]["triggerExecution"] for p in busy) * 1000, 1)
    return out


if __name__ == "__main__":
    main()
