"""Event generators as closed-form columns over a sequence.

The reference's sources are sleeping loops that emit one tuple at a time. Here
row ``n`` of any sequence column is mapped straight to what the loop would
have emitted n-th, including the wall-clock instant it would arrive, so a
generator is a projection Spark runs in parallel with no driver loop.
Random values are deterministic (a Lehmer step seeded by ``n``), so runs and
engines agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed start instant for generated timelines: 2024-01-01T00:00:00Z in epoch ms.
T0_MS = 1_704_067_200_000
# Lehmer (Park-Miller) generator constants.
LEHMER_MOD = 2_147_483_647
LEHMER_MUL = 48_271


def lehmer(c: Column) -> Column:
    """One Park-Miller step of a non-negative bigint; result in [1, 2^31-2] for c % mod != 0."""
    return F.pmod(F.pmod(c, F.lit(LEHMER_MOD)) * F.lit(LEHMER_MUL), F.lit(LEHMER_MOD))


def incremental(seq: DataFrame, n: str = "n", t0_ms: int = T0_MS, step_ms: int = 1000,
                emit_every_ms: int = 500) -> DataFrame:
    """Row n: name ``Event{n}``, event time ``t0 + step*n``, arrival ``t0 + emit*n``.

    Event time runs ahead of wall time (1 s per 0.5 s by default).
    """
    c = F.col(n).cast("long")
    return seq.select(c.alias("n"), F.concat(F.lit("Event"), c.cast("string")).alias("name"),
                      (F.lit(t0_ms) + c * step_ms).alias("ts_ms"),
                      (F.lit(t0_ms) + c * emit_every_ms).alias("arrival_ms"))


def idle_cycle(seq: DataFrame, n: str = "n", active_ms: int = 20_000, idle_ms: int = 50_000,
               t0_ms: int = T0_MS, step_ms: int = 1000) -> DataFrame:
    """Active/idle source: one row per ``step_ms`` for ``active_ms``, then silence.

    Per cycle ``k = active_ms / step_ms`` rows; row n is number ``i = n mod k``
    of cycle ``c = n div k``. The name counter restarts every cycle
    (``Event{i}``) but event time keeps increasing: ``t0 + step*n``. Arrival is
    ``t0 + c*(active+idle) + step*i`` (sleep jitter ignored).
    """
    k = max(1, active_ms // step_ms)
    c = F.col(n).cast("long")
    cyc = F.floor(c / F.lit(k)).cast("long")
    i = F.pmod(c, F.lit(k))
    return seq.select(c.alias("n"), cyc.alias("cycle"),
                      F.concat(F.lit("Event"), i.cast("string")).alias("name"),
                      (F.lit(t0_ms) + c * step_ms).alias("ts_ms"),
                      (F.lit(t0_ms) + cyc * (active_ms + idle_ms) + i * step_ms).alias("arrival_ms"))


def out_of_order(seq: DataFrame, n: str = "n", t0_ms: int = T0_MS, emit_every_ms: int = 500,
                 max_delay_ms: int = 10_000, names: int = 10_000) -> DataFrame:
    """Random-name events whose event time lags arrival by up to ``max_delay_ms``."""
    c = F.col(n).cast("long")
    r1 = lehmer(c + F.lit(1))
    r2 = lehmer(r1)
    arrival = F.lit(t0_ms) + c * emit_every_ms
    return seq.select(c.alias("n"), F.concat(F.lit("Event"), F.pmod(r1, F.lit(names)).cast("string")).alias("name"),
                      (arrival - F.pmod(r2, F.lit(max_delay_ms))).alias("ts_ms"),
                      arrival.alias("arrival_ms"))


def sequence_table(spark: SparkSession, start: int = 1, end: int = 10, string_length: int = 100,
                   seed: int = 0) -> DataFrame:
    """Sequence ``id`` in ``[start, end]`` (INT) with a deterministic random hex ``data``."""
    ids = spark.range(start, end + 1).select(F.col("id").cast("int").alias("id"))
    return ids.select("id", random_string(F.col("id"), string_length, seed).alias("data"))


def random_string(c: Column, length: int, seed: int = 0) -> Column:
    parts = [F.sha2(F.concat_ws(":", F.lit(str(seed)), F.lit(str(j)), c.cast("string")), 256)
             for j in range((length + 63) // 64)]
    return F.substring(F.concat(*parts), 1, length)


def stream_sequence(spark: SparkSession, rows_per_batch: int = 10, start: int = 0,
                    num_partitions: int | None = None) -> DataFrame:
    """An unbounded sequence ``n = start, start+1, ...`` as a stream.

    Uses the ``rate-micro-batch`` source, which emits a fixed number of rows
    per trigger however long a batch takes, so replays are deterministic.
    Any generator above maps it to events: ``incremental(stream_sequence(spark))``.
    """
    r = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
         .option("startTimestamp", 0).option("advanceMillisPerBatch", 1000))
    if num_partitions:
        r = r.option("numPartitions", num_partitions)
    return r.load().select((F.col("value") + F.lit(start)).alias("n"))


def stream_sequence_table(spark: SparkSession, start: int = 1, end: int = 10, string_length: int = 100,
                          rows_per_batch: int = 10, seed: int = 0) -> DataFrame:
    """Streaming form of ``sequence_table``: ids past ``end`` are filtered out."""
    seq = stream_sequence(spark, rows_per_batch, start).filter(F.col("n") <= F.lit(end))
    return seq.select(F.col("n").cast("int").alias("id"),
                      random_string(F.col("n"), string_length, seed).alias("data"))
