"""Watermark traces and late-row splits for batch replays of a stream.

A stream's watermark depends on arrival order, not event-time order. Given an
arrival column, these functions give every row the watermark in force when it
arrived, per source, and decide which rows a windowed operator would have
dropped as late. Everything is in epoch milliseconds, the reference's unit.

Rules (reference semantics):

* bounded (SQL ``WATERMARK FOR t AS t - INTERVAL d``): ``max(t seen) - d``.
* bounded with idle advance (custom generator): after each event
  ``p = max - ooo - 1``; when the source is silent for more than ``idle``,
  the watermark jumps to ``floor(max / align) * align + ooo + 1``. It never
  decreases. Before the first event there is none (null).
* system-time lag: ``arrival - lag`` (does not look at event time at all).
* a row is late for window ``[s, e)`` when ``e - 1 <= watermark``.

The emitter is periodic in the reference; a trace treats emission as instant.
Every per-source running max goes through the hot-key safe ordered scan, so a
single source holding most rows is split by arrival time, never sorted on one
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.time import US_PER_MS, duration_us, epoch_us
from tideline.operators.ordered import DEFAULT_ROWS_PER_SPLIT, Chain, keyed_chain


def floor_div(c: Column, n: int) -> Column:
    """Exact floor division of a bigint column by a positive constant."""
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("long")


def to_ms(df: DataFrame, col: str) -> Column:
    return floor_div(epoch_us(df, col), US_PER_MS)


def _ms(d) -> int:
    return duration_us(d) // US_PER_MS


def watermark_trace(df: DataFrame, sources: str | list[str], time: str, arrival: str,
                    tie: str | list[str] | None = None, out_of_orderness="10 seconds",
                    idle="5 seconds", align="10 seconds", bounded_delay=None,
                    split="auto", rows_per_split: int = DEFAULT_ROWS_PER_SPLIT, keep: list[str] | None = None) -> DataFrame:
    """Add ``ts_ms``, ``arrival_ms``, ``wm_bounded_ms`` and ``wm_idle_ms``.

    ``wm_bounded_ms``: bounded watermark with ``bounded_delay`` (defaults to
    ``out_of_orderness``, no -1, as a SQL watermark declaration).
    ``wm_idle_ms``: the idle-advancing generator. Both are the watermark in
    force just before the row arrives. ``keep``: the columns of ``df`` in the
    result (default: all). With ``split='auto'`` ``df`` is read up to three
    times: write it first if that costs much.
    """
    srcs = [sources] if isinstance(sources, str) else list(sources)
    ties = [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    ooo, idle_ms, align_ms = _ms(out_of_orderness), _ms(idle), _ms(align)
    if align_ms <= 0:
        raise ValueError("align must be positive")
    delay = ooo if bounded_delay is None else _ms(bounded_delay)
    derived, base = {"ts_ms": to_ms(df, time), "arrival_ms": to_ms(df, arrival)}, df
    if clash := [c for c in derived if c in df.columns]:  # replaced before anything else
        base = df.withColumns({c: derived.pop(c) for c in clash})
    if keep is not None:
        keep = [*keep, *[c for c in clash if c not in keep]]
    ts, arrived = F.col("ts_ms"), F.col("arrival_ms")
    got_max, got_arrival, first = F.col("__got_max"), F.col("__got_arrival"), F.col("__first_arrival")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    chain = Chain(
        # Idle rows of a bucket are those long after the row before them; its first row is judged by what it receives.
        steps=lambda w: [
            {"__own_max": F.max(ts).over(before(w)), "__own_arrival": F.lag(arrived).over(w),
             "__first_arrival": F.first(arrived).over(so_far(w))},
            {"__own_idle": F.last(F.when(arrived - F.col("__own_arrival") > idle_ms, F.col("__own_max")), ignorenulls=True)
             .over(so_far(w))}],
        hand_on={"__told_max": F.greatest("__own_max", ts), "__told_arrival": arrived, "__told_first": first,
                 "__told_idle": F.col("__own_idle")},
        receive=lambda w: [
            {"__got_max": F.max("__told_max").over(before(w)), "__got_arrival": F.lag("__told_arrival").over(w)},
            {"__idle": F.when(F.col("__told_idle").isNotNull(), F.greatest("__told_idle", got_max))
             .when(F.col("__told_first") - got_arrival > idle_ms, got_max)},
            {"__got_idle": F.last("__idle", ignorenulls=True).over(before(w))}],
        result={
            "__max_before": F.greatest("__own_max", got_max),
            "__last_idle_max": F.when(F.col("__own_idle").isNotNull(), F.greatest("__own_idle", got_max))
            .when(first - got_arrival > idle_ms, got_max).otherwise(F.col("__got_idle"))},
        derived=derived)
    traced = keyed_chain(base, srcs, [arrival, *ties], chain, split, rows_per_split, keep)
    p = F.col("__max_before") - F.lit(ooo + 1)
    q = floor_div(F.col("__last_idle_max"), align_ms) * F.lit(align_ms) + F.lit(ooo + 1)
    return (traced.withColumn("wm_bounded_ms", F.col("__max_before") - F.lit(delay))
                  .withColumn("wm_idle_ms", F.greatest(p, q))
                  .drop("__max_before", "__last_idle_max"))


def tumbling_bounds_ms(ts_ms: Column, size) -> tuple[Column, Column]:
    size_ms = _ms(size)
    start = floor_div(ts_ms, size_ms) * F.lit(size_ms)
    return start, start + F.lit(size_ms)


def mark_late(df: DataFrame, ts_ms: str, watermark_ms: str, size, flag: str = "is_late") -> DataFrame:
    """Add ``window_start_ms``, ``window_end_ms`` and ``flag`` (window already fired)."""
    start, end = tumbling_bounds_ms(F.col(ts_ms), size)
    out = df.withColumn("window_start_ms", start).withColumn("window_end_ms", end)
    late = F.coalesce(F.col("window_end_ms") - F.lit(1) <= F.col(watermark_ms), F.lit(False))
    return out.withColumn(flag, late)


def split_late(df: DataFrame, ts_ms: str, watermark_ms: str, size) -> tuple[DataFrame, DataFrame]:
    """(on_time, late) rows for tumbling windows of ``size``."""
    m = mark_late(df, ts_ms, watermark_ms, size, "__late")
    return m.filter(~F.col("__late")).drop("__late"), m.filter(F.col("__late")).drop("__late")


def system_lag_watermark(df: DataFrame, arrival: str, lag_="50 seconds") -> DataFrame:
    """``wm_ms = arrival_ms - lag``: the processing-time-lag generator.

    The reference's default lag is 50000 ms (its comment says 5 s; the code
    says 50 s; the code is what runs).
    """
    return df.withColumn("wm_ms", to_ms(df, arrival) - F.lit(_ms(lag_)))
