"""Event-time window aggregates: tumbling, sliding, session (static or per-row gap).

Windows are half-open ``[start, end)`` and aligned to the epoch (UTC), the
convention of both Spark's ``window`` and the reference's TUMBLE.

Tumbling windows are a plain ``groupBy(keys, window(...))``: Spark aggregates
partially before the shuffle, so a hot key costs one partial row per map task
and window. Sliding windows by panes (``sliding_panes``) aggregate each row
once, into the pane of the greatest common divisor of size and slide, and put
windows together from panes; ``sliding`` takes any aggregate, at the price of
one copy of each row per window that it is in.

Sessions: a row joins the open session of its key when its time is at most
the largest ``time + gap`` of the earlier rows (Spark's merge rule, which
keeps a row exactly at the session end inside). ``session_intervals`` first
merges rows into intervals on the map side: rows of one key and gap within one
stretch of the gap's length are always in one session. Only intervals are
shuffled; a key of millions of rows has as many as gaps fit into its time.
Their sessions then come from the hot-key safe ordered scan. ``sessionize``
scans the rows themselves and takes any aggregate. ``session_window_native``
uses Spark's ``session_window`` (also what the streaming form uses), which
sorts all rows of a key in one task; ``session_intervals_native`` gives it the
intervals instead.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.time import duration_us, epoch_us, ntz_from_us, spark_interval
from tideline.operators.ordered import DEFAULT_ROWS_PER_SPLIT, Chain, keyed_chain
from tideline.operators.partials import Agg, merges, pieces, results


def _flatten(grouped: DataFrame, keys: list[str], wcol: str) -> DataFrame:
    rest = [c for c in grouped.columns if c not in (*keys, wcol)]
    return grouped.select(*keys, F.col(f"{wcol}.start").alias("window_start"),
                          F.col(f"{wcol}.end").alias("window_end"), *rest)


def tumbling(df: DataFrame, keys: list[str], time: str, size, aggs: list[Column]) -> DataFrame:
    """``GROUP BY keys, TUMBLE(time, size)`` -> keys, window_start, window_end, aggs."""
    g = df.groupBy(*keys, F.window(time, spark_interval(size)).alias("__w")).agg(*aggs)
    return _flatten(g, keys, "__w")


def sliding(df: DataFrame, keys: list[str], time: str, size, slide, aggs: list[Column]) -> DataFrame:
    """Hopping windows of ``size`` every ``slide``; a row lands in size/slide windows."""
    g = df.groupBy(*keys, F.window(time, spark_interval(size), spark_interval(slide)).alias("__w")).agg(*aggs)
    return _flatten(g, keys, "__w")


def sliding_panes(df: DataFrame, keys: list[str], time: str, size, slide, aggs: list[Agg]) -> DataFrame:
    """``sliding`` with two-step aggregates: rows are aggregated into panes, and panes into windows.

    Rows without a time are in no window.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    if not 0 < slide_us <= size_us:
        raise ValueError("the slide has to be positive and not longer than the size")
    pane_us = math.gcd(size_us, slide_us)
    rows = df.withColumn("__t_us", epoch_us(df, time)).filter(F.col("__t_us").isNotNull())
    pane = F.col("__t_us") - F.pmod("__t_us", F.lit(pane_us))
    panes = rows.groupBy(*keys, pane.alias("__pane_us")).agg(*pieces(aggs))
    # The pane is in every window that starts at a multiple of the slide in [pane end - size, pane].
    last = F.col("__pane_us") - F.pmod("__pane_us", F.lit(slide_us))
    room = F.lit(size_us - pane_us) - (F.col("__pane_us") - last)
    starts = F.sequence(last - (room - F.pmod(room, F.lit(slide_us))), last, F.lit(slide_us))
    windows = panes.withColumn("__start_us", F.explode(starts)).groupBy(*keys, "__start_us").agg(*merges(aggs))
    start = F.col("__start_us")
    return windows.select(*keys, _time_from_us(df, time, start).alias("window_start"),
                          _time_from_us(df, time, start + F.lit(size_us)).alias("window_end"), *results(aggs))


def session_window_native(df: DataFrame, keys: list[str], time: str, gap: str | Column,
                          aggs: list[Column]) -> DataFrame:
    """Spark's ``session_window``; ``gap`` is a duration or a string-valued column."""
    g_arg = gap if isinstance(gap, Column) else spark_interval(gap)
    g = df.groupBy(*keys, F.session_window(time, g_arg).alias("__w")).agg(*aggs)
    return _flatten(g, keys, "__w")


def _time_from_us(df: DataFrame, time: str, us: Column) -> Column:
    dt = df.schema[time].dataType
    if isinstance(dt, T.TimestampNTZType):
        return ntz_from_us(us)
    if isinstance(dt, T.TimestampType):
        return F.timestamp_micros(us)
    return F.floor(us / 1000).cast("long")  # epoch-ms input stays epoch-ms


def assign_sessions(df: DataFrame, keys: list[str], time: str, gap, tie: str | list[str] | None = None,
                    split="auto", rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """Add ``__sess_start_us`` and ``__end_us`` (row time + gap) to every row.

    ``gap`` is a duration (``'30 minutes'``) or a Column of microseconds for
    a per-row gap (custom windowing).
    """
    ties = [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    t = epoch_us(df, time)
    gap_us = gap if isinstance(gap, Column) else F.lit(duration_us(gap))
    base = df.withColumn("__t_us", t).withColumn("__end_us", t + gap_us.cast("long"))
    end, at = F.col("__end_us"), F.col("__t_us")
    own, got = F.col("__own_start"), F.col("__got_end")
    chain = Chain(
        # A row opens a session of its bucket if it is behind every earlier end there; the last opener up to each row.
        steps=lambda w: [
            {"__own_end": F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))},
            {"__own_start": F.last(F.when(F.col("__own_end").isNull() | (at > F.col("__own_end")), at), ignorenulls=True)
             .over(w.rowsBetween(Window.unboundedPreceding, 0))}],
        hand_on={"__told_end": F.greatest("__own_end", end), "__told_start": own},
        # It opens one of its key too if it is behind the ends of the earlier buckets; else their last session goes on.
        receive=lambda w: [
            {"__got_end": F.max("__told_end").over(w.rowsBetween(Window.unboundedPreceding, -1))},
            {"__open": F.when(got.isNull() | (F.col("__told_start") > got), F.col("__told_start"))},
            {"__got_start": F.last("__open", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))}],
        result={"__sess_start_us": F.when(got.isNull() | (own > got), own).otherwise(F.col("__got_start"))})
    return keyed_chain(base, keys, [time, *ties], chain, split, rows_per_split)


def _intervals(df: DataFrame, keys: list[str], time: str, gap, aggs: list[Agg]) -> DataFrame:
    """Intervals of rows that are in one session: ``__from_at``, how far they reach (``__reach``, microseconds), ``__gap_us``, pieces.

    An interval holds the rows of one key, one gap and one stretch of time of
    the gap's length: any two of them are less than a gap apart.
    """
    gap_us = gap if isinstance(gap, Column) else F.lit(duration_us(gap))
    rows = df.withColumn("__t_us", epoch_us(df, time)).withColumn("__gap_us", gap_us.cast("long"))
    rows = rows.filter(F.col("__t_us").isNotNull() & F.col("__gap_us").isNotNull())
    bad = F.raise_error(F.lit("a session's gap must not be negative")).cast("long")
    stretch = F.when(F.col("__gap_us") < 0, bad).otherwise(F.col("__t_us") - F.pmod("__t_us", F.greatest(F.col("__gap_us"), F.lit(1))))
    made = rows.groupBy(*keys, "__gap_us", stretch.alias("__stretch")).agg(
        F.min("__t_us").alias("__from_us"), F.max("__t_us").alias("__to_us"), *pieces(aggs))
    return made.withColumn("__from_at", F.timestamp_micros("__from_us")).withColumn(
        "__reach", F.col("__to_us") - F.col("__from_us") + F.col("__gap_us"))


def _sessions(df: DataFrame, g: DataFrame, keys: list[str], time: str, aggs: list[Agg]) -> DataFrame:
    return g.select(*keys, _time_from_us(df, time, F.col("__sess_start_us")).alias("window_start"),
                    _time_from_us(df, time, F.col("__sess_end_us")).alias("window_end"), *results(aggs))


def session_intervals(df: DataFrame, keys: list[str], time: str, gap, aggs: list[Agg], split="auto",
                      rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """``sessionize`` with two-step aggregates: rows are merged into intervals before anything is shuffled.

    ``gap`` is a duration or a Column of microseconds, not negative. Rows
    without time or gap are in no session.
    """
    if split == "auto" and not isinstance(gap, Column):
        # A key has no more intervals than gaps fit into the table's time; if those are few, no key needs a split.
        at = epoch_us(df, time)
        first, last = df.agg(F.min(at), F.max(at)).first()
        if first is None or (last - first) // max(1, duration_us(gap)) + 2 <= rows_per_split:
            split = None
    made = _intervals(df, keys, time, gap, aggs)
    merged = assign_sessions(made, keys, "__from_at", F.col("__reach"), "__gap_us", split, rows_per_split)
    g = merged.groupBy(*keys, "__sess_start_us").agg(F.max("__end_us").alias("__sess_end_us"), *merges(aggs))
    return _sessions(df, g, keys, time, aggs)


def session_intervals_native(df: DataFrame, keys: list[str], time: str, gap, aggs: list[Agg]) -> DataFrame:
    """``session_intervals`` by Spark's ``session_window`` over the intervals; a gap of 0 makes no session there."""
    made = _intervals(df, keys, time, gap, aggs)
    window = F.session_window("__from_at", F.concat(F.col("__reach").cast("string"), F.lit(" microseconds"))).alias("__w")
    g = made.groupBy(*keys, window).agg(*merges(aggs)).withColumns(
        {"__sess_start_us": F.unix_micros("__w.start"), "__sess_end_us": F.unix_micros("__w.end")})
    return _sessions(df, g, keys, time, aggs)


def sessionize(df: DataFrame, keys: list[str], time: str, gap, aggs: list[Column],
               tie: str | list[str] | None = None, split="auto",
               rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """Session windows per key -> keys, window_start, window_end, aggs.

    ``window_end`` is the largest ``time + gap`` in the session. The final
    ``groupBy(keys, session)`` aggregates partially, so one long session of a
    hot key does not land on one task unreduced.
    """
    rows = assign_sessions(df, keys, time, gap, tie, split, rows_per_split)
    g = rows.groupBy(*keys, "__sess_start_us").agg(F.max("__end_us").alias("__sess_end_us"), *aggs)
    rest = [c for c in g.columns if c not in (*keys, "__sess_start_us", "__sess_end_us")]
    return g.select(*keys, _time_from_us(df, time, F.col("__sess_start_us")).alias("window_start"),
                    _time_from_us(df, time, F.col("__sess_end_us")).alias("window_end"), *rest)
