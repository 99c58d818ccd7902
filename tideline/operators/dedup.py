"""Keyed deduplication in batch form.

* ``keep_first``      - first row per key in arrival order; state never expires.
* ``tag_duplicates``  - every row with ``is_duplicate`` (the side-output split).
* ``split_duplicates``- (unique, duplicates) DataFrames.
* ``dedup_expiring``  - first row per key, where every arrival (kept or not)
  arms a timer at ``arrival + ttl`` and any timer firing forgets the key.

Keep-first and tagging join rows to the first arrival of their key on
``(key, row id)``, so a hot key spreads over the join's partitions. The first
arrivals are a hash aggregate where one column gives the arrival; with several
they are a ``min_by`` over structs, which sorts. The expiring form runs on the
hot-key safe ordered scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import duration_us, epoch_us
from tideline.operators.ordered import DEFAULT_ROWS_PER_SPLIT, keyed_scan, lag


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def keep_first(df: DataFrame, keys: str | list[str], arrival: str | list[str], unique: bool = False) -> DataFrame:
    """First row of each key by ``arrival`` (ascending; list the tie-breakers too).

    ``unique``: no two rows of a key have the same arrival. Then the first
    arrivals are a hash aggregate over narrow columns, joined back to the
    rows. Otherwise rows are compared as structs, which Spark aggregates by
    sorting.
    """
    keys, arrival = _as_list(keys), _as_list(arrival)
    if unique and len(arrival) == 1:
        return split_duplicates(df, keys, arrival, arrival)[0]
    cols = df.columns
    first = (df.groupBy(*keys)
               .agg(F.min_by(F.struct(*[F.col(c) for c in cols]),
                             F.struct(*[F.col(c) for c in arrival])).alias("__first")))
    return first.select(*[F.col(f"__first.{c}").alias(c) for c in cols])


def tag_duplicates(df: DataFrame, keys: str | list[str], arrival: str | list[str],
                   row_id: str | list[str], flag: str = "is_duplicate") -> DataFrame:
    """All rows plus ``flag``: false for the first row of its key, true after.

    ``row_id`` must identify a row within its key (often the arrival column).
    """
    keys, arrival, row_id = _as_list(keys), _as_list(arrival), _as_list(row_id)
    if len(row_id) == 1 and row_id == arrival:
        # The first row's id is the smallest arrival: a plain min, which
        # Spark aggregates with a hash map instead of sorting.
        # A null arrival orders first, as in the general min_by form.
        c = F.col(row_id[0])
        first_ids = [F.when(F.count(F.lit(1)) > F.count(c), F.lit(None)).otherwise(F.min(c)).alias("__fr_0")]
    else:
        fid = F.min_by(F.struct(*[F.col(c) for c in row_id]), F.struct(*[F.col(c) for c in arrival]))
        first_ids = [fid.getField(c).alias(f"__fr_{i}") for i, c in enumerate(row_id)]
    firsts = (df.groupBy(*[F.col(k).alias(f"__fk_{i}") for i, k in enumerate(keys)])
                .agg(*first_ids)
                .withColumn("__is_first", F.lit(True)))
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"__fk_{i}")) for i, k in enumerate(keys)]
                  + [F.col(c).eqNullSafe(F.col(f"__fr_{i}")) for i, c in enumerate(row_id)])
    joined = df.join(firsts, cond, "left")
    return joined.select(*df.columns, F.col("__is_first").isNull().alias(flag))


def split_duplicates(df: DataFrame, keys, arrival, row_id) -> tuple[DataFrame, DataFrame]:
    """(unique, duplicates): the main output and the side output."""
    tagged = tag_duplicates(df, keys, arrival, row_id, "__dup")
    unique = tagged.filter(~F.col("__dup")).drop("__dup")
    dups = tagged.filter(F.col("__dup")).drop("__dup")
    return unique, dups


def dedup_expiring(df: DataFrame, keys: str | list[str], arrival: str, ttl="10 minutes",
                   tie: str | list[str] | None = None, policy: str = "timers",
                   split="auto", rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """Rows a keyed dedup with expiring state would emit.

    ``policy='timers'`` (the reference's behaviour): each arrival registers a
    timer at ``arrival + ttl``; no timer is ever deleted; any timer clears the
    key. A row is emitted iff the key's state is empty when it arrives. In
    the per-key sequence of arrivals and timers (a timer at the same instant
    as an arrival comes first), the state is empty exactly when the element
    right before the arrival is a timer or there is none. So the operator is
    one LAG over that merged sequence.

    ``policy='last_seen'``: emit iff the previous arrival of the key is at
    least ``ttl`` earlier (state refreshed by every arrival).
    """
    keys, ties = _as_list(keys), _as_list(tie)
    ttl_us = duration_us(ttl)
    t = epoch_us(df, arrival)
    cols = df.columns
    if policy == "last_seen":
        s = keyed_scan(df.withColumn("__t", t), keys, [arrival, *ties], [lag("__t", "__prev_t")],
                       split, rows_per_split)
        keep = F.col("__prev_t").isNull() | (F.col("__t") - F.col("__prev_t") >= F.lit(ttl_us))
        return s.filter(keep).select(*cols)
    if policy != "timers":
        raise ValueError(f"unknown policy {policy!r}")
    # One scan: each row becomes its arrival, which carries the row, and its timer, which carries nothing.
    row = F.struct(*[F.col(c) for c in cols])
    element = lambda at, kind, payload: F.struct(
        F.timestamp_micros(at).alias("at"), F.lit(kind).alias("kind"), payload.alias("row"))
    pair = F.array(element(t, 1, row), element(t + F.lit(ttl_us), 0, F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType)))
    names = [f"__k{i}" for i in range(len(keys))], [f"__t{i}" for i in range(len(ties))]
    merged = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names[0])], *[F.col(c).alias(n) for c, n in zip(ties, names[1])],
                       F.explode(pair).alias("__e")).select(*names[0], *names[1], "__e.at", "__e.kind", "__e.row")
    s = keyed_scan(merged, names[0], ["at", "kind", *names[1]], [lag("kind", "__prev_kind")], split, rows_per_split)
    keep = (F.col("kind") == 1) & (F.col("__prev_kind").isNull() | (F.col("__prev_kind") == 0))
    return s.filter(keep).select("row.*")
