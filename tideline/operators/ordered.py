"""Per-key ordered scans that survive hot keys.

Several operators need "the previous row of my key" (LAG), "the max of all
earlier rows of my key" or "the last non-null value so far" in event-time
order. A plain ``Window.partitionBy(key).orderBy(time)`` sends every row of a
key to one task, so a key that holds a third of the data becomes one task
sorting a third of the data.

With ``split='auto'`` one hash aggregate per key finds the hot keys, those of
more than ``rows_per_split`` rows. A sample of a hot key's rows, drawn by
hash, gives its cut points: every so many sampled rows, in the scan's own
order, ties included. So a burst, and rows of one instant, are cut like any
others. Cut points, one per ``rows_per_split`` rows of the table at most, are
written as a small table, which Spark's own size check joins to the rows.

Rows are shuffled once, on ``(key, bucket)``, as they came: what can be
computed from a row is computed after the shuffle. They are scanned within
their bucket, which is small enough to be sorted in memory, and written, with
the columns that are still needed. The last row of each bucket says what the bucket hands on; a window
over those few rows gives what each bucket receives from all earlier ones, and
that corrects the rows where they lie. Chained scans (sessions, watermarks)
state how their steps combine, so a chain costs no further shuffle. Without
hot keys the plan is the plain window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.time import duration_us, epoch_us
from tideline.session import written

# A key with more rows than this is split into buckets of about this many rows, at most _BUCKET_ROWS.
DEFAULT_ROWS_PER_SPLIT = 4_000_000
# Rows of a bucket that a task sorts in memory, with a few others beside it.
_BUCKET_ROWS = 500_000
# Sampled rows per bucket: cut points are this exact.
_SAMPLES = 256
# Cut points are searched in groups of this many.
_GROUP = 64


@dataclass(frozen=True)
class Scan:
    kind: str  # "lag" | "max_before" | "ffill"
    expr: Column
    name: str


def lag(expr: Column | str, name: str) -> Scan:
    """Value of ``expr`` on the previous row of the key (null on the first)."""
    return Scan("lag", F.col(expr) if isinstance(expr, str) else expr, name)


def max_before(expr: Column | str, name: str) -> Scan:
    """Max of ``expr`` over all earlier rows of the key (null on the first)."""
    return Scan("max_before", F.col(expr) if isinstance(expr, str) else expr, name)


def ffill(expr: Column | str, name: str) -> Scan:
    """Last non-null ``expr`` over the rows up to and including this one."""
    return Scan("ffill", F.col(expr) if isinstance(expr, str) else expr, name)


@dataclass(frozen=True)
class SplitPlan:
    """How a scan is split: every key by one width of time, or the hot keys at their cut points."""
    width_us: int | None = None
    cuts: DataFrame | None = None          # (__ck0.., __coarse, __fine): sorted arrays of order structs
    hashed: tuple[str, ...] = ()           # the columns whose hash breaks the last ties


@dataclass(frozen=True)
class Chain:
    """A scan in steps, and how its result combines over consecutive buckets of a key.

    ``steps(w)``: columns over the window ``w`` of a bucket's rows, a dict per
    step; later steps may use earlier ones. ``hand_on``: what the bucket's last
    row tells. ``receive(w)``: likewise steps over the buckets of a key.
    ``result``: the scan's columns, from those of ``steps`` and ``receive``;
    what a first bucket receives is null. ``derived``: columns computed from
    each row alone, which ``steps`` may use and the result has.
    """
    steps: Callable[[Window], list[dict[str, Column]]]
    hand_on: dict[str, Column]
    receive: Callable[[Window], list[dict[str, Column]]]
    result: dict[str, Column]
    derived: dict[str, Column] = field(default_factory=dict)


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def _same(a: list[str], b: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(p).eqNullSafe(F.col(q)) for p, q in zip(a, b)], F.lit(True))


def _hashable(df: DataFrame) -> tuple[str, ...]:
    return tuple(f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType)))


def _with_row_hash(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """A last tie-breaker, so that rows alike in all order columns can be parted too."""
    return df.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in columns]))


def plan_split(df: DataFrame, keys: list[str], order: str | list[str], split="auto",
               rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> SplitPlan | None:
    """Decide how a scan is split.

    ``split``: ``'auto'``, None (plain window), a duration / int microseconds
    (every key bucketed by that width), or an existing ``SplitPlan``. Cut
    points hold for the columns of ``df`` and the ``order`` given here.
    """
    if split is None or isinstance(split, SplitPlan):
        return split
    if split != "auto":
        return SplitPlan(width_us=max(1, duration_us(split)))
    order = [order] if isinstance(order, str) else list(order)
    names = [f"__ck{i}" for i in range(len(keys))]
    hot = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("__n")).filter(
        F.col("__n") > F.lit(rows_per_split))
    hot = written(hot, "hot-keys")
    if hot.isEmpty():
        return None
    bucket = min(rows_per_split, _BUCKET_ROWS)
    every = max(1, bucket // _SAMPLES)
    step = max(1, bucket // every)
    hashed = _hashable(df)
    rows = _with_row_hash(df, hashed)
    sampled = rows.filter(F.pmod(F.xxhash64("__h", F.lit(1)), F.lit(every)) == 0)
    sampled = sampled.join(hot.select(*names, F.lit(1).alias("__hot")), _same(keys, names)).select(
        *names, _order_struct([*order, "__h"]).alias("__o"))
    place = F.row_number().over(Window.partitionBy(*names).orderBy("__o"))
    at = sampled.withColumn("__r", place).filter(F.pmod("__r", F.lit(step)) == 0)
    fine = F.array_sort(F.collect_list("__o"))
    cuts = at.groupBy(*names).agg(fine.alias("__fine")).withColumn(
        "__coarse", F.filter("__fine", lambda c, i: F.pmod(i, F.lit(_GROUP)) == 0))
    return SplitPlan(cuts=written(cuts, "cut-points"), hashed=hashed)


def _bucketed(df: DataFrame, keys: list[str], order: list[str], plan: SplitPlan) -> tuple[DataFrame, list[str]]:
    """``df`` with its bucket ``__b``, and the order within it."""
    if plan.width_us is not None:
        t = epoch_us(df, order[0])
        return df.withColumn("__b", F.when(t.isNull(), F.lit(-(2 ** 63))).otherwise(
            F.floor(t / F.lit(plan.width_us))).cast("long")), order
    order = [*order, "__h"]
    rows = _with_row_hash(df, plan.hashed)
    names = [c for c in plan.cuts.columns if c.startswith("__ck")]
    joined = rows.join(plan.cuts, _same(keys, names), "left").withColumn("__o", _order_struct(order))
    # Two short searches instead of one through all cut points of a key.
    group = F.size(F.filter("__coarse", lambda c: c <= F.col("__o")))
    in_group = F.slice("__fine", (F.col("__g") - 1) * _GROUP + 1, F.lit(_GROUP))
    below = F.when(F.coalesce(F.col("__g"), F.lit(0)) < 1, F.lit(0)).otherwise(
        (F.col("__g") - 1) * _GROUP + F.size(F.filter(in_group, lambda c: c <= F.col("__o"))))
    return (joined.withColumn("__g", group).withColumn("__b", below.cast("long"))
            .drop(*names, "__coarse", "__fine", "__o", "__g", "__h")), order


def _stepped(df: DataFrame, steps: list[dict[str, Column]]) -> DataFrame:
    for step in steps:
        df = df.withColumns(step) if step else df
    return df


def keyed_chain(df: DataFrame, keys: list[str], order: list[str], chain: Chain, split="auto",
                rows_per_split: int = DEFAULT_ROWS_PER_SPLIT, keep: list[str] | None = None) -> DataFrame:
    """``df`` and the chain's ``derived`` and result columns, per key in ``order`` (ascending).

    ``keep``: the columns of ``df`` in the result (default: all).
    """
    plan = plan_split(df, keys, order, split, rows_per_split)
    cols = [*(df.columns if keep is None else keep), *chain.derived]
    if plan is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        rows = _stepped(df, [chain.derived, *chain.steps(w)])
        # Each key is one bucket and receives nothing.
        told = rows.select(*keys, F.lit(0).alias("__b"), *_hand_on(chain))
        types = _stepped(told, chain.receive(Window.partitionBy(*keys).orderBy("__b"))).schema
        received = {n: F.lit(None).cast(types[n].dataType) for n in _received(chain)}
        return rows.withColumns(received).withColumns(chain.result).select(*cols, *chain.result)

    rows, order = _bucketed(df, keys, order, plan)
    rows = rows.repartition(*keys, "__b")
    if "__h" in order:
        rows = _with_row_hash(rows, plan.hashed)
    w = Window.partitionBy(*keys, "__b").orderBy(*order)
    rows = _stepped(rows, [chain.derived, *chain.steps(w)]).withColumn("__last", F.lead(F.lit(1)).over(w).isNull())
    names = [f"__rk{i}" for i in range(len(keys))]
    own = [n for step in chain.steps(w) for n in step]
    # What a bucket hands on is kept with its last row alone.
    told = [F.when(F.col("__last"), c).alias(n) for n, c in chain.hand_on.items()]
    rows = written(rows.select(*dict.fromkeys([*cols, *keys]), *own, "__b", "__last", *told), "scanned", compression="zstd")
    last = rows.filter("__last").select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("__b").alias("__rb"),
                                        *chain.hand_on)
    received = _stepped(last, chain.receive(Window.partitionBy(*names).orderBy("__rb")))
    received = written(received.select(*names, "__rb", *_received(chain)), "received")
    on = _same(keys, names) & (F.col("__b") == F.col("__rb"))
    joined = rows.join(received, on, "left")
    return joined.withColumns(chain.result).select(*cols, *chain.result)


def _hand_on(chain: Chain) -> list[Column]:
    return [c.alias(n) for n, c in chain.hand_on.items()]


def _received(chain: Chain) -> list[str]:
    return [n for step in chain.receive(Window.orderBy(F.lit(0))) for n in step]


def keyed_scan(df: DataFrame, keys: list[str], order: list[str], scans: list[Scan],
               split="auto", rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """Add one column per ``Scan``, computed per key in ``order`` (ascending).

    ``order[0]`` must be the event-time column (timestamp or epoch-ms long);
    further columns break ties. ``split`` is ``'auto'``, ``None`` (plain
    window), a fixed bucket width such as ``'1 day'``, or a ``SplitPlan``.
    """
    plan = plan_split(df, keys, order, split, rows_per_split)
    own = {f"__s{i}": s.expr for i, s in enumerate(scans)}
    base = df.withColumns(own)
    if plan is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return base.withColumns({s.name: _local(s.kind, c, w) for s, c in zip(scans, own)}).select(
            *df.columns, *[s.name for s in scans])

    hand_on, result = {}, {}
    for c, s in zip(own, scans):
        local, got = F.col(f"{c}l"), F.col(f"{c}r")
        if s.kind == "lag":
            hand_on[f"{c}h"] = F.col(c)
            result[s.name] = F.when(F.col("__first"), got).otherwise(local)
        elif s.kind == "max_before":
            hand_on[f"{c}h"] = F.greatest(local, F.col(c))
            result[s.name] = F.greatest(local, got)
        else:
            hand_on[f"{c}h"] = local
            result[s.name] = F.coalesce(local, got)
    chain = Chain(
        lambda w: [{f"{c}l": _local(s.kind, c, w) for c, s in zip(own, scans)} | {"__first": F.row_number().over(w) == 1}],
        hand_on,
        lambda w: [{f"{c}r": _before(s.kind, f"{c}h", w) for c, s in zip(own, scans)}],
        result)
    return keyed_chain(base, keys, order, chain, plan, rows_per_split).select(*df.columns, *[s.name for s in scans])


def _local(kind: str, c: str, w) -> Column:
    if kind == "lag":
        return F.lag(c).over(w)
    if kind == "max_before":
        return F.max(c).over(w.rowsBetween(Window.unboundedPreceding, -1))
    if kind == "ffill":
        return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    raise ValueError(kind)


def _before(kind: str, c: str, w) -> Column:
    """What a bucket receives of a scan from the buckets before it."""
    if kind == "lag":
        return F.lag(c).over(w)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return F.max(c).over(before) if kind == "max_before" else F.last(c, ignorenulls=True).over(before)
