"""Aggregates in two steps: over small pieces of a window first, and over the pieces afterwards.

Spark splits an aggregate at the shuffle by itself. Where the pieces are an
operator's own (panes of sliding windows, intervals of sessions), the two
steps have to be named: an ``Agg`` has the columns kept for each piece, how
those of several pieces combine, and the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Agg:
    """``pieces``: aggregates over the rows of a piece; ``merge``: over those columns of several pieces; ``result``: of both."""
    name: str
    pieces: dict[str, Column]
    merge: dict[str, Column]
    result: Column


def _col(expr: Column | str) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr


def _simple(name: str, piece: Column, merge) -> Agg:
    part = f"__{name}"
    return Agg(name, {part: piece}, {part: merge(part)}, F.col(part))


def count(name: str = "n", expr: Column | str | None = None) -> Agg:
    """Number of rows, or of those where ``expr`` is not null."""
    return _simple(name, F.count(F.lit(1) if expr is None else _col(expr)), F.sum)


def total(expr: Column | str, name: str) -> Agg:
    return _simple(name, F.sum(_col(expr)), F.sum)


def smallest(expr: Column | str, name: str) -> Agg:
    return _simple(name, F.min(_col(expr)), F.min)


def largest(expr: Column | str, name: str) -> Agg:
    return _simple(name, F.max(_col(expr)), F.max)


def mean(expr: Column | str, name: str, divide=lambda s, n: s / n) -> Agg:
    """Sum over number of non-null values; null if there are none. ``divide`` makes the quotient."""
    s, n = f"__{name}_sum", f"__{name}_n"
    return Agg(name, {s: F.sum(_col(expr)), n: F.count(_col(expr))}, {s: F.sum(s), n: F.sum(n)},
               F.when(F.col(n) > 0, divide(F.col(s), F.col(n))))


def mapped(agg: Agg, result) -> Agg:
    """``agg`` with ``result`` of its outcome, such as a rounding."""
    return Agg(agg.name, agg.pieces, agg.merge, result(agg.result))


def pieces(aggs: list[Agg]) -> list[Column]:
    return [c.alias(n) for a in aggs for n, c in a.pieces.items()]


def merges(aggs: list[Agg]) -> list[Column]:
    return [c.alias(n) for a in aggs for n, c in a.merge.items()]


def results(aggs: list[Agg]) -> list[Column]:
    return [a.result.alias(a.name) for a in aggs]
