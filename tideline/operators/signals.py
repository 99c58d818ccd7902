"""Previous-tick LAG per key and the BUY/SELL signal built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalar import BUY_BELOW, SELL_ABOVE, signal
from tideline.operators.ordered import DEFAULT_ROWS_PER_SPLIT, keyed_scan, lag


def with_previous(df: DataFrame, key: str | list[str], value: str, time: str,
                  tie: str | list[str] | None = None, name: str = "prev",
                  split="auto", rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """``LAG(value, 1) OVER (PARTITION BY key ORDER BY time, tie)`` as column ``name``."""
    keys = [key] if isinstance(key, str) else list(key)
    ties = [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    return keyed_scan(df, keys, [time, *ties], [lag(value, name)], split, rows_per_split)


def price_signals(df: DataFrame, key: str, price: str, time: str, tie: str | list[str] | None = None,
                  low: float = BUY_BELOW, high: float = SELL_ABOVE, keep: list[str] | None = None,
                  split="auto", rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """Rows whose price moved below ``low`` or above ``high`` times the previous tick.

    Output ``(key, signal, price, time, *keep)``. The previous price is
    computed once (the reference's SQL writes the LAG twice); the filter on
    ``signal`` stays above the window so it cannot change which row is
    previous.
    """
    prev = "__prev_price"
    needed = list(dict.fromkeys([key, price, time, *_as_list(tie), *(keep or [])]))
    with_prev = with_previous(df.select(*needed),
                              key, price, time, tie, prev, split, rows_per_split)
    out = with_prev.select(F.col(key), signal(F.col(price), F.col(prev), low, high).alias("signal"),
                           F.col(price), F.col(time), *[F.col(c) for c in (keep or [])])
    return out.filter(F.col("signal").isNotNull())


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)
