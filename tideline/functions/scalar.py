"""Scalar column helpers: the signal rule, whitespace split, JSON codec."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The signal thresholds of the reference's stock job
# (BUY when price / previous < 0.95, SELL when > 1.05, both strict).
BUY_BELOW = 0.95
SELL_ABOVE = 1.05

# The characters Python's str.split() treats as whitespace
# (str.isspace), which the reference's word splitter relies on:
# U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
# Spark (Java regex): with the UNICODE_CHARACTER_CLASS flag, \s is Unicode
# White_Space, which is that set minus U+001C-U+001F; this form is as fast as
# a plain \s+. DuckDB (RE2) gets the same set spelled out.
WHITESPACE_RUN = r"(?U)[\s\x{1C}-\x{1F}]+"
WHITESPACE_RUN_RE2 = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)


def signal(price: Column, prev: Column, low: float = BUY_BELOW, high: float = SELL_ABOVE) -> Column:
    """'BUY' / 'SELL' / null from ``price / prev`` with IEEE-754 double semantics.

    Spark's ANSI mode raises on x / 0.0 and orders NaN above every number; the
    reference's engine yields +-Infinity and NaN with false comparisons. So:
    prev = 0 and price > 0 -> +inf -> SELL; price < 0 -> -inf -> BUY;
    0 / 0 -> NaN -> null; a NaN ratio never signals; a null prev never signals.
    """
    zero = prev == F.lit(0.0)
    ratio = F.when(~zero, price / prev)
    nan = F.isnan(ratio)
    return (F.when(zero & (price > 0), F.lit("SELL"))
             .when(zero & (price < 0), F.lit("BUY"))
             .when(nan, F.lit(None).cast("string"))
             .when(ratio < F.lit(float(low)), F.lit("BUY"))
             .when(ratio > F.lit(float(high)), F.lit("SELL"))
             .otherwise(F.lit(None).cast("string")))


def split_whitespace(text: Column) -> Column:
    """Array of tokens exactly as Python's ``str.split()``: no empty tokens."""
    return F.filter(F.split(text, WHITESPACE_RUN), lambda x: x != F.lit(""))


def split_whitespace_raw(text: Column) -> Column:
    """Regex split on whitespace runs; may hold one leading/trailing empty token."""
    return F.split(text, WHITESPACE_RUN)


# Times as text to the microsecond; nulls kept.
_KEY_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
             "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def key_text(**columns: Column) -> Column:
    """One text for values of any type; equal for equal values only, so that it can stand for them as a key."""
    return F.to_json(F.struct(*[c.alias(name) for name, c in columns.items()]), _KEY_JSON)


def from_key_text(text: Column, schema: T.StructType) -> Column:
    return F.from_json(text, schema, _KEY_JSON)


def upper(c: Column) -> Column:
    return F.upper(c)


def plus_one(c: Column) -> Column:
    """``id + 1``; with ANSI mode on, overflow raises instead of wrapping."""
    return c + F.lit(1)


# ISO-8601 with millisecond precision, as TIMESTAMP(3) values are written by
# the reference's JSON format.
ISO_8601_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def to_json_record(*cols: str, timestamp_format: str = ISO_8601_MS) -> Column:
    """One JSON object per row from the named columns (a Kafka ``value``); null fields are written as null."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]),
                     {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format,
                      "ignoreNullFields": "false"})


def from_json_record(value: Column, schema: str, timestamp_format: str | None = None) -> Column:
    """Parse a JSON object column against a DDL schema string.

    Without a format, times are ISO-8601 with any fraction of seconds, and
    with or without a zone.
    """
    opts = {}
    if timestamp_format:
        opts = {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format}
    return F.from_json(value, schema, opts)
