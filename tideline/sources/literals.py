"""Literal sources: the small inline datasets the reference's jobs embed.

Used by tests and examples; registered queries read the driver's tables.
Each literal stream carries an arrival sequence ``seq`` so "first" is defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The reference's order list, in arrival order (two duplicates).
ORDERS_WITH_DUPLICATES = [
    (1, "John", "apple"),
    (2, "Chris", "tomato"),
    (3, "Ethan", "mango"),
    (1, "John", "apple"),
    (4, "Chris", "banana"),
    (3, "Ethan", "mango"),
]
ORDER_SCHEMA = "orderId int, userName string, product string"

# The reference's string stream and its price table.
NAMES = ["Alice", "Bob", "John"]
PRICE_ROWS = [(1760, "TCS"), (788, "INFY"), (1760, "TCS")]


def orders(spark: SparkSession) -> DataFrame:
    rows = [(*r, i) for i, r in enumerate(ORDERS_WITH_DUPLICATES)]
    return spark.createDataFrame(rows, ORDER_SCHEMA + ", seq int")


def names(spark: SparkSession) -> DataFrame:
    """A stream of strings as a one-column table ``f0``."""
    return spark.createDataFrame([(n,) for n in NAMES], "f0 string")


def from_elements(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A table from literal rows with inferred types; duplicate rows are kept."""
    return spark.createDataFrame(rows, columns)


def price_rows(spark: SparkSession) -> DataFrame:
    return from_elements(spark, PRICE_ROWS, ["price", "script"])
