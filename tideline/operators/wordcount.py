"""Word frequencies over a text column (lateral split + continuous COUNT)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalar import split_whitespace_raw
from tideline.functions.udtf import register_split_lines, register_split_words
from tideline.session import ship_package


def words(df: DataFrame, text: str, word: str = "word") -> DataFrame:
    """One row per whitespace token, as Python's ``str.split()``.

    Rows with no token produce nothing (a lateral join with an empty table
    function result drops the row). The split regex can leave one empty
    token at each end; it is filtered after the explode, which keeps the
    whole projection inside generated code.
    """
    return (df.select(F.explode(split_whitespace_raw(F.col(text))).alias(word))
              .filter(F.col(word) != F.lit("")))


def word_counts(df: DataFrame, text: str, word: str = "word", count: str = "count") -> DataFrame:
    """``SELECT w, COUNT(*) FROM t, LATERAL split(text) GROUP BY w``.

    The count aggregates partially before the shuffle, so frequent words
    are combined map-side instead of landing on one reducer unreduced.
    """
    return words(df, text, word).groupBy(word).agg(F.count(F.lit(1)).alias(count))


def word_counts_sql(spark: SparkSession, df: DataFrame, text: str, function: str | None = None) -> DataFrame:
    """The same count through a registered Python table function and SQL (the reference's form).

    A bounded table goes to the vectorized function as a table argument; a
    stream is joined laterally with the row-wise one.
    """
    ship_package(spark)
    lines = df.select(F.col(text).alias("line"))
    if df.isStreaming:
        words_of = f"{{lines}}, LATERAL {register_split_words(spark, function or 'split_words')}(line) AS T"
    else:
        words_of = f"{register_split_lines(spark, function or 'split_lines')}(TABLE({{lines}})) AS T"
    return spark.sql(f"SELECT T.word AS word, COUNT(*) AS `count` FROM {words_of} GROUP BY T.word", lines=lines)
