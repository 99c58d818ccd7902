"""Python table functions that split lines into words (``str.split()``).

* ``SplitColumn``: ``FROM split_lines(TABLE(lines))``. It is given the first
  column of the table as Arrow batches and gives words as Arrow columns of
  bounded size, however many lines a batch has and however long they are.
* ``SplitWords``: ``FROM lines, LATERAL split_words(line)``. Spark runs
  lateral table functions row by row; Arrow ones are refused there.

The native ``explode(split_whitespace(col))`` gives the same rows without
leaving the JVM and is what ``word_counts`` uses by default.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf, udtf


@udtf(returnType="word string", useArrow=True)
class SplitWords:
    def eval(self, line: str | None):
        if line is None:
            return
        for w in line.split():
            yield (w,)


#: Characters of lines that are split at once.
BLOCK_CHARS = 1 << 20


def _word_lists(column):
    """The words of a column's lines, in lists of at most about ``BLOCK_CHARS`` characters."""
    import re
    from itertools import islice

    words, held = [], 0
    for i in range(len(column)):
        line = column[i].as_py()
        if line is None:
            continue
        if len(line) > BLOCK_CHARS:
            if words:
                yield words
                words, held = [], 0
            # \s is what str.split() splits at.
            found = (m.group() for m in re.finditer(r"\S+", line))
            while some := list(islice(found, BLOCK_CHARS // 8)):
                yield some
            continue
        words += line.split()
        held += len(line)
        if held >= BLOCK_CHARS:
            yield words
            words, held = [], 0
    if words:
        yield words


@arrow_udtf(returnType="word string")
class SplitColumn:
    def eval(self, batch):
        import pyarrow as pa

        for words in _word_lists(batch.column(0)):
            yield pa.table({"word": pa.array(words, pa.string())})


def register_split_words(spark: SparkSession, name: str = "split_words") -> str:
    """Register the row-wise table function for lateral joins in SQL under ``name``."""
    spark.udtf.register(name, SplitWords)
    return name


def register_split_lines(spark: SparkSession, name: str = "split_lines") -> str:
    """Register the vectorized table function, which takes a table of one text column, under ``name``."""
    spark.udtf.register(name, SplitColumn)
    return name
