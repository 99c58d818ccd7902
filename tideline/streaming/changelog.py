"""Continuous counts as a changelog: what each micro-batch retracts and what it puts in place.

``GROUP BY`` on a stream in update mode gives the new row of a key only. A
reader that keeps its own copy, or adds results up further, also has to know
the row that no longer holds. ``stream_changelog_counts`` gives both: ``+I``
for a key's first count, ``-U`` with the old count and ``+U`` with the new one
afterwards. Taking away every ``-U`` row and adding every other one, in any
order, leaves the current counts.

Rows are counted in their map task before they are shuffled, as far as the
counts take a bounded number of bytes, so a key that holds a third of all rows
sends few rows. Texts are coded as keys after that, once for each count. Keys are
dealt to ``key_groups`` groups; a group's counts are kept in levelled blocks
(see ``streaming.state``), so a batch writes its own keys, not the idle ones.
The changelog of a micro-batch is the same when it runs again after a failure.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.scalar import from_key_text, key_text
from tideline.operators.wordcount import words
from tideline.session import ship_package
from tideline.streaming.state import Levels

KEY_GROUPS = 64
INSERT, BEFORE, AFTER = "+I", "-U", "+U"
_COUNTS = pa.schema([("k", pa.string()), ("n", pa.int64())])
#: Bytes of counts that a map task gathers before it hands them on.
HELD_BYTES = 32 << 20


class ChangelogProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = Levels(handle, "counts", _COUNTS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        added = pd.concat([pdf[["k", "n"]] for pdf in rows]).groupby("k", sort=True)["n"].sum()
        known = self.counts.read()
        old = pd.Series(known["n"].to_numpy(), index=known["k"], dtype="int64").reindex(added.index)
        new = added + old.fillna(0).astype("int64")
        self.counts.add(pd.DataFrame({"k": new.index, "n": new.to_numpy()}))
        # A key's rows follow each other, the retracted one first.
        known = old.notna().to_numpy()
        at = np.repeat(np.arange(len(new)), 1 + known)
        retracted = np.append(at[1:] == at[:-1], False)[:len(at)]
        counts = np.where(retracted, old.fillna(0).to_numpy("int64")[at], new.to_numpy()[at])
        op = np.where(retracted, BEFORE, np.where(known[at], AFTER, INSERT)).astype(object)
        yield pd.DataFrame({"k": new.index.to_numpy()[at], "n": counts, "op": op})

    def close(self) -> None:
        pass


def _counted_here(batches):
    held, size = [], 0

    def added_up():
        counts = pa.TableGroupBy(pa.concat_tables(held), "k").aggregate([("n", "sum")])
        return counts.select(["k", "n_sum"]).rename_columns(["k", "n"])

    for batch in batches:
        counts = pa.TableGroupBy(pa.Table.from_batches([batch]), "k").aggregate([([], "count_all")])
        held.append(counts.select(["k", "count_all"]).rename_columns(["k", "n"]))
        size += held[-1].nbytes
        if size >= HELD_BYTES:
            held = [added_up()]
            size = held[0].nbytes
            if size >= HELD_BYTES // 2:
                yield from held[0].to_batches()
                held, size = [], 0
    if held:
        yield from added_up().to_batches()


def stream_changelog_counts(df: DataFrame, key: str, count: str = "count", op: str = "op",
                            key_groups: int = KEY_GROUPS) -> DataFrame:
    """Changelog of ``SELECT key, COUNT(*) GROUP BY key``: columns ``op``, ``key`` and ``count``; append mode.

    A null key is a key of its own. ``key_groups`` belongs to the checkpoint.
    """
    ship_package(df.sparkSession)
    kind = df.schema[key].dataType
    if kind == T.StringType():
        partial = df.select(F.col(key).alias("k")).mapInArrow(_counted_here, "k string, n long").select(key_text(k=F.col("k")).alias("k"), "n")
    else:
        partial = df.select(key_text(k=F.col(key)).alias("k")).mapInArrow(_counted_here, "k string, n long")
    grouped = partial.withColumn("g", F.pmod(F.xxhash64("k"), F.lit(key_groups))).groupBy("g")
    out = grouped.transformWithStateInPandas(statefulProcessor=ChangelogProcessor(), outputStructType="k string, n long, op string",
                                             outputMode="Append", timeMode="None")
    value = from_key_text(F.col("k"), T.StructType([T.StructField("k", kind)]))["k"]
    return out.select(F.col("op").alias(op), value.alias(key), F.col("n").alias(count))


def stream_word_changelog(df: DataFrame, text: str, word: str = "word", count: str = "count",
                          key_groups: int = KEY_GROUPS) -> DataFrame:
    """Changelog of the continuous word count."""
    return stream_changelog_counts(words(df, text, word), word, count, key_groups=key_groups)


def replayed_counts(changelog: DataFrame, key: str, count: str = "count", op: str = "op") -> DataFrame:
    """The current counts from all rows of a changelog, in any order: retracted rows cancel earlier ones."""
    sign = F.when(F.col(op) == BEFORE, F.lit(-1)).otherwise(F.lit(1))
    standing = changelog.groupBy(key, count).agg(F.sum(sign).alias("__left")).filter(F.col("__left") > 0)
    return standing.select(key, count)
