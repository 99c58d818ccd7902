"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

The corpus is cut into blocks of ``block`` words. Each source has a target:
its weight's share of all words, at most ``cap`` times its own size; what a
cap leaves over goes to the other sources by weight until none is above. The
seats of the mix, one per block, go to the sources by highest quotients
target / (2 k + 1), then the seats of a source to its shards in the same way
by their sizes. Each shard has its texts in an order drawn by ``seed`` and
takes as many of its blocks as it has seats: whole rounds first, and the rest
from the beginning of that order.

Highest quotients need no loop over seats. With n parties and s seats, the
final divisor lies between total / (s + n/2) and total / (s - n/2), so all but
some 3 n quotients are decided beforehand, and only those are ranked.

Rows fall into ``FINEST`` bins of a source by their draw, and bins into shards
of some ``SHARD_WORDS`` words, whose number depends on the data alone. Rows are
moved once, keyed by source and bin: a source with a third of all words is
thousands of tasks' worth of bins. Only the table of sources, one short row
each, is ranked in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import WORD_REGEX, without, written

BLOCK = 16
SHARD_WORDS = 4_000_000
#: Bins of a source.
FINEST = 1 << 16


def word_count(text: str) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def apportion(parties: DataFrame, group: list[str], party: list[str], votes: str, seats: str) -> DataFrame:
    """(group, party, won): the ``seats`` of each group dealt to its parties by highest quotients.

    ``seats`` is the same in all rows of a group. Ties go to the party first
    in order; a party without votes wins nothing, and without any votes no
    seat is dealt. Keys may be null. A group's parties are ranked in one task.
    """
    of_group = Window.partitionBy(*group)
    v, s = F.col("__v"), F.col("__seats")
    known = parties.select(*group, *party, F.col(votes).cast("double").alias("__v"), F.col(seats).alias("__seats")).filter(v > 0)
    known = known.withColumn("__n", F.count(F.lit(1)).over(of_group)).withColumn("__t", F.sum("__v").over(of_group))
    low = F.greatest(F.lit(0), F.ceil(v * (s - F.col("__n") / 2) / F.col("__t") - 0.5) - 1).cast("long")
    high = (F.floor(v * (s + F.col("__n") / 2) / F.col("__t") + 0.5) + 1).cast("long")
    known = known.withColumn("__low", low).withColumn("__left", s - F.sum("__low").over(of_group))
    open_seats = known.select("*", F.explode(F.sequence(F.col("__low"), high)).alias("__k"))
    best = Window.partitionBy(*group).orderBy((v / (2 * F.col("__k") + 1)).desc(), *[F.col(p).asc_nulls_last() for p in party])
    ranked = open_seats.withColumn("__r", F.row_number().over(best))
    won = F.col("__low") + F.sum(F.when(F.col("__r") <= F.col("__left"), 1).otherwise(0))
    return ranked.groupBy(*group, *party, "__low").agg(won.cast("long").alias("won")).drop("__low")


def _targets(sources: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Add ``target``; the driver sees sums only."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    sources = written(sources.withColumn("w", pick), "sources")
    most = F.lit(float(cap)) * F.col("source_size")
    level, full = 0.0, -1
    while True:  # the level only rises, and each rise caps another source
        capped = most < F.col("w") * F.lit(level)
        row = sources.agg(F.sum("source_size").alias("t"), F.count(F.when(capped, 1)).alias("n"),
                          F.sum(F.when(capped, most)).alias("c"), F.sum(F.when(~capped, F.col("w"))).alias("w")).first()
        if row["n"] == full or not row["w"]:
            break
        full, level = row["n"], (share * float(row["t"] or 0) - (row["c"] or 0.0)) / row["w"]
    return sources.withColumn("target", F.least(most, F.col("w") * F.lit(level)))


def mix(df: DataFrame, size: str, source: str = "source", id_col: str = "doc_id",
        weights: tuple[float, ...] = (1, 2, 3), share: float = 1.0, cap: int = 3, block: int = BLOCK,
        seed: int = 17, shard_words: int = SHARD_WORDS) -> DataFrame:
    """All rows of ``df`` and source_size, target, taken.

    ``size`` is a text's words; sources by code point, null last, take the
    ``weights`` in turn; the mix holds ``share`` of all words. ``taken`` counts
    the words of a row in the mix with repeats, at most ``cap`` times its size.
    Rows alike in id and size are interchangeable; null ids are as good as
    others; an empty table gives an empty result; columns of ``df`` with the
    names of the outputs are replaced.
    """
    df = without(df, ["source_size", "target", "taken"], keep=(size, source, id_col))
    draw = F.xxhash64(F.lit(seed), F.col(id_col), F.col(size))
    key = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))  # the null source has a key too
    rows = df.withColumn("__h", draw).withColumn("__s", key).withColumn(
        "__m", F.pmod(F.shiftrightunsigned("__h", 40), F.lit(FINEST)).cast("int"))

    bins = written(rows.groupBy("__s", F.col(source).alias("source"), F.col("__m").alias("m"))
                   .agg(F.sum(size).alias("words")), "bins")
    sources = _targets(bins.groupBy("__s", "source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    seats = sources.withColumn("all", F.lit(0)).withColumn(
        "seats", F.round(F.sum("target").over(Window.partitionBy("all")) / block).cast("long"))
    won = apportion(seats, ["all"], ["source"], "target", "seats").withColumn(
        "__s", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
    wanted = F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("source_size") / shard_words)))
    sources = written(sources.join(won.select("__s", "won"), "__s", "left").select(
        "__s", "source_size", "target", F.coalesce("won", F.lit(0)).alias("quota"),
        F.least(F.lit(FINEST), F.pow(F.lit(2.0), wanted)).cast("int").alias("shards")), "quotas")

    bins = bins.select("__s", "m", "words").join(sources, "__s").withColumn("shard", F.pmod("m", "shards"))
    shards = bins.groupBy("__s", "shard").agg(F.sum("words").alias("shard_size"), F.max("quota").alias("quota"))
    dealt = apportion(shards, ["__s"], ["shard"], "shard_size", "quota")
    shards = shards.join(dealt, ["__s", "shard"], "left").select("__s", "shard", "shard_size", F.least(
        F.coalesce("won", F.lit(0)) * block, cap * F.col("shard_size")).alias("due"))
    in_shard = Window.partitionBy("__s", "shard").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("first", F.sum("words").over(in_shard) - F.col("words"))
    plan = written(bins.join(shards, ["__s", "shard"]).select(
        "__s", F.col("m").alias("__m"), "source_size", "target", F.col("first").alias("__first"),
        F.col("shard_size").alias("__size"), F.col("due").alias("__due")), "plan")

    joined = rows.join(plan, ["__s", "__m"])
    order = Window.partitionBy("__s", "__m").orderBy("__h", id_col, size).rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("__first") + F.sum(size).over(order) - F.col(size)
    rounds = F.when(F.col("__size") > 0, F.floor(F.col("__due") / F.col("__size"))).otherwise(0)
    rest = F.col("__due") - rounds * F.col("__size") - start
    taken = rounds * F.col(size) + F.greatest(F.lit(0), F.least(F.col(size), rest))
    return joined.withColumn("taken", taken.cast("long")).select(*df.columns, "source_size", "target", "taken")
