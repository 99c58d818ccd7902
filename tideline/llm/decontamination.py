"""Benchmark decontamination by spaced-seed hashing.

A mask is a fixed pattern of token positions; the others are ignored. The
hash of the masked tokens at each position of a benchmark item meets that of
each position of a document. Around each meeting the two token runs are
compared place by place: a passage is found if ``WINDOW`` tokens in a row that
hold the meeting agree in ``SIMILARITY`` of their places or more. The two
masks together are lossless for that: whatever two tokens of thirteen are
substituted, one mask has a position that sees neither.

With DataFrame functions only. Hashes of a benchmark of up to
``BROADCAST_TOKENS`` tokens go to the executors and documents are not
shuffled; beyond it both sides are shuffled by hash, where adaptive execution
splits hot ones, and only the meetings return to their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 13
SIMILARITY = 0.8
#: Fixed masks: places of the tokens that count.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SPAN = 8
BROADCAST_TOKENS = 500_000


def token_hashes(text: str) -> Column:
    """Hash of each run of letters and digits of a text, lower-cased (null: none)."""
    runs = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(runs, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(df: DataFrame, tokens: str, keep: list[str]) -> DataFrame:
    """A row for each position and mask: ``keep``, at, h."""
    t = F.col(tokens)
    at = df.filter(F.size(t) >= SPAN).select(*keep, tokens, F.explode(F.sequence(F.lit(0), F.size(t) - SPAN)).alias("at"))
    hashes = [F.xxhash64(F.lit(i), *[t[F.col("at") + o] for o in mask]) for i, mask in enumerate(MASKS)]
    return at.select(*keep, *([] if tokens in keep else [tokens]), "at", F.explode(F.array(*hashes)).alias("h"))


def _verified(meetings: DataFrame) -> DataFrame:
    """Of rows with dt, it (tokens), d, j (places of a meeting): those with an alike window, and the best one's matches."""
    shift = F.col("d") - F.col("j")
    window = F.least(F.lit(WINDOW), F.size("it"))
    low = F.greatest(F.lit(0), -shift, F.col("j") + SPAN - window)
    high = F.least(F.size("it"), F.size("dt") - shift, F.col("j") + window)
    rows = meetings.select("*", shift.alias("shift"), window.alias("window"), low.alias("low"), high.alias("high")).filter(
        F.col("high") - F.col("low") >= F.col("window"))
    pairs = F.zip_with(F.slice("it", F.col("low") + 1, F.col("high") - F.col("low")),
                       F.slice("dt", F.col("low") + F.col("shift") + 1, F.col("high") - F.col("low")),
                       lambda a, b: F.when(a == b, 1).otherwise(0))
    alike = F.transform(F.sequence(F.lit(0), F.size("same") - F.col("window")), lambda s: F.struct(
        F.aggregate(F.slice("same", s + 1, F.col("window")), F.lit(0), lambda a, x: a + x).alias("matched"),
        (-(F.col("low") + F.col("shift") + s)).alias("minus_start")))
    best = rows.withColumn("same", pairs).withColumn("best", F.array_max(alike))
    # Items shorter than the window have to agree in full: there the masks see every case.
    least = F.when(F.col("window") < WINDOW, F.col("window")).otherwise(F.ceil(F.lit(SIMILARITY) * F.col("window")))
    return best.filter(F.col("best.matched") >= least)


def contaminated(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """A row for each document (id and text hash) and item that share a passage.

    Columns: id, item_id, matched and window (of the best passage, the first
    of several), similarity, doc_start (its place in tokens), text_hash. Rows
    repeated in full are one; null texts and empty tables share nothing. Very
    long texts are searched whole. Items
    of fewer than ``WINDOW`` tokens must occur in full; those of fewer than
    ``SPAN`` tokens are told from chance by nothing and never found. Further
    columns are not read.
    """
    docs = df.filter(F.col(text).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), token_hashes(text).alias("dt"))
    known = items.select(F.col(item_id).alias("item"), token_hashes(item_text).alias("it")).distinct().withColumn(
        "k", F.xxhash64("item", "it"))
    size = known.agg(F.sum(F.size("it"))).first()[0] or 0
    seeds = _seeds(known, "it", ["k"]).select("k", F.col("at").alias("j"), "h")
    if size <= broadcast_tokens:
        meetings = _seeds(docs, "dt", ["id", "th", "dt"]).withColumnRenamed("at", "d").join(F.broadcast(seeds), "h").join(
            F.broadcast(known), "k")
    else:
        met = _seeds(docs, "dt", ["id", "th"]).select("id", "th", F.col("at").alias("d"), "h").join(seeds, "h").select(
            "id", "th", "d", "k", "j").distinct()
        own = docs.select(F.col("id").alias("i2"), F.col("th").alias("t2"), "dt").dropDuplicates(["i2", "t2"])
        meetings = met.join(own, F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("t2"))).join(known, "k")
    found = _verified(meetings).groupBy("id", "th", "item").agg(
        F.max(F.struct((F.col("best.matched") / F.col("window")).alias("similarity"), F.col("best.matched").alias("matched"),
                       F.col("best.minus_start").alias("minus_start"), "window")).alias("b"))
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_id), "b.matched", "b.window", "b.similarity",
                        (-F.col("b.minus_start")).alias("doc_start"), F.col("th").alias("text_hash"))
