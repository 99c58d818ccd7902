"""Chat formatting from reply trees.

Messages point to the message that they reply to. Self-joins that double
their reach (a message's parent, the parent's parent, four above, ...) give
every message its root and the score of its path, after about log2(depth)
rounds. Leaves are ranked within their tree by the score of their path, and
the chosen branches are walked back from leaf to root through the same tables
of jumps. Each path becomes one conversation: turns between control strings,
with control strings inside texts escaped reversibly, and a loss mask, the
spans of the assistant's texts.

A round's table holds a row per message and is written to the shared folder.
Messages are keyed by tree and message, so a large tree is spread over many
tasks until its chosen path, one row of the result, is put together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import written

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
#: Fixed escapes, in the order in which they are applied; undone in reverse. No other backslash survives the first.
ESCAPES = (("\\", "\\e"), ("<|", "<\\p"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\l"))


def _escaped(text: Column, escapes) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: str, escapes=ESCAPES) -> str:
    for plain, code in reversed(escapes):
        text = text.replace(code, plain)
    return text


def branches(messages: DataFrame, per_tree: int | None = 1) -> DataFrame:
    """Paths from root to leaf, ``per_tree`` of each tree (None: all).

    ``messages``: tree, id (unique in its tree), parent (null: a root), score,
    and whatever else. A message whose parent is not there is a root too;
    messages that reply in a circle belong to no path. Paths rank by the sum
    of their scores (null: 0), then by length and the smaller id of the leaf.
    Returns tree, leaf, rank, id, depth (0: the root). Null trees are one tree.
    Neither texts, whatever their length, nor further columns are read; an
    empty table has no paths.
    """
    own = messages.select("tree", "id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    up = own.select(F.col("tree").alias("t"), F.col("id").alias("i"))
    linked = own.join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("i")), "left")
    # above: the message 2^k steps up, if there is one; steps and score: of the path to there, or to the root.
    level = written(linked.select("tree", "id", F.col("i").alias("above"), "score",
                                  F.when(F.col("i").isNull(), 0).otherwise(1).cast("long").alias("steps")), "jumps")
    # Messages that have reached their root are done; a round moves the others only.
    done, moving, reach = [level.filter("above is null")], level.filter("above is not null"), 1
    jumps, count = [moving.select("tree", "id", "above")], level.count()
    while reach <= count and not moving.isEmpty():
        far = reduce(DataFrame.unionAll, [*done, moving]).select(
            F.col("tree").alias("t"), F.col("id").alias("i"), F.col("above").alias("a2"), F.col("score").alias("s2"),
            F.col("steps").alias("n2"))
        doubled = moving.join(far, F.col("tree").eqNullSafe(F.col("t")) & (F.col("above") == F.col("i"))).select(
            "tree", "id", F.col("a2").alias("above"), (F.col("score") + F.col("s2")).alias("score"),
            (F.col("steps") + F.col("n2")).alias("steps"))
        level, reach = written(doubled, "jumps"), reach * 2
        done.append(level.filter("above is null"))
        moving = level.filter("above is not null")
        jumps.append(moving.select("tree", "id", "above"))

    parents = own.select(F.col("tree").alias("t"), F.col("parent").alias("p")).filter("p is not null").distinct()
    leaves = reduce(DataFrame.unionAll, done).join(
        parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("p")), "left_anti")
    best = [F.col("score").desc(), F.col("steps").desc(), F.col("id")]
    if per_tree == 1:  # one hash aggregate instead of a sort of each tree's leaves
        top = leaves.groupBy("tree").agg(F.min(F.struct(-F.col("score"), -F.col("steps"), "id")).alias("b"))
        chosen = top.select("tree", F.col("b.id").alias("leaf"), (-F.col("b.col2")).alias("steps"), F.lit(1).alias("rank"))
    else:
        ranked = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*best)))
        ranked = ranked if per_tree is None else ranked.filter(F.col("rank") <= per_tree)
        chosen = ranked.select("tree", F.col("id").alias("leaf"), "steps", "rank")
    # From the longest jump to the shortest, every path's known messages jump; each is reached by one sum of jumps.
    path = chosen.select("tree", "leaf", "rank", F.col("leaf").alias("id"), F.col("steps").alias("depth"))
    for k in reversed(range(len(jumps))):
        j = jumps[k].select(F.col("tree").alias("t"), F.col("id").alias("i"), "above")
        more = path.join(j, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("i"))).select(
            "tree", "leaf", "rank", F.col("above").alias("id"), (F.col("depth") - 2 ** k).alias("depth"))
        path = written(path.unionAll(more), "paths")
    return path


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """One conversation per path: tree, leaf, rank, n_turns, formatted, loss_spans.

    ``messages``: tree, id, role, text; a null role or text is empty.
    loss_spans: (start, end) of each assistant text in ``formatted``, in code
    points, in order. Very long texts are kept whole, one conversation in one
    row; empty tables give an empty result; further columns are not read.
    """
    own = messages.select(F.col("tree").alias("t"), F.col("id").alias("i"),
                          _escaped(F.coalesce("role", F.lit("")), ROLE_ESCAPES).alias("role"),
                          _escaped(F.coalesce("text", F.lit("")), ESCAPES).alias("text"))
    turns = paths.join(own, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("i")))
    turns = turns.withColumn("head", F.concat(F.lit(START), "role", F.lit("\n"))).withColumn(
        "turn", F.concat("head", "text", F.lit(END + "\n")))
    w = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("start", F.sum(F.char_length("turn")).over(w) - F.char_length("turn") + F.char_length("head"))
    span = F.when(F.col("role") == LEARNED, F.struct(F.col("start").cast("long").alias("start"),
                                                     (F.col("start") + F.char_length("text")).cast("long").alias("end")))
    grouped = turns.groupBy("tree", "leaf", "rank").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("depth", "turn"))), lambda x: x["turn"]), "").alias("formatted"),
        F.array_sort(F.collect_list(span)).alias("loss_spans"))
    return grouped


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(END + "\n", line)
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        out.append((unescape(formatted[at + len(START):line], ROLE_ESCAPES), unescape(formatted[line + 1:end])))
        at = end + len(END) + 1
    return out


def digests(conversations: DataFrame) -> DataFrame:
    """What the output of ``format_paths`` says when it is read: tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    An empty table gives an empty result; further columns are not read.
    """
    from tideline.llm.common import with_fields

    columns = {"n_turns": "long", "turns_sha256": "string", "loss_chars": "long", "loss_sha256": "string", "formatted_chars": "long"}

    def read(batches) -> Iterator:
        import hashlib

        import pyarrow as pa

        for batch in batches:
            rows = []
            for formatted, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read_back(formatted)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                loss = "".join(unescape(formatted[s["start"]:s["end"]]) for s in spans)
                sha = lambda x: hashlib.sha256(x.encode("utf-8", "replace")).hexdigest()
                rows.append((len(turns), sha(said), len(loss), sha(loss), len(formatted)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["tree", *columns])

    kept = conversations.select("tree", "formatted", "loss_spans")
    return kept.mapInArrow(read, with_fields(conversations.select("tree").schema, **columns))


def threads(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of linear conversations: each turn replies to the one before it.

    Turns of equal number follow each other by role and text, null turns
    come first; turns repeated in full are all kept.
    """
    w = Window.partitionBy(conv_id).orderBy(turn, role, text)
    rows = turns.select(F.col(conv_id).alias("tree"), F.col(role).alias("role"), F.col(text).alias("text"),
                        F.row_number().over(w).cast("long").alias("id"))
    return rows.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")
