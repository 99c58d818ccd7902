"""Connected components of a link table, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of a link: label is the smallest node that links reach.

    Each round takes the label of a node's label, then the smallest of these
    among the node and its neighbours. A round's labels, one row per node, are
    written once to the shared folder, and the driver gets one flag. A node
    with very many links is combined map-side; both joins read written tables,
    so adaptive execution splits the partition of such a node or label.
    """
    a, b = F.col(a), F.col(b)
    ways = F.array(*[F.struct(x.alias("a"), y.alias("b")) for x, y in ((a, b), (b, a), (a, a), (b, b))])
    edges = written(links.select(F.inline(ways)).distinct(), "links")  # both ways, and each node's own
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "labels")
    while True:
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = labels.join(jump, "label", "left").select(
            "node", F.least("label", "further").alias("label"), F.col("label").alias("old"))
        own = F.when(F.col("a") == F.col("b"), F.col("old"))
        state = written(edges.join(jumped, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node"))
                        .agg(F.min("label").alias("label"), F.max(own).alias("old")), "labels")
        labels = state.select("node", "label")
        if state.filter(F.col("label") != F.col("old")).isEmpty():
            return labels
