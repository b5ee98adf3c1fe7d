"""Connected components of an edge table, by label propagation with short cuts."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.frames import written


def components(edges: DataFrame) -> DataFrame:
    """node, label for each node of the edges (a, b): label is the least node
    that can be reached.

    A round gives each node the least label among its own and its neighbours'
    (folded before the shuffle, so a node with very many neighbours is one row
    per task), then the label of that label, which halves the length of chains.
    Rounds go on until nothing changes; each is written, so a lost executor costs
    one.
    """
    ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    loops = edges.select("a", F.col("a").alias("b")).union(edges.select(F.col("b").alias("a"), "b"))
    near = written(ends.union(loops).distinct(), "edges")
    labels = written(near.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "labels-0")
    for i in count(1):
        seen = near.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(
            F.min("label").alias("met"), F.max(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("old")
        )
        jump = labels.select(F.col("node").alias("met"), F.col("label").alias("far"))  # labels are nodes
        moved = seen.join(jump, "met").select(F.col("a").alias("node"), F.col("far").alias("label"), (F.col("far") < F.col("old")).alias("moved"))
        moved = written(moved, f"labels-{i}")
        labels = moved.select("node", "label")
        if not moved.where("moved").take(1):
            return labels
