"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.frames import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); the label is the smallest node.

    Large and small stars in turn: every node passes its smallest neighbour on to its
    other neighbours until all edges lead to the smallest node of their component.
    Smallest neighbours are found by aggregation before the shuffle, so a node with very
    many edges costs one row per task there, and the join back can be split.
    """
    pair = lambda a, b: F.array_sort(F.array(a, b))
    ordered = edges.where("a <> b").select(pair("a", "b").alias("e")).distinct()
    graph = durable(ordered.select(F.col("e")[1].alias("u"), F.col("e")[0].alias("v")))
    state = _state(graph)
    while state[0]:
        both = graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        graph = durable(small)
        before, state = state, _state(graph)
        if state == before:
            break
    label = graph.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return label.unionByName(graph.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _state(graph: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(graph.agg(F.count("*"), digest).head())
