"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import cut_lineage, release


def components(edges: DataFrame) -> DataFrame:
    """node and label (the least node of its component) of every node in edges (a, b).

    In a round every node points to its least neighbour, pointers are followed to their
    ends, and the edges are drawn between those ends; edges inside one tree go. Each round
    joins every tree that has an edge left with another, so trees halve at least. Only
    nodes' pointers and edges move between executors, nothing comes to the driver.
    """
    edges = distinct_edges(edges.select("a", "b"))
    labels = None
    while True:
        other = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")), F.struct(F.col("b").alias("node"), F.col("a").alias("to")))).alias("e")).select("e.*")
        ends = follow(cut_lineage(other.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("label"))))
        if labels is None:
            labels = ends
        else:
            further = ends.select(F.col("node").alias("label"), F.col("label").alias("further"))
            before, labels = labels, cut_lineage(labels.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label")))
            release(before)
        of = lambda c: ends.select(F.col("node").alias(c), F.col("label").alias(f"{c}_end"))
        before, edges = edges, distinct_edges(edges.join(of("a"), "a").join(of("b"), "b").select(F.col("a_end").alias("a"), F.col("b_end").alias("b")))
        release(before)
        if edges.isEmpty():
            return labels


def distinct_edges(edges: DataFrame) -> DataFrame:
    return cut_lineage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def follow(ends: DataFrame) -> DataFrame:
    """Labels' labels, until they don't change; the way halves each time. The given checkpoint is deleted."""
    while True:
        further = ends.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = cut_lineage(ends.select("node", "label").join(further, "label").select("node", F.col("further").alias("label"), (F.col("label") != F.col("further")).alias("moved")))
        release(ends)
        ends = step
        if step.filter("moved").isEmpty():
            return step.select("node", "label")
