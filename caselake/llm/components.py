"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: bigint); label is the smallest node
    reachable. Self loops and repeated edges are allowed; an empty table gives an empty one.

    Each round sends the smallest neighbouring label to a node and to the node's present
    root, then replaces labels by their label, so the number of rounds is about
    logarithmic in the longest path. Messages are pre-aggregated before the shuffle, and
    both join sides are staged tables, so adaptive execution can split a hot node.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    pairs = stage(both, "cc-edges")
    labels = stage(
        pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("label")), "cc-labels")
    total = _total(labels)
    while True:
        near = (
            pairs.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        )
        told = near.join(labels, "node")
        hooked = stage(
            labels.union(told.select("node", "m")).union(told.select("label", "m"))
            .groupBy("node").agg(F.min("label").alias("label")), "cc-hooked")
        roots = hooked.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = stage(hooked.join(roots, "label").select("node", F.col("root").alias("label")), "cc-labels")
        now = _total(labels)
        if now == total:
            return labels
        total = now


def _total(labels: DataFrame):
    """Labels only ever fall, so their exact sum changes if and only if a label does."""
    return labels.agg(F.sum(F.col("label").cast("decimal(20,0)"))).first()[0]
