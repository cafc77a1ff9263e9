"""Connected components of a table of links, by repeated contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch

ROWS_A_FILE = 200_000


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for every node of ``links`` (columns ``a``, ``b``): the smallest node reachable.

    Each round hooks every label that still has links onto the smallest label beside it, jumps one
    step further, and rewrites the links between labels; links inside a component vanish, so the table shrinks each round and a
    chain of n nodes takes about log n rounds. Every step is an aggregate with a map-side part or a
    join, so a node with very many links is never gathered in one task. Labels only ever sink and the
    smallest node of a component keeps its own, so the last label is the smallest node.
    Empty links give an empty table; loops and repeated links change nothing."""
    edges, labels = links.select("a", "b").filter("a <> b").distinct(), None
    parts = 1 + links.count() // ROWS_A_FILE  # small tables stay in few files
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    while True:
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = around.groupBy(F.col("a").alias("label")).agg(F.min("b").alias("m")).select("label", F.least("label", "m").alias("to"))
        hook = scratch.keep(hook.coalesce(parts))
        jump = hook.select(F.col("label").alias("to"), F.col("to").alias("next"))
        hook = scratch.keep(hook.join(jump, "to").select("label", F.col("next").alias("to")).coalesce(parts))
        if labels is None:
            labels = nodes.join(hook, nodes.node == hook.label, "left").select("node", F.coalesce("to", "node").alias("label"))
        else:
            labels = labels.join(hook, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        labels = scratch.keep(labels.coalesce(parts))
        to_a, to_b = hook.toDF("a", "la"), hook.toDF("b", "lb")
        edges = scratch.keep(
            edges.join(to_a, "a").join(to_b, "b").filter("la <> lb")
            .select(F.greatest("la", "lb").alias("a"), F.least("la", "lb").alias("b")).distinct().coalesce(parts)
        )
        if edges.isEmpty():
            return labels
