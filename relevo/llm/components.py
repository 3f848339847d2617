"""Distributed connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.llm.frames import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is the smallest reachable node.

    Each round every node points to its smallest neighbour, pointers are followed to their roots
    by joining the pointer table with itself, and edges are contracted to roots, so the number of
    edges falls at least by half a round. Every table is written in the shared folder; the driver
    sees only whether rows are left. Null ends and loops are ignored; no edges give no rows.
    """
    live = written(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct(), "edges")
    labels = None
    while True:
        both = live.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            live.select(F.col("b").alias("node"), F.col("a").alias("other")))
        up = written(both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("up")), "up")
        while True:
            above = up.select(F.col("node").alias("up"), F.col("up").alias("higher"))
            next_up = written(up.join(above, "up", "left").select("node", F.col("up").alias("was"), F.coalesce("higher", "up").alias("up")), "up")
            moved = not next_up.where("was != up").isEmpty()
            up = next_up.select("node", "up")
            if not moved:
                break
        if labels is None:
            labels = up
        else:
            step = up.select(F.col("node").alias("up"), F.col("up").alias("higher"))
            labels = written(labels.join(step, "up", "left").select("node", F.coalesce("higher", "up").alias("up")), "labels")
        a = up.select(F.col("node").alias("a"), F.col("up").alias("root_a"))
        b = up.select(F.col("node").alias("b"), F.col("up").alias("root_b"))
        live = written(
            live.join(a, "a").join(b, "b").where("root_a != root_b")
            .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "edges")
        if live.isEmpty():
            return labels.select("node", F.col("up").alias("component"))
