"""Connected components of an undirected edge table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.llm.tables import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, component)`` for every end of ``edges (a, b)``: the smallest id reachable.

    Each round a node takes the smallest label among its neighbours' and its own, then the
    label of its label (pointer jumping), so chains shorten by halves. Labels of a round are
    a written table; the driver sees one count per round. A node with many edges costs a
    partial minimum in each task, not a task of its own.
    """
    both = scratch.keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    table = labels = scratch.keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "id"))
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        nearest = labels.join(near, labels.id == near.a, "left").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        step = scratch.keep(nearest)
        jump = labels.select(F.col("id").alias("at"), F.col("component").alias("far"))
        fresh = scratch.keep(
            step.join(jump, step.component == jump["at"], "left").select("id", "old", F.least("component", "far").alias("component"))
        )
        moved = fresh.where("component <> old").limit(1).count()
        scratch.drop(table, step)
        table, labels = fresh, fresh.select("id", "component")
        if not moved:
            return labels
