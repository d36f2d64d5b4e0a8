"""Groups of duplicates: components of a graph of matches, their canonical members, and applying or undoing them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.delta import latest
from lodestar.runtime import cut_lineage


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each.

    ``nodes`` has node, ``edges`` has a and b; null ends and loops link nothing. In each round every node joins its smallest
    neighbour and edges move to what was joined, so the graph shrinks by a factor and hubs vanish first.
    """
    edges = cut_lineage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        joins = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to")))
        rounds.append(joins)
        a, b = joins.select(F.col("node").alias("a"), F.col("to").alias("x")), joins.select(F.col("node").alias("b"), F.col("to").alias("y"))
        # The own step of a node is kept as an edge too: it may have joined a node that itself joins another.
        moved = edges.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        edges = cut_lineage(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        steps = joins.where("node <> to").select(F.col("to").alias("a")).distinct().join(joins.where("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b")), "a")
        edges = cut_lineage(edges.unionByName(steps.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct())
    labels = None
    for joins in reversed(rounds):
        later = None if labels is None else labels.select(F.col("node").alias("to"), F.col("component").alias("end"))
        labels = joins.select("node", F.col("to").alias("component")) if later is None else joins.join(later, "to", "left").select("node", F.coalesce("end", "to").alias("component"))
    nodes = nodes.select("node").distinct()
    return nodes.withColumn("component", F.col("node")) if labels is None else nodes.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def canonical_members(members: DataFrame) -> DataFrame:
    """(component, canonical): of each component the member with the highest score, then the longest text, then the smallest name."""
    best = latest(members, ["component"], F.desc_nulls_last("score"), F.desc("length"), F.asc("node"))
    return best.select("component", F.col("node").alias("canonical"))


def apply_duplicates(table: DataFrame, duplicates: DataFrame, key: str) -> DataFrame:
    """Sets status to ``duplicate`` for the keys given.

    ``prev_status`` keeps the first status that was replaced, and ``marked`` that it was, as that status may have been null.
    """
    hit = table.join(duplicates.select(F.col(key), F.lit(True).alias("_hit")).distinct(), key, "left")
    now = F.coalesce("_hit", F.lit(False)) & (F.coalesce("status", F.lit("")) != "duplicate")
    before = F.col("prev_status") if "prev_status" in table.columns else F.lit(None).cast("string")
    marked = F.col("marked") if "marked" in table.columns else F.lit(False)
    hit = hit.withColumn("prev_status", F.when(now, F.col("status")).otherwise(before)).withColumn("marked", now | marked)
    return hit.withColumn("status", F.when(F.col("_hit"), "duplicate").otherwise(F.col("status"))).drop("_hit")


def reset_duplicates(table: DataFrame) -> DataFrame:
    """Undoes :func:`apply_duplicates`, also where the status was null."""
    status = F.when(F.col("marked"), F.col("prev_status")).otherwise(F.col("status"))
    return table.withColumn("status", status).withColumn("prev_status", F.lit(None).cast("string")).withColumn("marked", F.lit(False))
