"""Problem 2: one group identifier for all records that pairwise matches link, directly or through others.

Method: a two-dimensional grid. Vertices are hashed into blocks; each pair of blocks is one partition of edges, on which a
local union-find runs. A vertex then has one representative from each cell of its row and column; these are exchanged, the
smallest becomes its parent, and disagreeing representatives are the (far fewer) edges of the next round. When no
representatives disagree, the parents of all rounds are put together.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.runtime import cut_lineage, table


def union_find(left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """Root (the smallest number) of each of ``count`` vertices under the given edges.

    Edges are united in bulk: the larger root of every edge is hung under the smaller one, then all paths are halved.
    """
    parent = np.arange(count)
    while True:
        a, b = parent[left], parent[right]
        apart = a != b
        if not apart.any():
            return parent
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent = parent[parent]


def _unite_cell(cell: pd.DataFrame) -> pd.DataFrame:
    names, codes = np.unique(np.concatenate([cell["a"].to_numpy(object), cell["b"].to_numpy(object)]), return_inverse=True)
    half = len(cell)
    roots = union_find(codes[:half], codes[half:], len(names))
    return pd.DataFrame({"vertex": names, "rep": names[roots]})


def _one_round(edges: DataFrame, count: int, edges_per_cell: int) -> DataFrame:
    """(vertex, parent, reps) after local union-find on every cell; reps holds at most one name per cell of a row and column."""
    side = max(2, math.ceil(math.sqrt(count / edges_per_cell)))
    row, col = (F.pmod(F.xxhash64(c), F.lit(side)) for c in ("a", "b"))
    cells = edges.withColumn("row", F.least(row, col)).withColumn("col", F.greatest(row, col))
    # A hub fills the cells of its own row or column: such cells are cut into pieces. side x side rows, so a broadcast.
    pieces = cells.groupBy("row", "col").agg(F.ceil(F.count("*") / F.lit(edges_per_cell)).alias("pieces"))
    cells = cells.join(F.broadcast(pieces), ["row", "col"]).withColumn("piece", F.pmod(F.xxhash64("a", "b"), F.col("pieces")))
    local = cells.groupBy("row", "col", "piece").applyInPandas(_unite_cell, "vertex string, rep string")
    return local.groupBy("vertex").agg(F.min("rep").alias("parent"), F.collect_set("rep").alias("reps"))


def group_identifiers(pairs: DataFrame, left: str, right: str, edges_per_cell: int = 200_000) -> DataFrame:
    """(group_id, id): every distinct non-null value of ``left`` or ``right``, with the smallest id it is linked to.

    A pair with a null side or two equal sides links nothing, but its ids are in the result. Repeated pairs and pairs in
    both directions count once. Other columns of ``pairs``, whatever their names, play no part. An empty table gives no rows.
    Order of ids is that of code points.
    """
    pairs = pairs.select(F.col(left).cast("string").alias("a"), F.col(right).cast("string").alias("b"))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).where("id IS NOT NULL").distinct()
    edges = cut_lineage(
        pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    rounds: list[DataFrame] = []
    while count := edges.count():
        found = cut_lineage(_one_round(edges, count, edges_per_cell))
        rounds.append(found.select(F.col("vertex"), F.col("parent")))
        edges = cut_lineage(
            found.where(F.size("reps") > 1)
            .select(F.col("parent").alias("a"), F.explode("reps").alias("b"))
            .where("a <> b")
            .distinct()
        )
    if not rounds:
        return ids.select(F.col("id").alias("group_id"), "id")
    labels = rounds.pop()
    while rounds:
        later = labels.select(F.col("vertex").alias("parent"), F.col("parent").alias("root"))
        labels = rounds.pop().join(later, "parent", "left").select("vertex", F.coalesce("root", "parent").alias("parent"))
    labels = labels.withColumnRenamed("vertex", "id")
    return ids.join(labels, "id", "left").select(F.coalesce("parent", "id").alias("group_id"), "id")


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    groups = group_identifiers(table(spark, root, "dedup_map"), "slug", "canonical_slug")
    return groups.select(F.col("group_id").alias("group_slug"), F.col("id").alias("slug"))


def p2_group_sizes(spark: SparkSession, root: str) -> DataFrame:
    """How many groups there are of each size."""
    sizes = p2_found(spark, root).groupBy("group_slug").agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("groups"))


_GROUPS = """
WITH RECURSIVE pairs AS (
  SELECT slug AS a, canonical_slug AS b FROM dedup_map WHERE slug <> canonical_slug
  UNION SELECT canonical_slug, slug FROM dedup_map WHERE slug <> canonical_slug),
ids AS (SELECT slug FROM dedup_map WHERE slug IS NOT NULL UNION SELECT canonical_slug FROM dedup_map WHERE canonical_slug IS NOT NULL),
reach AS (SELECT slug AS a, slug AS b FROM ids UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON pairs.a = reach.b),
found AS (SELECT min(b) AS group_slug, a AS slug FROM reach GROUP BY a)
"""
QUERIES = {"p2_found": p2_found, "p2_group_sizes": p2_group_sizes}
ORACLES = {
    "p2_found": _GROUPS + "SELECT group_slug, slug FROM found",
    "p2_group_sizes": _GROUPS
    + "SELECT size, count(*) AS groups FROM (SELECT group_slug, count(*) AS size FROM found GROUP BY group_slug) GROUP BY size",
}
