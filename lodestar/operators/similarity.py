"""Exact cosine search of a set of queries against all rows, in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

BLOCK_ROWS = 8_000
#: So many cosines are held at once; a block's queries are taken in steps of that size.
STEP_CELLS = 8_000_000


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c for c in column.chunks if len(c)]) if column.num_chunks else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _products(queries: pa.Table, rows: pa.Table, decimals: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids of some queries, ids of all rows, their rounded cosines), step by step; a row's cosine with itself is -2."""
    q, r, left, right = queries["id"].to_numpy(), rows["id"].to_numpy(), _matrix(queries["unit"]), _matrix(rows["unit"]).T
    step = max(1, STEP_CELLS // len(r))
    for at in range(0, len(q), step):
        some = q[at : at + step]
        cosines = np.round(left[at : at + step] @ right, decimals)
        cosines[some[:, None] == r[None]] = -2
        yield some, r, cosines


def _search(n: int, least: float, decimals: int):
    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        schema = pa.schema([("id", pa.int64()), ("other", pa.int64()), ("similarity", pa.float64())])
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        parts = []
        for q, r, found in _products(queries, rows, decimals):
            ok = found >= least
            if n < len(r):
                ok &= found >= np.partition(found, len(r) - n, axis=1)[:, len(r) - n : len(r) - n + 1]
            at, to = np.nonzero(ok)
            parts.append(pa.Table.from_arrays([pa.array(q[at]), pa.array(r[to]), pa.array(found[at, to])], schema=schema))
        return pa.concat_tables(parts)

    return search


def _blocks(queries: DataFrame, rows: DataFrame):
    """The tables cut into blocks by hash and grouped by pair of blocks; each pair is one product of matrices."""
    queries, rows = queries.where("unit IS NOT NULL").select("id", "unit"), rows.where("unit IS NOT NULL").select("id", "unit")
    many = lambda t: max(1, -(-t.count() // BLOCK_ROWS))
    a, b = many(queries), many(rows)
    queries = queries.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(a))).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(b - 1))))
    rows = rows.withColumn("rb", F.pmod(F.xxhash64("id"), F.lit(b)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(a - 1).cast("long"))))
    return queries.groupBy("qb", "rb").cogroup(rows.groupBy("qb", "rb"))


def _count(least: float):
    def count(queries: pa.Table, rows: pa.Table) -> pa.Table:
        schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("best", pa.float64())])
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        parts = []
        for q, _, found in _products(queries, rows, 6):
            links = (found >= least).sum(1)
            some = links > 0
            parts.append(pa.Table.from_arrays([pa.array(q[some]), pa.array(links[some]), pa.array(found.max(1)[some])], schema=schema))
        return pa.concat_tables(parts)

    return count


def count_links(queries: DataFrame, rows: DataFrame, least: float) -> DataFrame:
    """(id, links, best): for each query the number of other rows with a cosine of at least ``least``, and the best cosine.

    Pairs are counted inside the products of blocks and never written out; queries without links have no row.
    """
    counted = _blocks(queries, rows).applyInArrow(_count(least), "id long, links long, best double")
    return counted.groupBy("id").agg(F.sum("links").alias("links"), F.max("best").alias("best"))


def nearest(queries: DataFrame, rows: DataFrame, n: int, least: float, decimals: int = 6) -> DataFrame:
    """(id, other, similarity, rank_no): for each query the ``n`` most similar other rows with a cosine of at least ``least``.

    Both tables have id (long) and unit (array<double> of one size and length 1); null vectors do not count. Cosines are rounded
    to ``decimals`` before they are compared and ranked, ties go to the smaller id. Rows and queries are cut into blocks by
    hash; each pair of blocks is one product of matrices and gives at most its own best.
    """
    near = _blocks(queries, rows).applyInArrow(_search(n, least, decimals), "id long, other long, similarity double")
    order = W.partitionBy("id").orderBy(F.desc("similarity"), "other")
    return near.withColumn("rank_no", F.row_number().over(order)).where(F.col("rank_no") <= n)
