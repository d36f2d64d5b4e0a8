"""Problem 5: the N best items of every group, with one fixed order for ties.

Method: secondary sort. Rows are hash-partitioned, sorted inside the partitions by group, score and item, and streamed as
Arrow batches of which the first N rows of each group pass; no group is ever held. It runs twice: first on partitions by
(group, item), the partitioning that removing repeats needs anyway, so that a group with a third of all rows is spread over
all partitions and leaves at most N rows in each; then by group on what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.runtime import let_workers_import, table


def _first_of_groups(n: int):
    """Passes the first ``n`` rows of each run of equal first columns, numbering them; runs may span batches."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            groups = batch.column(0).to_pandas().to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
            lengths = np.diff(np.append(starts, size))
            rank = np.arange(size) - np.repeat(starts, lengths)
            carried = seen if last is not None and groups[0] == last else 0
            rank[: lengths[0]] += carried
            last, seen = groups[-1], int(rank[-1]) + 1
            keep = pa.array(rank < n)
            columns = [*batch.columns[:-1], pa.array((rank + 1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(keep)

    return stream


def top_items(rows: DataFrame, group: str, item: str, score: str, n: int) -> DataFrame:
    """(group, item, score, rank_no): of each group the ``n`` distinct items of highest score, ties to the smaller item.

    An item with several scores has its highest. Rows with a null group, item or score, or a score that is not a number,
    do not count. Groups with fewer items give what they have; an empty table gives no rows. Further columns, whatever
    their names, are not read.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    let_workers_import(rows.sparkSession)
    rows = rows.select(F.col(group).alias("g"), F.col(score).alias("s"), F.col(item).alias("i")).dropna()
    if isinstance(rows.schema["s"].dataType, (T.DoubleType, T.FloatType)):
        rows = rows.where(~F.isnan("s"))
    best = rows.groupBy("g", "i").agg(F.max("s").alias("s")).select("g", "s", "i", F.lit(0).alias("r"))
    order = ["g", F.desc("s"), "i"]
    first = _first_of_groups(n)
    near = best.sortWithinPartitions(*order).mapInArrow(first, best.schema)
    top = near.repartition("g").sortWithinPartitions(*order).mapInArrow(first, best.schema)
    return top.select(F.col("g").alias(group), F.col("i").alias(item), F.col("s").alias(score), F.col("r").alias("rank_no"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    top = top_items(table(spark, root, "alternatives"), "tool_id", "alternative_id", "similarity", 5)
    return top.select("tool_id", "rank_no", "alternative_id")


QUERIES = {"p5_found": p5_found}
ORACLES = {
    "p5_found": """
SELECT tool_id, CAST(rank_no AS INTEGER) AS rank_no, alternative_id FROM (
  SELECT tool_id, alternative_id, row_number() OVER (PARTITION BY tool_id ORDER BY s DESC, alternative_id) AS rank_no
  FROM (SELECT tool_id, alternative_id, max(similarity) AS s FROM alternatives
        WHERE tool_id IS NOT NULL AND alternative_id IS NOT NULL AND similarity IS NOT NULL GROUP BY ALL))
WHERE rank_no <= 5"""
}
