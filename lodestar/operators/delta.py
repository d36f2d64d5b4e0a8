"""Work only on what changed: content hashes against those of the last run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def content_hash(*parts: Column) -> Column:
    """SHA-256 of the parts put together; nulls are empty."""
    return F.sha2(F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def changed(new: DataFrame, state: DataFrame, key: str, digest: str, force: bool = False) -> DataFrame:
    """Rows of ``new`` whose hash is not the one in ``state``; all of them if forced."""
    if force:
        return new
    seen = state.select(F.col(key), F.col(digest).alias("_seen"))
    return new.join(seen, key, "left").where(~F.col(digest).eqNullSafe(F.col("_seen"))).drop("_seen")


def latest(rows: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return rows.withColumn("_rank", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_rank = 1").drop("_rank")


def override_union(tables: list[DataFrame], key: str) -> DataFrame:
    """One row a key: that of the last table that has it."""
    ranked = [t.withColumn("_place", F.lit(i)) for i, t in enumerate(tables)]
    rows = ranked[0]
    for t in ranked[1:]:
        rows = rows.unionByName(t)
    return latest(rows, [key], F.desc("_place")).drop("_place")
