"""Session helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, whatever folder they are started in."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    here = str(Path(__file__).resolve().parents[1])
    if here not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([here, *filter(None, paths)])


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One input table; parquet files or directories alike."""
    let_workers_import(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``; where it is unset, a local one on one machine, an error on a cluster."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors can reach")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lodestar-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that lost executors cannot take it away."""
    ensure_checkpoint_dir(df.sparkSession)
    let_workers_import(df.sparkSession)
    return df.checkpoint(eager=True)


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the unit in which spreads of hot groups are chosen."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Partitions by key in a fixed number, before Python works on groups that are small in bytes but long in time.

    Adaptive execution merges partitions by their bytes and would put such groups into a few tasks; it leaves a number that
    was asked for. A grouping by the same keys needs no further shuffle.
    """
    spark = df.sparkSession
    let_workers_import(spark)
    return df.repartition(max(parallelism(spark), 4 * spark.sparkContext.defaultParallelism), *keys)


def balance(rows: DataFrame) -> DataFrame:
    """Rows dealt out for slow work per row, if they come in fewer partitions than there are cores; else as they are.

    A large table has many partitions and is not shuffled; a small one in a few files would keep most cores idle.
    """
    let_workers_import(rows.sparkSession)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= 2 * cores else rows.repartition(max(parallelism(rows.sparkSession), 2 * cores))
