"""An extension: the content-hash delta as a stream of pages against a versioned state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestar.operators.delta import changed, content_hash, latest
from lodestar.operators.writes import upsert


def hashed_stream(pages: DataFrame, parts: list[str]) -> DataFrame:
    """The pages of a stream with the hash of their content."""
    return pages.withColumn("content_hash", content_hash(*[F.col(p) for p in parts]))


def _state(spark: SparkSession, folder: str, version: int) -> DataFrame | None:
    """The state that the batches before ``version`` left, or None at the start."""
    return spark.read.parquet(f"{folder}/state={version}") if version >= 0 else None


def write_changes(pages: DataFrame, key: str, time: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Writes the pages whose content is not that of the last state of their key, batch by batch.

    Of several pages of a key in one batch the last by ``time`` counts. Content that returns to an earlier version is a
    change like any other. Batch n reads the state of batch n - 1 and writes its changes and its own state under its number,
    so a batch that is repeated after a failure replaces itself.
    """

    def save(batch: DataFrame, number: int) -> None:
        last = latest(batch, [key], F.desc(time), F.desc("content_hash"))
        state = _state(batch.sparkSession, folder, number - 1)
        fresh = last if state is None else changed(last, state, key, "content_hash")
        fresh.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")
        seen = last.select(key, "content_hash")
        (seen if state is None else upsert(state, seen, [key])).write.mode("overwrite").parquet(f"{folder}/state={number}")

    return pages.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
