"""Choosing rows: by status, by a set of keys, and which of them are settled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_status(rows: DataFrame, wanted: str, strict: bool = True) -> DataFrame:
    """Rows of a status; ``all`` takes every row, and so does ``draft`` where the choice is not strict. A null status is none."""
    if wanted == "all" or (wanted == "draft" and not strict):
        return rows
    return rows.where(F.col("status") == wanted)


def of_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the table of keys; null keys never are, repeated keys do not repeat rows."""
    return rows.join(keys.select(key), key, "left_semi")


def settled(rows: DataFrame, ok: Column) -> DataFrame:
    """Rows that may go into the state of a delta: a failed one (``ok`` false or null) stays out, so the next run tries it again."""
    return rows.where(F.coalesce(ok, F.lit(False)))
