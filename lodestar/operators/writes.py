"""Write modes as table transformations: each gives the new version of a table, and writing it is a separate call.

No version is written over one that the same plan reads: :func:`write_version` makes a new folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; null keys never match."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def merge(old: DataFrame, new: DataFrame, key: list[str], blank_keeps: bool = False) -> DataFrame:
    """Like :func:`upsert`, but null values of ``new`` keep the old ones, and so do empty strings if ``blank_keeps``."""
    fresh = lambda c: F.nullif(F.col(f"n.{c}"), F.lit("")) if blank_keeps and dict(new.dtypes)[c] == "string" else F.col(f"n.{c}")
    rows = old.alias("o").join(new.alias("n"), [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key], "full_outer")
    return rows.select(*[F.coalesce(F.col(f"n.{c}") if c in key else fresh(c), F.col(f"o.{c}")).alias(c) if c in new.columns else F.col(f"o.{c}") for c in old.columns])


def insert_absent(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Old rows, and the new ones whose key is not there."""
    return old.unionByName(new.join(old.select(*key).distinct(), key, "left_anti"))


def replace_keys(old: DataFrame, keys: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """All rows of the given keys go, even where ``new`` has none for them; the new rows come."""
    return old.join(keys.select(*key).distinct(), key, "left_anti").unionByName(new)


def update_column(table: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """One column by key, from a table of (key, column) with one row a key."""
    rows = table.alias("t").join(changes.alias("c"), F.col(f"t.{key}") == F.col(f"c.{key}"), "left")
    value = F.when(F.col(f"c.{key}").isNotNull(), F.col(f"c.{column}")).otherwise(F.col(f"t.{column}"))
    return rows.select(*[value.alias(c) if c == column else F.col(f"t.{c}") for c in table.columns])


def edge_changes(current: DataFrame, wanted: DataFrame, key: list[str], flag: str) -> DataFrame:
    """(key, action): what makes ``current`` equal to ``wanted``: add, delete or update (another flag).

    Items (first key column) that ``wanted`` does not know are left alone, so nothing is ever cleared as a whole.
    """
    known = wanted.select(key[0]).distinct()
    current = current.join(known, key[0], "left_semi")
    rows = current.alias("c").join(wanted.alias("w"), [F.col(f"c.{k}") == F.col(f"w.{k}") for k in key], "full_outer")
    action = F.when(F.col(f"c.{key[0]}").isNull(), "add").when(F.col(f"w.{key[0]}").isNull(), "delete").when(~F.col(f"c.{flag}").eqNullSafe(F.col(f"w.{flag}")), "update")
    return rows.select(*[F.coalesce(f"c.{k}", f"w.{k}").alias(k) for k in key], action.alias("action")).where("action IS NOT NULL")


def write_version(table: DataFrame, folder: str, version: str) -> str:
    """Writes a new version beside the old ones and gives its path."""
    path = f"{folder}/version={version}"
    table.write.mode("errorifexists").parquet(path)
    return path


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    """The table without the rows for which the condition is true; where it is null, rows stay."""
    return table.where(~F.coalesce(condition, F.lit(False)))


def append(log: DataFrame, rows: DataFrame) -> DataFrame:
    """A log with rows put behind what is there; nothing is replaced, and columns go by name."""
    return log.unionByName(rows)
