"""Scans of JSON files, with a declared schema each."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.schemas import FACETS


def read_json_list(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Rows of a file (or folder of files) that holds one JSON array.

    Trailing NUL bytes are dropped. A strict scan fails if a file is no array of objects; a tolerant one takes it as empty,
    and a missing path as well; any other failure to read is raised.
    """
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if strict or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    text = F.regexp_replace(F.col("value"), "[\\x00\\s]+$", "")
    rows = whole.select(F.from_json(text, T.ArrayType(schema)).alias("rows"), text.alias("text"))
    if strict:
        rows = rows.select(F.when(F.col("rows").isNull() | ~F.col("text").startswith("["), F.raise_error(F.lit("not a JSON array"))).otherwise(F.col("rows")).alias("rows"))
    return rows.select(F.posexplode("rows").alias("_ordinal", "row")).select("_ordinal", "row.*")


def read_existing(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """Tolerant scan by key: rows without one are dropped, of several the last counts."""
    rows = read_json_list(spark, path, schema, strict=False)
    if "_ordinal" not in rows.columns:
        return rows
    columns = [c for c in rows.columns if c != "_ordinal"]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*columns), "_ordinal").alias("r")).select("r.*")


def read_facets(spark: SparkSession, path: str) -> DataFrame:
    """(axis, slug, label, place) of a file that maps each axis to its list of terms."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", FACETS).alias("m"))
    return whole.select(F.explode("m").alias("axis", "terms")).select("axis", F.posexplode("terms").alias("place", "t")).select("axis", "t.slug", "t.label", "place")


def read_translations(spark: SparkSession, path: str) -> DataFrame:
    """(id, name) of a file that is either a map of ids to names or a list of objects with id and name_fr.

    Ids that are no numbers and blank names are dropped.
    """
    whole = spark.read.text(path, wholetext=True)
    as_map = F.transform(F.map_entries(F.from_json("value", "map<string,string>")), lambda e: F.struct(e["key"].alias("id"), e["value"].alias("name")))
    as_list = F.transform(F.from_json("value", "array<struct<id:string,name_fr:string>>"), lambda e: F.struct(e["id"].alias("id"), e["name_fr"].alias("name")))
    listed = F.ltrim("value").startswith("[")
    rows = whole.select(F.explode(F.when(listed, as_list).otherwise(as_map)).alias("r"))
    return rows.select(F.expr("try_cast(r.id AS BIGINT)").alias("id"), F.trim("r.name").alias("name")).where("id IS NOT NULL AND name <> ''")


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows that stand in the program."""
    return spark.createDataFrame(rows, schema)


def write_json_list(table: DataFrame, path: str) -> None:
    """Writes rows as JSON lines, in order of the first column, by all tasks; text is kept as it is."""
    table.repartitionByRange(table.columns[0]).sortWithinPartitions(table.columns[0]).write.mode("errorifexists").json(path)


def write_json_array(table: DataFrame, path: str) -> None:
    """Writes rows as JSON arrays, one in each part file, which :func:`read_json_list` reads back as one table.

    Lines are streamed: no task holds its array. Text is kept as it is, null fields are left out.
    """

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = True
        for batch in batches:
            texts = batch["value"].tolist()
            if texts:
                yield pd.DataFrame({"value": [("[" if first and not i else ",") + t for i, t in enumerate(texts)]})
                first = False
        yield pd.DataFrame({"value": ["[]" if first else "]"]})

    table.select(F.to_json(F.struct(*table.columns)).alias("value")).mapInPandas(lines, "value string").write.mode("errorifexists").text(path)


def report(sections: DataFrame, day: str) -> DataFrame:
    """One Markdown line for each section of a health check, with its number of problems; at most a line a section."""
    totals = sections.groupBy("section").agg(F.count("*").alias("n"))
    return totals.select(F.format_string("- %s (%s): %d", F.col("section"), F.lit(day), F.col("n")).alias("line")).orderBy("line")


def full_report(sections: DataFrame, day: str) -> DataFrame:
    """(place, section, line): the whole report of a health check as ordered lines: a total, and a heading and its items for each section.

    Lines are rows, so that a section of any length stays spread over tasks; order by section (null first), place and line.
    """
    totals = sections.groupBy("section").agg(F.count("*").alias("n"))
    title = sections.agg(F.lit(None).cast("string").alias("section"), F.lit(0).alias("place"), F.format_string("# Health %s: %d problems", F.lit(day), F.count("*")).alias("line"))
    heads = totals.select("section", F.lit(1).alias("place"), F.format_string("## %s: %d", "section", "n").alias("line"))
    items = sections.select("section", F.lit(2).alias("place"), F.concat(F.lit("- "), F.concat_ws(" ", "slug", F.nullif("detail", F.lit("")))).alias("line"))
    return title.unionByName(heads).unionByName(items)
