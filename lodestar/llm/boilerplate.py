"""Problem 1: which lines of a page, and which titles, carry the frame of its site.

Method: the flat text blocks (lines) of a page are described by their own word count and link density and those of their
neighbours; a decision tree trained on a small labelled table of invented pages tells frame from article. Flat text has no
links. What stands in for link density is taken from the data: whether many pages of the same site repeat a line, how many
sites repeat it, and the share of its words in short parts that repeat; beside it stands the share of words in usual labels.
Pages are read twice: once to count what repeats, once, joined with what their site repeats, to describe their lines.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.frames import line_features, line_key, mask, segments_of, site_of, title_has_frame
from lodestar.llm.labelled_pages import labelled_pages
from lodestar.runtime import balance, cut_lineage, let_workers_import, table

#: A line is repeated among sites if at least so many sites and this share of all of them have it; a page has a bounded
#: number of lines, so the share bounds how many lines that are, whatever the number of pages.
REPEATS, REPEAT_SHARE = 3, 0.002
#: A line is repeated within its site if at least REPEATS pages and this share of the site's pages have it.
SITE_SHARE = 0.3
#: Share of frame lines to which the labelled table is weighted: article text that is lost is the worse mistake.
FRAME_SHARE = 0.2
_ALL = -(2**63)
_PAGE = ["slug", "collected_at", "raw_text", "name", "website_url", "source_url"]


def _name(name: str | None, slug: str | None) -> str:
    """The tool's name; where it is missing, the words of its slug."""
    return (name or "").strip() or (slug or "").replace("-", " ").title()


def _parts(lines: list[str], name: str, site: str) -> set[int]:
    """Keys of the lines of a page and of the parts of those that are set together by separators."""
    found = {_ALL}
    for line in lines:
        masked = mask(line, name, site)
        found.add(line_key(masked))
        if len(parts := segments_of(masked)) > 1:
            found.update(map(line_key, parts))
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        keys = np.array(list(held), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(list(held.values()), pa.int64())], names=["line", "site", "pages"])

    held: Counter = Counter()
    for batch in batches:
        for slug, _, text, name, url, source in zip(*(c.to_pylist() for c in batch.columns)):
            site = site_of(url, source)
            at = line_key(site)
            lines = [s for line in text.split("\n") if (s := line.strip())]
            held.update((key, at) for key in _parts(lines, _name(name, slug), site))
        if len(held) > 200_000:
            yield out()
            held = Counter()
    yield out()


def _level(share: float) -> float:
    """How common a line is among sites: 1 from REPEAT_SHARE on, 2 from one in a hundred, 3 from one in twenty."""
    return 1.0 + (share >= 0.01) + (share >= 0.05)


def repeated_lines(pages: DataFrame) -> tuple[dict[int, float], DataFrame]:
    """What repeats: the level of lines (and parts of lines) that many sites have, by ``line_key``, and (site_key, own_lines), the
    lines that many pages of a site have.

    Counted on all pages, first within tasks, then by (line, site), then by line or by site. At most (lines of a page) x
    (pages of a site) / REPEAT_SHARE levels come back to the driver; own_lines holds at most (lines of a page) / SITE_SHARE.
    """
    let_workers_import(pages.sparkSession)
    counted = balance(pages.select(*_PAGE).where("raw_text IS NOT NULL")).mapInArrow(_count, "line long, site_key long, pages long")
    counted = cut_lineage(counted.groupBy("line", "site_key").agg(F.sum("pages").alias("pages")))
    sites = counted.where(f"line = {_ALL}")
    number = sites.count()
    many = counted.where(f"line <> {_ALL}").groupBy("line").agg(F.count("*").alias("sites")).where(F.col("sites") >= max(REPEATS, REPEAT_SHARE * number))
    often = counted.where(f"line <> {_ALL} AND pages >= {REPEATS}").join(sites.select("site_key", F.col("pages").alias("of_site")), "site_key").where(F.col("pages") >= SITE_SHARE * F.col("of_site"))
    return {r["line"]: _level(r["sites"] / number) for r in many.collect()}, often.groupBy("site_key").agg(F.collect_list("line").alias("own_lines"))


def train_tree(spark: SparkSession, pages: int = 900, depth: int = 8) -> DecisionTreeClassificationModel:
    """The tree, from the labelled table of ``pages`` invented pages (about 20 lines each); what repeats is counted on these."""
    made = [(name, site, [t for t, _ in lines], [float(m) for _, m in lines]) for name, site, lines in labelled_pages(pages)]
    seen: dict[int, Counter] = {}
    for name, site, lines, _ in made:
        for key in _parts(lines, name, site):
            seen.setdefault(key, Counter())[site] += 1
    all_ = seen.pop(_ALL)
    levels = {k: _level(len(n) / len(all_)) for k, n in seen.items() if len(n) >= max(REPEATS, REPEAT_SHARE * len(all_))}
    own = {s: {k for k, n in seen.items() if n[s] >= max(REPEATS, SITE_SHARE * total)} for s, total in all_.items()}
    rows = [(x, m) for name, site, lines, marks in made for x, m in zip(line_features(lines, name, site, levels, own[site]).tolist(), marks)]
    frame = sum(m for _, m in rows) / len(rows)
    weight = {1.0: FRAME_SHARE / frame, 0.0: (1 - FRAME_SHARE) / (1 - frame)}
    table_ = spark.createDataFrame(pd.DataFrame([(x, m, weight[m]) for x, m in rows], columns=["x", "label", "weight"]), "x array<double>, label double, weight double")
    return DecisionTreeClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxDepth=depth, minInstancesPerNode=12, seed=1).fit(
        table_.select(array_to_vector("x").alias("features"), "label", "weight")
    )


def _describe(shared):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for batch in batches:
            pages, places, features = [], [], []
            for page, (slug, _, text, name, url, source, own) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                lines = [(i, s) for i, line in enumerate(text.split("\n")) if (s := line.strip())]
                pages += [page] * len(lines)
                places += [i for i, _ in lines]
                features.append(line_features([s for _, s in lines], _name(name, slug), site_of(url, source), levels, set(own or ())))
            x = np.concatenate(features) if features else np.zeros((0, 1))
            at = pa.array(pages, pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(places, pa.int32()), lists], names=["slug", "collected_at", "line_no", "x"])

    return describe


@F.pandas_udf(T.LongType())
def _site_key(url: pd.Series, source: pd.Series) -> pd.Series:
    return pd.Series([line_key(site_of(u, s)) for u, s in zip(url, source)], dtype="int64")


@F.pandas_udf(T.BooleanType())
def _title_has_frame(title: pd.Series, name: pd.Series, url: pd.Series, source: pd.Series) -> pd.Series:
    return pd.Series([title_has_frame(t, n or "", site_of(u, s)) for t, n, u, s in zip(title, name, url, source)], dtype=bool)


def frame_lines(pages: DataFrame, tree: DecisionTreeClassificationModel, repeats: bool = True) -> DataFrame:
    """(slug, collected_at, line_no): the lines of raw_text (split at ``\\n``, from 0) that the tree takes for frame.

    ``pages`` has slug, collected_at, raw_text, name, website_url and source_url; other columns are not read. Null and blank
    texts give no rows, blank lines count but are never given, repeated pages count once in the result (and as often as they
    occur in what repeats), texts are read whole, a null name or address only takes marks away. An empty table gives no
    rows. Without ``repeats`` the lines are told by their own words and neighbours alone.
    """
    levels, own = repeated_lines(pages) if repeats else ({}, None)
    shared = pages.sparkSession.sparkContext.broadcast(levels)
    let_workers_import(pages.sparkSession)
    pages = pages.select(*_PAGE).where("raw_text IS NOT NULL")
    if own is None:
        pages = pages.withColumn("own_lines", F.lit(None).cast("array<bigint>"))
    else:
        pages = pages.withColumn("site_key", _site_key("website_url", "source_url")).join(own, "site_key", "left").select(*_PAGE, "own_lines")
    lines = balance(pages).mapInArrow(_describe(shared), "slug string, collected_at string, line_no int, x array<double>")
    told = tree.transform(lines.withColumn("features", array_to_vector("x")))
    return told.where("prediction = 1").select("slug", "collected_at", "line_no").distinct()


def frame_titles(pages: DataFrame) -> DataFrame:
    """(slug, collected_at): the pages whose raw_title holds words of the site besides the page's own title.

    Null and blank titles give no rows; repeated pages count once.
    """
    pages = pages.where("trim(raw_title) <> ''").select("slug", "collected_at", "raw_title", "name", "website_url", "source_url").distinct()
    return pages.where(_title_has_frame("raw_title", "name", "website_url", "source_url")).select("slug", "collected_at")


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "raw_tools")
    lines = frame_lines(pages, train_tree(spark)).withColumn("field", F.lit("raw_text"))
    titles = frame_titles(pages).select("slug", "collected_at", F.lit("raw_title").alias("field"), F.lit(0).alias("line_no"))
    return lines.select("slug", "collected_at", "field", "line_no").unionByName(titles).distinct()


QUERIES = {"p1_found": p1_found}
ORACLES: dict[str, str] = {}
