"""Selectors, settled rows, page fetching, array files, whole reports and the runner's stop on a warning."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestar import schemas
from lodestar.functions.text import page_text
from lodestar.operators.providers import fetch
from lodestar.operators.selection import of_keys, select_status, settled
from lodestar.plans.pipeline import run_steps
from lodestar.sources.files import full_report, read_json_list, write_json_array


def test_status_selectors(spark):
    rows = spark.createDataFrame([("a", "published"), ("b", "draft"), ("c", None)], "slug string, status string")
    taken = lambda *how: sorted(r["slug"] for r in select_status(rows, *how).collect())
    assert taken("published") == ["a"] and taken("draft") == ["b"]
    assert taken("draft", False) == taken("all") == ["a", "b", "c"]
    assert select_status(rows.limit(0), "draft").count() == 0


def test_keys_and_settled_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "k string, v int")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [r["k"] for r in of_keys(rows, keys, "k").collect()] == ["a", "a"]
    assert of_keys(rows, keys.limit(0), "k").count() == 0
    assert settled(rows, F.col("v") > 1).collect() == [(None, 2)]


def test_fetch_makes_errors_columns(spark):
    def provider(address):
        if "down" in address:
            raise OSError("no route")
        return (404, "gone") if "old" in address else (200, "page of " + address)

    rows = spark.createDataFrame([("u",), ("down",), ("old",), ("",), (None,)], "url string")
    found = {r["url"]: (r["status"], r["body"], r["error"]) for r in fetch(rows, "url", provider).collect()}
    assert found == {"u": (200, "page of u", None), "down": (None, None, "no route"), "old": (404, None, "status 404"), "": (None, None, "no address"), None: (None, None, "no address")}
    once, twice = (fetch(rows, "url").where("url = 'u'").first()["body"] for _ in range(2))
    assert once == twice and "<title>u</title>" in once
    assert fetch(rows.limit(0), "url").count() == 0


def test_array_files_come_back(spark, tmp_path):
    rows = spark.createDataFrame([(f"t{i}", "é 日本, \"x\"\n" if i else None, None) for i in range(50)], "slug string, name string, description string").repartition(3)
    write_json_array(rows, str(tmp_path / "out"))
    for part in Path(tmp_path / "out").glob("part-*"):
        assert isinstance(json.loads(part.read_text()), list)
    back = read_json_list(spark, str(tmp_path / "out"), schemas.VOCABULARY).drop("_ordinal")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    write_json_array(rows.limit(0), str(tmp_path / "none"))
    assert read_json_list(spark, str(tmp_path / "none"), schemas.VOCABULARY).count() == 0


def test_tolerant_scan_takes_only_missing_files_as_empty(spark, tmp_path):
    assert read_json_list(spark, str(tmp_path / "missing"), schemas.VOCABULARY, strict=False).count() == 0
    with pytest.raises(Exception):
        read_json_list(spark, "unknown-scheme://x/y", schemas.VOCABULARY, strict=False).count()


def test_full_report(spark):
    problems = spark.createDataFrame([("stale", "b", "2026-01-01"), ("stale", "a", ""), ("score", "a", None)], "section string, slug string, detail string")
    lines = [r["line"] for r in full_report(problems, "2026-02-03").orderBy(F.asc_nulls_first("section"), "place", "line").collect()]
    assert lines == ["# Health 2026-02-03: 3 problems", "## score: 1", "- a", "## stale: 2", "- a", "- b 2026-01-01"]
    assert [r["line"] for r in full_report(problems.limit(0), "d").collect()] == ["# Health d: 0 problems"]


def test_stop_on_warning(spark, tmp_path):
    def fail(_):
        raise ValueError("no")

    steps = [("one", fail, False), ("two", lambda t: {}, True)]
    names = lambda stop: [r["step"] for r in run_steps(spark, steps, {}, str(tmp_path), "v", dry_run=True, stop_on_warning=stop)[1].collect()]
    assert names(False) == ["one", "two"] and names(True) == ["one"]


def test_page_text_modes(spark):
    page = spark.createDataFrame([("<nav>Menu</nav><p>Body &amp; more</p>",), (None,)], "h string")
    read = lambda mode: [r[0] for r in page.select(page_text(F.col("h"), mode, None)).collect()]
    assert read("dom") == ["Body & more", None] and read("regex") == ["Menu Body &amp; more", ""]
    with pytest.raises(ValueError):
        page_text(F.col("h"), "other")


def test_small_steps_give_what_large_ones_do(spark, monkeypatch):
    import numpy as np

    from lodestar.operators import similarity as S

    v = np.random.default_rng(3).standard_normal((90, 6))
    rows = spark.createDataFrame([(i, (x / np.linalg.norm(x)).tolist()) for i, x in enumerate(v)], "id long, unit array<double>")
    asked = rows.where("id % 4 = 0")
    took = lambda: (sorted(map(tuple, S.nearest(asked, rows, 3, 0.2).collect())), sorted(map(tuple, S.count_links(asked, rows, 0.2).collect())))
    whole = took()
    monkeypatch.setattr(S, "STEP_CELLS", 200)
    assert took() == whole and len(whole[1]) == 23
