import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.functions import values as V
from lodestar.operators import providers, writes
from lodestar.operators.components import apply_duplicates, components, reset_duplicates
from lodestar.operators.delta import changed, content_hash, override_union
from lodestar.operators.similarity import count_links, nearest
from lodestar.plans.pipeline import run_steps
from lodestar.sources import files
from lodestar.schemas import VOCABULARY
from lodestar.streaming.deltas import hashed_stream, write_changes


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def smallest_reachable(nodes, edges):
    label = {n: n for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components_against_brute_force(spark):
    draw = random.Random(3)
    nodes = [f"n{i}" for i in range(120)]
    edges = [(f"n{i}", f"n{i + 1}") for i in range(40)] + [("n100", f"n{i}") for i in range(60, 90)] + [tuple(draw.sample(nodes, 2)) for _ in range(15)]
    found = components(spark.createDataFrame([(n,) for n in nodes], "node string"), spark.createDataFrame([*edges, (None, "n1"), ("n2", "n2")], "a string, b string"))
    assert dict(rows(found)) == smallest_reachable(nodes, edges)
    none = spark.createDataFrame([], "a string, b string")
    assert rows(components(spark.createDataFrame([("x",)], "node string"), none)) == [("x", "x")]


def test_apply_twice_then_reset(spark):
    table = spark.createDataFrame([("a", "published"), ("b", "draft")], "slug string, status string")
    hit = spark.createDataFrame([("a",)], "slug string")
    twice = apply_duplicates(apply_duplicates(table, hit, "slug"), hit, "slug")
    assert rows(twice.select("slug", "status", "prev_status")) == [("a", "duplicate", "published"), ("b", "draft", None)]
    assert rows(reset_duplicates(twice).select("slug", "status")) == rows(table)


def test_write_modes(spark):
    kind = "id int, a string, b string"
    old = spark.createDataFrame([(1, "x", "y"), (2, "p", "q")], kind)
    new = spark.createDataFrame([(2, None, ""), (3, "n", "m")], kind)
    assert rows(writes.upsert(old, new, ["id"])) == [(1, "x", "y"), (2, None, ""), (3, "n", "m")]
    assert rows(writes.merge(old, new, ["id"])) == [(1, "x", "y"), (2, "p", ""), (3, "n", "m")]
    assert rows(writes.merge(old, new, ["id"], blank_keeps=True)) == [(1, "x", "y"), (2, "p", "q"), (3, "n", "m")]
    assert rows(writes.insert_absent(old, new, ["id"])) == [(1, "x", "y"), (2, "p", "q"), (3, "n", "m")]
    assert rows(writes.replace_keys(old, old.where("id = 1"), new.limit(0), ["id"])) == [(2, "p", "q")]
    same = writes.upsert(writes.upsert(old, new, ["id"]), new, ["id"])
    assert rows(same) == rows(writes.upsert(old, new, ["id"]))


def test_edge_changes_leave_unknown_items(spark):
    kind = "t int, c int, p boolean"
    current = spark.createDataFrame([(1, 1, True), (1, 2, False), (9, 9, True)], kind)
    wanted = spark.createDataFrame([(1, 1, False), (1, 3, True)], kind)
    assert rows(writes.edge_changes(current, wanted, ["t", "c"], "p")) == [(1, 1, "update"), (1, 2, "delete"), (1, 3, "add")]


def test_delta_of_the_same_is_empty(spark):
    table = spark.createDataFrame([("a", "x"), ("b", None)], "slug string, t string").withColumn("h", content_hash(F.col("t")))
    assert changed(table, table.select("slug", "h"), "slug", "h").count() == 0
    assert changed(table, table.where("slug = 'a'").select("slug", "h"), "slug", "h").select("slug").collect()[0][0] == "b"
    assert changed(table, table, "slug", "h", force=True).count() == 2


def test_override_union(spark):
    one, two = (spark.createDataFrame(r, "k string, v int") for r in ([("a", 1), ("b", 1)], [("b", 2)]))
    assert rows(override_union([one, two], "k")) == [("a", 1), ("b", 2)]


def test_nearest_against_numpy(spark):
    x = np.random.default_rng(1).standard_normal((60, 8))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "id long, v array<double>").select("id", V.unit(F.col("v")).alias("unit"))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for i, j, _, rank in nearest(table, table, 3, -1.0).collect():
        found.setdefault(i, {})[rank] = j
    for i in range(60):
        s = np.round(unit @ unit[i], 6)
        s[i] = -2
        assert [found[i][r] for r in (1, 2, 3)] == np.argsort(-s, kind="stable")[:3].tolist()


def test_providers_keep_order_and_errors(spark):
    table = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "id int, t string")
    got = providers.embed(table, "t", batch=3).collect()
    assert all(r["vector"] == pytest.approx(providers.hash_vector(r["t"])) and r["error"] is None for r in got)
    told = providers.answer(table, "t", "n int", lambda p: '{"n": 1}' if p != "t3" else 1 / 0).collect()
    assert [r["id"] for r in told if r["error"]] == [3] and all(r["answer"]["n"] == 1 for r in told if r["id"] != 3)


def test_json_scans(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_bytes(b'[{"slug":"a","name":"1"},{"slug":"a","name":"2"},{"name":"x"}]\x00\x00')
    bad.write_text("{oops")
    assert files.read_json_list(spark, str(good), VOCABULARY).count() == 3
    assert rows(files.read_existing(spark, str(good), VOCABULARY, "slug").select("slug", "name")) == [("a", "2")]
    assert files.read_existing(spark, str(tmp_path / "none.json"), VOCABULARY, "slug").count() == 0
    assert files.read_existing(spark, str(bad), VOCABULARY, "slug").count() == 0
    with pytest.raises(Exception):
        files.read_json_list(spark, str(bad), VOCABULARY).count()
    (tmp_path / "m.json").write_text('{"1": "un", "x": "?", "2": " "}')
    (tmp_path / "l.json").write_text('[{"id": 3, "name_fr": "trois"}]')
    assert rows(files.read_translations(spark, str(tmp_path / "m.json"))) == [(1, "un")]
    assert rows(files.read_translations(spark, str(tmp_path / "l.json"))) == [(3, "trois")]


def test_pipeline_stops_at_a_critical_failure(spark, tmp_path):
    steps = [("one", lambda t: {"b": t["a"]}, True), ("two", lambda t: 1 / 0, False), ("three", lambda t: t["none"], True), ("four", lambda t: {}, True)]
    tables, runs = run_steps(spark, steps, {"a": spark.range(3)}, str(tmp_path), "1")
    assert tables["b"].count() == 3
    assert [(r["step"], r["ok"]) for r in runs.collect()] == [("one", True), ("two", False), ("three", False)]


def test_stream_of_changes(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    kind = "slug string, body string, day int"
    stream = lambda: hashed_stream(spark.readStream.schema("slug string, body string, day int").parquet(str(source)), ["body"])
    found = []
    for day, rows_ in enumerate(([("a", "x"), ("a", "x"), ("b", "y")], [("a", "z"), ("b", "y")], [("a", "x")])):  # a goes back to what it was
        spark.createDataFrame([(*r, day) for r in rows_], kind).coalesce(1).write.mode("append").parquet(str(source))
        write_changes(stream(), "slug", "day", str(out), str(tmp_path / "cp")).awaitTermination()
        found.append(sorted(r["slug"] for r in spark.read.parquet(str(out / "changes" / f"batch={day}")).collect()))
    assert found == [["a", "b"], ["a"], ["a"]]


def test_reset_of_a_null_status(spark):
    table = spark.createDataFrame([("a", None), ("b", "draft")], "slug string, status string")
    marked = apply_duplicates(table, spark.createDataFrame([("a",)], "slug string"), "slug")
    assert rows(marked.select("slug", "status", "prev_status")) == [("a", "duplicate", None), ("b", "draft", None)]
    assert rows(reset_duplicates(marked).select("slug", "status")) == rows(table)


def test_similarity_is_rounded_before_the_threshold(spark):
    other = [0.5496, (1 - 0.5496**2) ** 0.5]
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, other)], "id long, unit array<double>")
    assert [(r["other"], r["similarity"]) for r in nearest(table.where("id = 1"), table, 5, 0.55, decimals=3).collect()] == [(2, 0.55)]
    assert nearest(table.where("id = 1"), table, 5, 0.55).count() == 0
    assert rows(count_links(table, table, 0.5)) == [(1, 1, 0.5496), (2, 1, 0.5496)]


def test_delete_and_append(spark):
    table = spark.createDataFrame([(1, "draft"), (2, None), (3, "published")], "id int, status string")
    assert rows(writes.delete_where(table, F.col("status") == "draft").select("id")) == [(2,), (3,)]
    assert writes.append(table, table.select("status", "id")).count() == 6
