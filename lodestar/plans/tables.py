"""Queries that combine, count, rank and rewrite tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import writes
from lodestar.operators.delta import latest
from lodestar.runtime import table


def orders_of_customers(spark: SparkSession, root: str) -> DataFrame:
    """Orders with their customer; those without one drop out."""
    customers = table(spark, root, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").join(customers, "o_custkey").select("o_orderkey", "c_name", "c_nationkey", "o_orderstatus")


def customers_left(spark: SparkSession, root: str) -> DataFrame:
    """All customers with the number and sum of their finished orders, 0 where there are none."""
    done = table(spark, root, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    return table(spark, root, "customer").join(done, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"), F.round(F.coalesce("s", F.lit(0.0)), 2).alias("total"))


def two_hop_names(spark: SparkSession, root: str) -> DataFrame:
    """Both names of each pair of alternatives that are published and not the same, each pair once."""
    tools = latest(table(spark, root, "tools"), ["id"], F.desc_nulls_last("updated_at"), F.desc("slug")).where("status = 'published'").select("id", "slug")
    a, b = tools.select(F.col("id").alias("tool_id"), F.col("slug").alias("tool_slug")), tools.select(F.col("id").alias("alternative_id"), F.col("slug").alias("alternative_slug"))
    pairs = table(spark, root, "alternatives").select("tool_id", "alternative_id").distinct()
    return pairs.join(a, "tool_id").join(b, "alternative_id").where("tool_slug <> alternative_slug").select("tool_slug", "alternative_slug").distinct()


def part_supplier_names(spark: SparkSession, root: str) -> DataFrame:
    """Parts and suppliers of lines with the quantity moved between them."""
    moved = table(spark, root, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("quantity"))
    parts = table(spark, root, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    suppliers = table(spark, root, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return moved.join(parts, "l_partkey").join(suppliers, "l_suppkey").select("p_name", "s_name", F.col("quantity").cast("long").alias("quantity"), "l_partkey", "l_suppkey")


def has_vector(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "tools").select("slug").distinct().join(table(spark, root, "tool_embeddings").select("slug"), "slug", "left_semi")


def missing_vector(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "tools").select("slug").distinct().join(table(spark, root, "tool_embeddings").select("slug"), "slug", "left_anti")


def status_counts(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "raw_tools")
    rows = rows.select("status", "slug", "collected_at", F.col("raw_text").isNull().alias("empty"), F.sha2(F.to_json(F.struct("*")), 256).alias("row_hash")).distinct()  # texts stay out of the shuffle
    return rows.groupBy("status").agg(F.count("*").alias("rows"), F.count_distinct("slug").alias("slugs"), F.count_if("empty").alias("without_text"))


def any_flag(spark: SparkSession, root: str) -> DataFrame:
    """Orders with a line that was returned."""
    return table(spark, root, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"))


def tag_counts_zero(spark: SparkSession, root: str) -> DataFrame:
    """Distinct orders of each part by one returned line, parts without one included."""
    counts = table(spark, root, "lineitem").where("l_returnflag = 'R' AND l_quantity > 45").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count_distinct("l_orderkey").alias("n"))
    return table(spark, root, "part").select("p_partkey").join(counts, "p_partkey", "left").select("p_partkey", F.coalesce("n", F.lit(0)).alias("orders"))


def first_label(spark: SparkSession, root: str) -> DataFrame:
    """First ship mode seen for each part, in the order of the lines."""
    place = F.struct("l_orderkey", "l_linenumber")
    return table(spark, root, "lineitem").groupBy("l_partkey").agg(F.min_by("l_suppkey", place).alias("first_supplier"), F.min_by("l_returnflag", place).alias("first_flag"))


def promote_smallest(spark: SparkSession, root: str) -> DataFrame:
    """For parts whose main supplier (the one of most lines) is left out, the smallest of the others takes its place."""
    lines = table(spark, root, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
    main = latest(lines, ["l_partkey"], F.desc("n"), F.asc("l_suppkey")).select("l_partkey", F.col("l_suppkey").alias("main"))
    others = lines.join(main, "l_partkey").where("l_suppkey <> main")
    return others.groupBy("l_partkey").agg(F.min("l_suppkey").alias("promoted"), F.count("*").alias("left"))


def sorted_members(spark: SparkSession, root: str) -> DataFrame:
    """Sorted names of the suppliers of each nation, joined, and their hash."""
    members = table(spark, root, "supplier").groupBy("s_nationkey").agg(F.array_join(F.array_sort(F.collect_list("s_name")), "|").alias("members"))
    return members.select("s_nationkey", "members", F.sha2("members", 256).alias("content_hash"))


def edge_sync(spark: SparkSession, root: str) -> DataFrame:
    """What turns the edges of open lines into those of returned ones; the flag is whether a line is large."""
    lines = table(spark, root, "lineitem")
    edges = lambda flag: lines.where(F.col("l_returnflag") == flag).groupBy("l_partkey", "l_suppkey").agg(F.bool_or(F.col("l_quantity") > 40).alias("large"))
    return writes.edge_changes(edges("N"), edges("R"), ["l_partkey", "l_suppkey"], "large")


def _slices(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """An old and a new state of the same table: what every tool was first and what it is now."""
    rows = table(spark, root, "tools").distinct().select("id", "slug", "vendor", "pricing", "quality_score", "updated_at", "created_at")
    old = latest(rows, ["id"], F.asc_nulls_first("updated_at"), F.asc("slug"), F.asc_nulls_first("pricing"), F.asc_nulls_first("vendor"))
    new = latest(rows.where("quality_score > 5"), ["id"], F.desc_nulls_last("updated_at"), F.desc("slug"), F.desc_nulls_last("pricing"), F.desc_nulls_last("vendor"))
    columns = ["id", "slug", "vendor", "pricing", "quality_score"]
    return old.where("quality_score IS NULL OR quality_score < 8").select(*columns), new.withColumn("vendor", F.when(F.col("quality_score") > 7, F.col("vendor"))).select(*columns)


def upsert_full(spark: SparkSession, root: str) -> DataFrame:
    return writes.upsert(*_slices(spark, root), ["id"])


def upsert_partial(spark: SparkSession, root: str) -> DataFrame:
    return writes.merge(*_slices(spark, root), ["id"])


def upsert_not_blank(spark: SparkSession, root: str) -> DataFrame:
    return writes.merge(*_slices(spark, root), ["id"], blank_keeps=True)


def insert_absent(spark: SparkSession, root: str) -> DataFrame:
    return writes.insert_absent(*_slices(spark, root), ["id"])


def replace_by_key(spark: SparkSession, root: str) -> DataFrame:
    """Alternatives of tools that are up to date give way to those with a similarity of at least 0.8."""
    rows = table(spark, root, "alternatives").select("tool_id", "alternative_id", F.col("similarity").cast("double").alias("similarity")).dropna().distinct()
    keys = table(spark, root, "tools").where("status = 'published'").select(F.col("id").alias("tool_id"))
    return writes.replace_keys(rows, keys, rows.join(keys.distinct(), "tool_id", "left_semi").where("similarity >= 0.8"), ["tool_id"])


def update_column(spark: SparkSession, root: str) -> DataFrame:
    old, new = _slices(spark, root)
    return writes.update_column(old, new.select("id", "pricing"), "id", "pricing")


def events_latest(spark: SparkSession, root: str) -> DataFrame:
    """The last event of each user in an append-only log."""
    return latest(table(spark, root, "events"), ["user_id"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type")


def json_map_edges(spark: SparkSession, root: str) -> DataFrame:
    """Keys and values of the JSON object of each event."""
    return table(spark, root, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("axis", "value"))


def daily_events(spark: SparkSession, root: str) -> DataFrame:
    """Events and value by day and kind, each kind counted also over all days."""
    rows = table(spark, root, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))
    return rows.select("day", "event_type", "n", "value")


def text_search(spark: SparkSession, root: str) -> DataFrame:
    """Documents that speak of an API, in any case."""
    return table(spark, root, "documents").where(F.col("text").ilike("%api%")).select("doc_id", "lang")


def page_of_rows(spark: SparkSession, root: str) -> DataFrame:
    """One page of an ordered list, by offset."""
    return table(spark, root, "customer").orderBy("c_custkey").offset(100).limit(50).select("c_custkey", "c_name")


def nation_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Scalar lookups: the key of one nation by its name, and the rows that refer to it."""
    table(spark, root, "nation").createOrReplaceTempView("lodestar_nation")
    table(spark, root, "supplier").createOrReplaceTempView("lodestar_supplier")
    return spark.sql("SELECT s_suppkey, s_name FROM lodestar_supplier WHERE s_nationkey = (SELECT min(n_nationkey) FROM lodestar_nation WHERE n_regionkey = 1)")


_OLD_NEW = """WITH t AS (SELECT DISTINCT id, slug, vendor, pricing, quality_score, updated_at, created_at FROM (SELECT DISTINCT * FROM tools)),
o1 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at ASC NULLS FIRST, slug, pricing ASC NULLS FIRST, vendor ASC NULLS FIRST) AS n FROM t),
n1 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, slug DESC, pricing DESC NULLS LAST, vendor DESC NULLS LAST) AS n FROM t WHERE quality_score > 5),
o AS (SELECT id, slug, vendor, pricing, quality_score FROM o1 WHERE n = 1 AND (quality_score IS NULL OR quality_score < 8)),
w AS (SELECT id, slug, CASE WHEN quality_score > 7 THEN vendor END AS vendor, pricing, quality_score FROM n1 WHERE n = 1)
"""
_MERGED = "SELECT coalesce(w.id, o.id) AS id, coalesce({0}, o.slug) AS slug, coalesce({1}, o.vendor) AS vendor, coalesce({2}, o.pricing) AS pricing, coalesce(w.quality_score, o.quality_score) AS quality_score FROM o FULL JOIN w ON o.id = w.id"
_LATEST_TOOLS = "t AS (SELECT id, slug, status FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, slug DESC) AS n FROM (SELECT DISTINCT * FROM tools)) WHERE n = 1)"
ENTRIES = {
    "orders_of_customers": (orders_of_customers, "SELECT o_orderkey, c_name, c_nationkey, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey"),
    "customers_left": (customers_left, "SELECT c_custkey, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0.0), 2) AS total FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_custkey"),
    "two_hop_names": (two_hop_names, f"WITH {_LATEST_TOOLS} SELECT DISTINCT a.slug AS tool_slug, b.slug AS alternative_slug FROM alternatives x JOIN t a ON a.id = x.tool_id JOIN t b ON b.id = x.alternative_id WHERE a.status = 'published' AND b.status = 'published' AND a.slug <> b.slug"),
    "part_supplier_names": (part_supplier_names, "SELECT p_name, s_name, CAST(sum(l_quantity) AS BIGINT) AS quantity, l_partkey, l_suppkey FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL"),
    "has_vector": (has_vector, "SELECT DISTINCT slug FROM tools WHERE slug IN (SELECT slug FROM tool_embeddings)"),
    "missing_vector": (missing_vector, "SELECT DISTINCT slug FROM tools t WHERE NOT EXISTS (FROM tool_embeddings e WHERE e.slug = t.slug)"),
    "status_counts": (status_counts, 'SELECT status, count(*) AS "rows", count(DISTINCT slug) AS slugs, count(*) FILTER (raw_text IS NULL) AS without_text FROM (SELECT DISTINCT * FROM raw_tools) GROUP BY status'),
    "any_flag": (any_flag, "SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_returned FROM lineitem GROUP BY l_orderkey"),
    "tag_counts_zero": (tag_counts_zero, "SELECT p_partkey, count(DISTINCT l_orderkey) AS orders FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 45 GROUP BY p_partkey"),
    "first_label": (first_label, "SELECT l_partkey, arg_min(l_suppkey, l_orderkey * 10 + l_linenumber) AS first_supplier, arg_min(l_returnflag, l_orderkey * 10 + l_linenumber) AS first_flag FROM lineitem GROUP BY l_partkey"),
    "promote_smallest": (promote_smallest, """WITH x AS (SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, l_suppkey) AS n FROM lineitem GROUP BY l_partkey, l_suppkey)
SELECT l_partkey, min(l_suppkey) AS promoted, count(*) AS "left" FROM x WHERE n > 1 GROUP BY l_partkey"""),
    "sorted_members": (sorted_members, "SELECT s_nationkey, members, sha256(members) AS content_hash FROM (SELECT s_nationkey, string_agg(s_name, '|' ORDER BY s_name) AS members FROM supplier GROUP BY s_nationkey)"),
    "edge_sync": (edge_sync, """WITH e AS (SELECT l_partkey AS p, l_suppkey AS s, l_returnflag AS f, bool_or(l_quantity > 40) AS large FROM lineitem GROUP BY ALL),
w AS (FROM e WHERE f = 'R'), c AS (FROM e WHERE f = 'N' AND p IN (SELECT p FROM w)),
d AS (SELECT coalesce(c.p, w.p) AS l_partkey, coalesce(c.s, w.s) AS l_suppkey, CASE WHEN c.p IS NULL THEN 'add' WHEN w.p IS NULL THEN 'delete' WHEN c.large IS DISTINCT FROM w.large THEN 'update' END AS action FROM c FULL JOIN w ON c.p = w.p AND c.s = w.s)
SELECT * FROM d WHERE action IS NOT NULL"""),
    "upsert_full": (upsert_full, _OLD_NEW + "SELECT * FROM o WHERE id NOT IN (SELECT id FROM w) UNION ALL SELECT * FROM w"),
    "upsert_partial": (upsert_partial, _OLD_NEW + _MERGED.format("w.slug", "w.vendor", "w.pricing")),
    "upsert_not_blank": (upsert_not_blank, _OLD_NEW + _MERGED.format("nullif(w.slug, '')", "nullif(w.vendor, '')", "nullif(w.pricing, '')")),
    "insert_absent": (insert_absent, _OLD_NEW + "SELECT * FROM o UNION ALL SELECT * FROM w WHERE id NOT IN (SELECT id FROM o)"),
    "replace_by_key": (replace_by_key, """WITH r AS (SELECT DISTINCT tool_id, alternative_id, CAST(similarity AS DOUBLE) AS similarity FROM alternatives WHERE tool_id IS NOT NULL AND alternative_id IS NOT NULL AND similarity IS NOT NULL),
k AS (SELECT DISTINCT id FROM tools WHERE status = 'published') SELECT * FROM r WHERE tool_id NOT IN (FROM k) UNION ALL SELECT * FROM r WHERE tool_id IN (FROM k) AND similarity >= 0.8"""),
    "update_column": (update_column, _OLD_NEW + "SELECT o.id, o.slug, o.vendor, CASE WHEN w.id IS NOT NULL THEN w.pricing ELSE o.pricing END AS pricing, o.quality_score FROM o LEFT JOIN w ON o.id = w.id"),
    "events_latest": (events_latest, "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"),
    "json_map_edges": (json_map_edges, "SELECT event_id, k AS axis, json_extract_string(props, '$.' || k) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)"),
    "daily_events": (daily_events, "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL"),
    "text_search": (text_search, "SELECT doc_id, lang FROM documents WHERE text ILIKE '%api%'"),
    "page_of_rows": (page_of_rows, "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 100"),
    "nation_lookup": (nation_lookup, "SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = (SELECT min(n_nationkey) FROM nation WHERE n_regionkey = 1)"),
}
