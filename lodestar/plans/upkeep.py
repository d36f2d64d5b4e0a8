"""Queries on upkeep: vectors by id, deltas with what is settled, selectors, lists and maps of tools, fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import text as X
from lodestar.functions import values as V
from lodestar.operators import writes
from lodestar.operators.delta import changed, content_hash, latest
from lodestar.operators.selection import of_keys, select_status, settled
from lodestar.plans.catalogue import _JSON, _PAGES, _RICH, _enriched, _pages, category_edges
from lodestar.plans.published import _MOMENT, ENTRIES as _PUBLISHED, _tools, duplicate_report
from lodestar.plans.tables import _LATEST_TOOLS
from lodestar.runtime import table


def vector_upsert(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the vector table by (entity_type, entity_id, model): the first version of each, replaced by one of the last 30 days.

    Slugs become tool ids, of several the smallest; vectors that are no JSON arrays and slugs without a tool drop out. What is
    written carries the run id and its time.
    """
    rows = table(spark, root, "tool_embeddings").select("slug", "model", "content_hash", V.moment(F.col("created_at")).alias("at"), F.size(F.from_json("embedding_json", "array<double>")).alias("n"))
    rows = rows.where("n > 0 AND model IS NOT NULL AND at IS NOT NULL")
    ids = table(spark, root, "tools").where("slug IS NOT NULL").groupBy("slug").agg(F.min("id").alias("entity_id"))
    rows = rows.join(ids, "slug").select(F.lit("tool").alias("entity_type"), "entity_id", "model", F.coalesce("content_hash", F.lit("")).alias("content_hash"), "at")
    key = ["entity_type", "entity_id", "model"]
    run = rows.agg(F.max("at").alias("run"))
    fresh = rows.join(F.broadcast(run), F.lit(True)).where(~V.older_than(F.col("at"), F.col("run"), 30))  # one row
    new = latest(fresh, key, F.desc("at"), F.desc("content_hash")).select(*key, "content_hash", F.concat(F.lit("publish-"), F.unix_timestamp("run").cast("string")).alias("run_id"), F.col("run").alias("updated_at"))
    old = latest(rows, key, F.asc("at"), F.asc("content_hash")).select(*key, "content_hash", F.lit(None).cast("string").alias("run_id"), F.col("at").alias("updated_at"))
    return writes.upsert(old, new, key).withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


def classify_delta(spark: SparkSession, root: str) -> DataFrame:
    """Tools to classify again, as their texts or the vocabulary changed since they were first enriched, and whether to tag them too.

    The hash for classes covers the vocabulary (a fixed table, as JSON in order of its keys), that for tags does not. A first
    enrichment without a short description had failed and is in no state, so its tool is always due.
    """
    names = _pages(spark, root, "name")
    terms = table(spark, root, "nation").agg(F.array_sort(F.collect_list(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")))).alias("terms"))  # 25 rows
    version = terms.select(F.to_json("terms").alias("version"))
    order = ["enriched_at", "content_hash", "short_desc"]
    rows = table(spark, root, "enriched_tools").select("slug", *order, "description_md", "application_category")
    parts = [F.col(c) for c in ("name", "short_desc", "description_md")]

    def hashed(texts: DataFrame) -> DataFrame:
        with_version = texts.join(names, "slug").join(F.broadcast(version), F.lit(True))  # one row
        return with_version.select("slug", "short_desc", content_hash(*parts, F.col("application_category"), F.col("version")).alias("class_hash"), content_hash(*parts).alias("tag_hash"))

    last = hashed(latest(rows, ["slug"], *map(F.desc_nulls_last, order)))
    state = settled(hashed(latest(rows, ["slug"], *map(F.asc_nulls_last, order))), ~X.blank(F.col("short_desc")))
    due = changed(last, state.select("slug", "class_hash"), "slug", "class_hash").join(state.select("slug", F.col("tag_hash").alias("seen")), "slug", "left")
    return due.select("slug", F.col("class_hash").alias("content_hash"), (~F.col("tag_hash").eqNullSafe(F.col("seen"))).alias("tag_due"))


def status_selection(spark: SparkSession, root: str) -> DataFrame:
    """How many tools each selector takes: published, draft (strictly and not) and all."""
    tools = table(spark, root, "tools").select("slug", "status")
    picks = [("published", True), ("draft", True), ("draft", False), ("all", True)]
    counts = [select_status(tools, wanted, strict).agg(F.lit(wanted).alias("wanted"), F.lit(strict).alias("strict"), F.count_distinct("slug").alias("slugs")) for wanted, strict in picks]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def key_vectors(spark: SparkSession, root: str) -> DataFrame:
    """Vectors of the slugs that have matches, with how many numbers each has; unreadable and empty ones are skipped."""
    vectors = table(spark, root, "tool_embeddings").select("slug", "model", "created_at", F.from_json("embedding_json", "array<double>").alias("v")).where("size(v) > 0")
    return of_keys(vectors, table(spark, root, "dedup_map"), "slug").select("slug", "model", "created_at", F.size("v").alias("numbers")).distinct()


def duplicate_lines(spark: SparkSession, root: str) -> DataFrame:
    """The report of duplicates as lines, each under its canonical tool."""
    rows = duplicate_report(spark, root).where("slug <> canonical_slug")
    score = F.when(F.col("score").isNotNull(), F.format_string("  cosine=%.4f", "score")).otherwise("")
    return rows.select("canonical_slug", F.concat("slug", F.lit("  ["), "reason", score, F.lit("]")).alias("line"))


def tool_kinds(spark: SparkSession, root: str) -> DataFrame:
    """Of each tool the number of its documents by kind as a JSON object, an empty one where there are none."""
    counts = table(spark, root, "documents").where("tool_slug IS NOT NULL AND kind IS NOT NULL").groupBy(F.col("tool_slug").alias("slug"), "kind").agg(F.count("*").alias("n"))
    pair = F.concat(F.lit('"'), "kind", F.lit('":'), F.col("n").cast("string"))
    maps = counts.groupBy("slug").agg(F.array_join(F.array_sort(F.collect_list(pair)), ",").alias("pairs"))  # as many as there are kinds
    tools = table(spark, root, "tools").select("slug").dropna().distinct()
    return tools.join(maps, "slug", "left").select("slug", F.concat(F.lit("{"), F.coalesce("pairs", F.lit("")), F.lit("}")).alias("kinds"))


def tool_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    """Hash of the five fields of a tool whose change makes its pages due."""
    rows = _tools(spark, root, "name", "pricing", "quality_score").join(_enriched(spark, root, "short_desc"), "slug", "left")
    return rows.select("id", F.sha2(X.fingerprint(*map(F.col, ("slug", "name", "short_desc", "pricing", "quality_score"))), 256).alias("fingerprint"))


def category_tools(spark: SparkSession, root: str) -> DataFrame:
    """Edges of categories and published tools by id."""
    tools = _tools(spark, root, "status").where("status = 'published'").select("id", "slug")
    return category_edges(spark, root).join(tools, "slug").select("id", "category", "is_primary").distinct()


def published_list(spark: SparkSession, root: str) -> DataFrame:
    """The published tools in order of their slugs."""
    return _tools(spark, root, "name", "status").where("status = 'published'").select("id", "slug", "name").orderBy("slug", "id")


_LAST = "FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, slug DESC{0}) AS n FROM (SELECT DISTINCT * FROM tools)) WHERE n = 1"
_STAMP = "strftime({0} AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')"
ENTRIES = {
    "vector_upsert": (vector_upsert, f"""
WITH i AS (SELECT slug, min(id) AS entity_id FROM tools WHERE slug IS NOT NULL GROUP BY 1),
r AS (SELECT 'tool' AS entity_type, entity_id, model, coalesce(content_hash, '') AS content_hash, {_MOMENT.format('created_at')} AS "at" FROM tool_embeddings JOIN i USING (slug) WHERE model IS NOT NULL AND len({_JSON.format('embedding_json').replace('VARCHAR[]', 'DOUBLE[]')}) > 0),
g AS (SELECT * FROM r WHERE "at" IS NOT NULL), m AS (SELECT max("at") AS run FROM g),
n AS (SELECT *, row_number() OVER (PARTITION BY entity_id, model ORDER BY "at" DESC, content_hash DESC) AS p FROM g, m WHERE "at" >= run - INTERVAL 30 DAYS),
o AS (SELECT *, row_number() OVER (PARTITION BY entity_id, model ORDER BY "at", content_hash) AS p FROM g)
SELECT entity_type, entity_id, model, content_hash, 'publish-' || CAST(floor(epoch(run)) AS BIGINT) AS run_id, {_STAMP.format('run')} AS updated_at FROM n WHERE p = 1
UNION ALL SELECT entity_type, entity_id, model, content_hash, NULL, {_STAMP.format('"at"')} FROM o WHERE p = 1 AND NOT EXISTS (FROM n WHERE n.entity_id = o.entity_id AND n.model = o.model)"""),
    "classify_delta": (classify_delta, f"""WITH {_PAGES}, v AS (SELECT '[' || string_agg('{{"name":"' || n_name || '","region":' || n_regionkey || '}}', ',' ORDER BY n_name) || ']' AS version FROM nation),
e AS (SELECT e.*, coalesce(p.name, '') || coalesce(short_desc, '') || coalesce(description_md, '') AS t,
  row_number() OVER (PARTITION BY slug ORDER BY enriched_at DESC NULLS LAST, content_hash DESC NULLS LAST, short_desc DESC NULLS LAST) AS late,
  row_number() OVER (PARTITION BY slug ORDER BY enriched_at NULLS LAST, content_hash NULLS LAST, short_desc NULLS LAST) AS early FROM (SELECT DISTINCT * FROM enriched_tools) e JOIN pages p USING (slug)),
h AS (SELECT slug, late, early, short_desc, sha256(t || coalesce(application_category, '') || version) AS c, sha256(t) AS g FROM e, v)
SELECT l.slug, l.c AS content_hash, l.g IS DISTINCT FROM s.g AS tag_due FROM h l LEFT JOIN (FROM h WHERE early = 1 AND trim(coalesce(short_desc, '')) <> '') s USING (slug) WHERE l.late = 1 AND l.c IS DISTINCT FROM s.c"""),
    "status_selection": (status_selection, """
SELECT 'published' AS wanted, true AS strict, count(DISTINCT slug) AS slugs FROM tools WHERE status = 'published' UNION ALL SELECT 'draft', true, count(DISTINCT slug) FROM tools WHERE status = 'draft'
UNION ALL SELECT 'draft', false, count(DISTINCT slug) FROM tools UNION ALL SELECT 'all', true, count(DISTINCT slug) FROM tools"""),
    "key_vectors": (key_vectors, """
SELECT DISTINCT slug, model, created_at, CAST(len(v) AS INTEGER) AS numbers FROM (SELECT *, TRY_CAST(TRY_CAST(embedding_json AS JSON) AS DOUBLE[]) AS v FROM tool_embeddings)
WHERE len(v) > 0 AND slug IN (SELECT slug FROM dedup_map)"""),
    "duplicate_lines": (duplicate_lines, f"SELECT canonical_slug, slug || '  [' || reason || coalesce(printf('  cosine=%.4f', score), '') || ']' AS line FROM ({_PUBLISHED['duplicate_report'][1]}) WHERE slug <> canonical_slug"),
    "tool_kinds": (tool_kinds, """
WITH c AS (SELECT tool_slug AS slug, kind, count(*) AS n FROM documents WHERE tool_slug IS NOT NULL AND kind IS NOT NULL GROUP BY ALL), j AS (SELECT slug, string_agg('"' || kind || '":' || n, ',' ORDER BY kind) AS p FROM c GROUP BY slug)
SELECT t.slug, '{' || coalesce(p, '') || '}' AS kinds FROM (SELECT DISTINCT slug FROM tools WHERE slug IS NOT NULL) t LEFT JOIN j USING (slug)"""),
    "tool_fingerprints": (tool_fingerprints, f"""WITH {_RICH}, t AS (SELECT id, slug, name, pricing, quality_score {_LAST.format(', name DESC NULLS LAST, pricing DESC NULLS LAST, quality_score DESC NULLS LAST')})
SELECT id, sha256(coalesce(t.slug, '') || '~' || coalesce(name, '') || '~' || coalesce(short_desc, '') || '~' || coalesce(t.pricing, '') || '~' || coalesce(CAST(t.quality_score AS VARCHAR), '')) AS fingerprint FROM t LEFT JOIN rich ON rich.slug = t.slug"""),
    "category_tools": (category_tools, f"""WITH {_PAGES}, {_LATEST_TOOLS}, x AS (SELECT slug, primary_category, unnest({_JSON.format('categories_json')}) AS category FROM pages)
SELECT DISTINCT id, category, category = primary_category AS is_primary FROM x JOIN t USING (slug) WHERE t.status = 'published'"""),
    "published_list": (published_list, f"SELECT id, slug, name FROM (SELECT * {_LAST.format(', name DESC NULLS LAST, status DESC NULLS LAST')}) WHERE status = 'published' ORDER BY slug, id"),
}
