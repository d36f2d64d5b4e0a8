"""Queries on similarity and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import text as X
from lodestar.functions import values as V
from lodestar.operators.components import apply_duplicates, canonical_members, components, reset_duplicates
from lodestar.operators.delta import latest
from lodestar.operators.similarity import count_links, nearest
from lodestar.runtime import table


def _vectors(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "embeddings").select(F.col("vec_id").alias("id"), "label", V.unit(F.col("embedding")).alias("unit"))


def top_alternatives(spark: SparkSession, root: str) -> DataFrame:
    """The five most similar vectors of every 20th one, with a cosine of at least 0.3 and the reason text."""
    rows = _vectors(spark, root)
    found = nearest(rows.where("id % 20 = 0"), rows, 5, 0.3, decimals=3)
    similarity = V.clamp_similarity(F.col("similarity"))
    return found.select(F.col("id").alias("vec_id"), F.col("other").alias("alternative_id"), "rank_no", similarity.alias("similarity"), F.format_string("semantic similarity (cosine %.3f)", similarity).alias("reason"))


def similarity_links(spark: SparkSession, root: str) -> DataFrame:
    """For every 20th vector the number of vectors with a cosine of at least 0.25, and the best one."""
    rows = _vectors(spark, root)
    return count_links(rows.where("id % 20 = 0"), rows, 0.25).withColumnRenamed("id", "vec_id")


def vector_search(spark: SparkSession, root: str) -> DataFrame:
    """The ten rows most similar to the vector of the smallest id, by a cosine of at least 0.1."""
    rows = table(spark, root, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    query = rows.orderBy("vec_id").limit(1).select(F.col("v").alias("q"))
    scored = rows.join(F.broadcast(query), F.lit(True)).select("vec_id", "label", F.round(V.cosine(F.col("v"), F.col("q")), 6).alias("similarity"))  # one row
    return scored.where("similarity >= 0.1").orderBy(F.desc("similarity"), "vec_id").limit(10)


def vector_search_lang(spark: SparkSession, root: str, language: str = "en") -> DataFrame:
    """Search in one of two tables of vectors; the other one is pruned, as the language is a literal."""
    rows = table(spark, root, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    sides = [rows.where(f"label % 2 = {n}").where(F.lit(language) == F.lit(code)).withColumn("lang", F.lit(code)) for n, code in ((0, "en"), (1, "fr"))]
    query = rows.orderBy(F.desc("vec_id")).limit(1).select(F.col("v").alias("q"))
    scored = sides[0].unionByName(sides[1]).join(F.broadcast(query), F.lit(True))  # one row
    return scored.select("vec_id", "lang", F.round(V.cosine(F.col("v"), F.col("q")), 6).alias("similarity")).orderBy(F.desc("similarity"), "vec_id").limit(12)


def parse_vectors(spark: SparkSession, root: str) -> DataFrame:
    """Numbers of the vectors given as JSON: how many there are, and the length; null where the text is no array."""
    v = F.from_json("embedding_json", "array<double>")
    rows = table(spark, root, "tool_embeddings").select("slug", "model", "created_at", v.alias("v"))
    return rows.where("v IS NOT NULL AND size(v) > 0").select("slug", "model", "created_at", F.size("v").cast("bigint").alias("numbers"), F.round(V.dot(F.col("v"), F.col("v")), 4).alias("squared"))


def domains(spark: SparkSession, root: str) -> DataFrame:
    """Both forms of the host of every address."""
    rows = table(spark, root, "raw_tools").select("website_url").distinct()
    return rows.select("website_url", X.loose_host(F.col("website_url")).alias("loose_host"), X.strict_host(F.col("website_url")).alias("strict_host"))


def same_domain(spark: SparkSession, root: str) -> DataFrame:
    """Of each slug the smallest slug of its host and the number of others there; pairs are not written out."""
    rows = table(spark, root, "raw_tools").select("slug", X.strict_host(F.col("website_url")).alias("host")).dropna().distinct()
    hosts = rows.groupBy("host").agg(F.min("slug").alias("class_slug"), (F.count("*") - 1).alias("links"))
    return rows.join(hosts, "host").select("slug", "host", "class_slug", "links")


def _duplicate_graph(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    edges = table(spark, root, "dedup_map").where("score >= 0.92").select(F.col("slug").alias("a"), F.col("canonical_slug").alias("b"))
    nodes = table(spark, root, "raw_tools").select(F.col("slug").alias("node")).distinct()
    inside = edges.join(nodes.withColumnRenamed("node", "a"), "a", "left_semi").join(nodes.withColumnRenamed("node", "b"), "b", "left_semi")
    return nodes, inside.select("a", "b")


def duplicate_groups(spark: SparkSession, root: str) -> DataFrame:
    """Groups of tools whose matches have a score of at least 0.92, directly or through others."""
    nodes, edges = _duplicate_graph(spark, root)
    return components(nodes, edges).select(F.col("node").alias("slug"), F.col("component").alias("group_slug"))


def _canonical(spark: SparkSession, root: str) -> DataFrame:
    groups = duplicate_groups(spark, root)
    facts = table(spark, root, "enriched_tools").groupBy("slug").agg(F.max("quality_score").alias("score"), F.max(F.length("description_md")).alias("length"))
    members = groups.join(facts, "slug", "left").select(F.col("group_slug").alias("component"), F.col("slug").alias("node"), "score", F.coalesce("length", F.lit(0)).alias("length"))
    return groups.join(canonical_members(members).withColumnRenamed("component", "group_slug"), "group_slug")


def duplicate_canonical(spark: SparkSession, root: str) -> DataFrame:
    """Duplicates with the canonical member of their group: highest score, longest text, smallest slug."""
    return _canonical(spark, root).where("slug <> canonical").select("slug", "canonical")


def _applied(spark: SparkSession, root: str) -> DataFrame:
    tools = table(spark, root, "tools").select("id", "slug", "status").distinct()
    return apply_duplicates(tools, duplicate_canonical(spark, root), "slug")


def dedup_apply(spark: SparkSession, root: str) -> DataFrame:
    """Status of all tools after duplicates were marked, with what it was before."""
    return _applied(spark, root).select("id", "slug", "status", "prev_status")


def dedup_reset(spark: SparkSession, root: str) -> DataFrame:
    """Applying and undoing gives what was there."""
    return reset_duplicates(_applied(spark, root)).select("id", "slug", "status")


def pair_reasons(spark: SparkSession, root: str) -> DataFrame:
    """Why pairs match: found by host, by vector or by both, from two tables of pairs put together."""
    rows = table(spark, root, "dedup_map").where("slug <> canonical_slug").select(F.least("slug", "canonical_slug").alias("a"), F.greatest("slug", "canonical_slug").alias("b"), "reason", "score")
    one = rows.where("reason LIKE '%domain%'").select("a", "b").distinct()
    two = rows.where("reason LIKE '%embedding%'").groupBy("a", "b").agg(F.max("score").alias("score"))
    both = one.withColumn("by_host", F.lit(True)).join(two.withColumn("by_vector", F.lit(True)), ["a", "b"], "full_outer")
    reason = F.concat_ws("+", F.when(F.col("by_host"), "domain"), F.when(F.col("by_vector"), "embedding"))
    return both.select("a", "b", reason.alias("reason"), F.round("score", 4).alias("score"))


def dedup_latest(spark: SparkSession, root: str) -> DataFrame:
    """The latest match of every slug."""
    return latest(table(spark, root, "dedup_map").where("slug IS NOT NULL").select("slug", "canonical_slug", "detected_at", "reason"), ["slug"], F.desc("detected_at"), F.asc_nulls_first("canonical_slug"), F.asc_nulls_first("reason")).select("slug", "canonical_slug", "detected_at")


_RAW = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"
_COS = f"round({_RAW}, 6)"
_LOOSE = "nullif(split_part(regexp_replace(regexp_replace(lower(trim({u})), '^.*?://', ''), '^www\\.', ''), '/', 1), '')"
_STRICT = "nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({u})), '^[a-z][a-z0-9+.-]*://', ''), '[/?#].*$', ''), '^[^@]*@', ''), ':.*$', ''), '^www\\.', ''), '')"
_GROUPS = """
WITH RECURSIVE nodes AS (SELECT DISTINCT slug FROM raw_tools WHERE slug IS NOT NULL),
links AS (SELECT slug AS a, canonical_slug AS b FROM dedup_map WHERE score >= 0.92 AND slug IN (FROM nodes) AND canonical_slug IN (FROM nodes)),
pairs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT slug AS a, slug AS b FROM nodes UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON pairs.a = reach.b),
grouped AS (SELECT a AS slug, min(b) AS group_slug FROM reach GROUP BY a),
facts AS (SELECT slug, max(quality_score) AS score, max(length(description_md)) AS len FROM enriched_tools GROUP BY slug),
ranked AS (SELECT g.slug, g.group_slug, first_value(g.slug) OVER (PARTITION BY group_slug ORDER BY score DESC NULLS LAST, coalesce(len, 0) DESC, g.slug) AS canonical FROM grouped g LEFT JOIN facts USING (slug)),
doubles AS (SELECT slug, canonical FROM ranked WHERE slug <> canonical)
"""
ENTRIES = {
    "top_alternatives": (top_alternatives, f"""
SELECT vec_id, alternative_id, CAST(rank_no AS INTEGER) AS rank_no, least(round(s, 3), 9.999) AS similarity, printf('semantic similarity (cosine %.3f)', least(round(s, 3), 9.999)) AS reason FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, alternative_id) AS rank_no FROM (
    SELECT a.vec_id, b.vec_id AS alternative_id, round({_RAW}, 3) AS s FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) WHERE s >= 0.3) WHERE rank_no <= 5"""),
    "similarity_links": (similarity_links, f"""
SELECT a.vec_id, count(*) AS links, max({_COS}) AS best FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
WHERE a.vec_id % 20 = 0 AND {_COS} >= 0.25 GROUP BY a.vec_id"""),
    "vector_search": (vector_search, f"""
SELECT b.vec_id, b.label, {_COS} AS similarity FROM (FROM embeddings ORDER BY vec_id LIMIT 1) a, embeddings b WHERE {_COS} >= 0.1 ORDER BY similarity DESC, vec_id LIMIT 10"""),
    "vector_search_lang": (vector_search_lang, f"""
SELECT b.vec_id, 'en' AS lang, {_COS} AS similarity FROM (FROM embeddings ORDER BY vec_id DESC LIMIT 1) a, embeddings b WHERE b.label % 2 = 0 ORDER BY similarity DESC, vec_id LIMIT 12"""),
    "parse_vectors": (parse_vectors, """
SELECT slug, model, created_at, len(v) AS numbers, round(list_sum(list_transform(v, lambda x: x * x)), 4) AS squared
FROM (SELECT slug, model, created_at, TRY_CAST(TRY_CAST(embedding_json AS JSON) AS DOUBLE[]) AS v FROM tool_embeddings) WHERE len(v) > 0"""),
    "domains": (domains, f"SELECT website_url, {_LOOSE.format(u='website_url')} AS loose_host, {_STRICT.format(u='website_url')} AS strict_host FROM (SELECT DISTINCT website_url FROM raw_tools)"),
    "same_domain": (same_domain, f"""
WITH r AS (SELECT DISTINCT slug, {_STRICT.format(u='website_url')} AS host FROM raw_tools WHERE slug IS NOT NULL)
SELECT slug, host, min(slug) OVER (PARTITION BY host) AS class_slug, count(*) OVER (PARTITION BY host) - 1 AS links FROM r WHERE host IS NOT NULL"""),
    "duplicate_groups": (duplicate_groups, _GROUPS + "SELECT slug, group_slug FROM grouped"),
    "duplicate_canonical": (duplicate_canonical, _GROUPS + "SELECT slug, canonical FROM doubles"),
    "dedup_apply": (dedup_apply, _GROUPS + """
SELECT DISTINCT id, t.slug, CASE WHEN d.slug IS NOT NULL THEN 'duplicate' ELSE status END AS status,
       CASE WHEN d.slug IS NOT NULL AND coalesce(status, '') <> 'duplicate' THEN status END AS prev_status FROM tools t LEFT JOIN doubles d ON t.slug = d.slug"""),
    "dedup_reset": (dedup_reset, "SELECT DISTINCT id, slug, status FROM tools"),
    "pair_reasons": (pair_reasons, """
WITH r AS (SELECT least(slug, canonical_slug) AS a, greatest(slug, canonical_slug) AS b, reason, score FROM dedup_map WHERE slug <> canonical_slug),
one AS (SELECT DISTINCT a, b, 'domain' AS x FROM r WHERE reason LIKE '%domain%'), two AS (SELECT a, b, max(score) AS score, 'embedding' AS y FROM r WHERE reason LIKE '%embedding%' GROUP BY a, b)
SELECT a, b, concat_ws('+', x, y) AS reason, round(score, 4) AS score FROM one FULL JOIN two USING (a, b)"""),
    "dedup_latest": (dedup_latest, """
SELECT slug, canonical_slug, detected_at FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY detected_at DESC NULLS LAST, canonical_slug ASC NULLS FIRST, reason ASC NULLS FIRST) AS n
FROM (SELECT DISTINCT * FROM dedup_map WHERE slug IS NOT NULL)) WHERE n = 1"""),
}
