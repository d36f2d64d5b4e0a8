"""Queries on what is published: search over tools, duplicates with their reasons, export, translations, logs and misses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import text as X
from lodestar.functions import values as V
from lodestar.operators import writes
from lodestar.operators.components import canonical_members, components
from lodestar.operators.delta import latest
from lodestar.plans.catalogue import _CLEAN, _JSON, _PAGES, _RICH, _TEN, _enriched, _pages
from lodestar.plans.matching import _STRICT
from lodestar.runtime import table


def _tools(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    rows = table(spark, root, "tools").select(*dict.fromkeys(["id", "updated_at", "slug", *columns]))
    order = [F.desc_nulls_last("updated_at"), F.desc("slug"), *[F.desc_nulls_last(c) for c in columns]]
    return latest(rows, ["id"], *order).select("id", "slug", *columns)


def search_tools(spark: SparkSession, root: str, k: int = 10, least: float = 0.3) -> DataFrame:
    """The published tools nearest to the vector of the smallest tool id: id, slug, name, short_desc, score and cosine.

    Vectors that are null, of another size, not finite or all zero do not count; a tool with several counts by its best.
    """
    vectors = table(spark, root, "search_embeddings").select("tool_id", F.col("embedding").cast("array<double>").alias("v"))
    vectors = vectors.where((F.size("v") == 64) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)) & F.exists("v", lambda x: x != 0))
    query = vectors.orderBy("tool_id", "v").limit(1).select(F.col("v").alias("q"))
    scored = vectors.join(F.broadcast(query), F.lit(True)).select("tool_id", F.round(V.cosine(F.col("v"), F.col("q")), 6).alias("similarity"))  # one row
    best = scored.groupBy(F.col("tool_id").alias("id")).agg(F.max("similarity").alias("similarity")).where(F.col("similarity") >= least)
    tools = _tools(spark, root, "name", "quality_score", "status").where("status = 'published'").drop("status")
    found = best.join(tools, "id").join(_enriched(spark, root, "short_desc"), "slug", "left")
    return found.orderBy(F.desc("similarity"), "id").limit(k).select("id", "slug", "name", "short_desc", "quality_score", "similarity")


def _signals(spark: SparkSession, root: str) -> DataFrame:
    """(a, b, by_host, score): edges of tools on one host, each to the smallest slug there, and of matches of at least 0.92."""
    hosts = table(spark, root, "raw_tools").select("slug", X.strict_host(F.col("website_url")).alias("host")).dropna().distinct()
    firsts = hosts.groupBy("host").agg(F.min("slug").alias("b"))
    by_host = hosts.join(firsts, "host").where("slug <> b").select(F.col("slug").alias("a"), "b", F.lit(True).alias("by_host"), F.lit(None).cast("double").alias("score"))
    known = hosts.select("slug").distinct()
    by_vector = table(spark, root, "dedup_map").where("score >= 0.92 AND slug <> canonical_slug").select(F.col("slug").alias("a"), F.col("canonical_slug").alias("b"), F.lit(False).alias("by_host"), "score")
    by_vector = by_vector.join(known.withColumnRenamed("slug", "a"), "a", "left_semi").join(known.withColumnRenamed("slug", "b"), "b", "left_semi")
    return by_host.unionByName(by_vector)


def duplicate_report(spark: SparkSession, root: str) -> DataFrame:
    """Of each tool in a group of duplicates: the canonical one, why it is in the group, and the best score that links it.

    Tools are linked by their host or by a match of vectors, directly or through others; pairs are not written out.
    """
    edges = _signals(spark, root)
    nodes = table(spark, root, "raw_tools").select(F.col("slug").alias("node")).dropna().distinct()
    groups = components(nodes, edges.select("a", "b"))
    why = edges.select(F.explode(F.array("a", "b")).alias("node"), "by_host", "score").groupBy("node").agg(F.bool_or("by_host").alias("host"), F.max("score").alias("score"))
    facts = table(spark, root, "enriched_tools").groupBy(F.col("slug").alias("node")).agg(F.max("quality_score").alias("quality"), F.max(F.length("description_md")).alias("length"))
    members = groups.join(facts, "node", "left").select("component", "node", F.col("quality").alias("score"), F.coalesce("length", F.lit(0)).alias("length"))
    reason = F.concat_ws("+", F.when(F.col("host"), "domain"), F.when(F.col("score").isNotNull(), "embedding"))
    report = groups.join(canonical_members(members), "component").join(why, "node")
    return report.select(F.col("node").alias("slug"), F.col("canonical").alias("canonical_slug"), reason.alias("reason"), F.round("score", 4).alias("score"))


_LISTS = {"pros_jsonb": "pros_json", "cons_jsonb": "cons_json"}
_PLAIN = ["pricing_note", "short_desc", "description_md", "application_category"]


def export_records(spark: SparkSession, root: str) -> DataFrame:
    """The export of every enriched page with its 21 fields; lists and maps as JSON text, as in the file."""
    raw = _pages(spark, root, "name", "vendor", "website_url", "source_url", "status").alias("r")
    rich = _enriched(spark, root, "pricing", *_PLAIN, "quality_score", "seo_title", "seo_description", "pros_json", "cons_json", "faq_json").alias("e")
    rows = raw.join(rich, F.col("r.slug") == F.col("e.slug"))
    text = lambda c: F.coalesce(c, F.lit(""))
    name = F.when(text("r.name") == "", F.col("r.slug")).otherwise(F.col("r.name"))
    made = F.when(text("e.short_desc") == "", name).otherwise(F.concat(name, F.lit(" — "), "e.short_desc"))
    title = F.when(F.trim(text("e.seo_title")) != "", F.col("e.seo_title")).otherwise(F.substring(F.regexp_replace(made, "^[ —]+|[ —]+$", ""), 1, 60))
    source = F.coalesce(*[F.nullif(text(c), F.lit("")) for c in ("e.short_desc", "e.description_md", "r.name")], F.lit(""))
    description = F.when(F.trim(text("e.seo_description")) != "", F.col("e.seo_description")).otherwise(F.substring(X.clean(source), 1, 155))
    listed = lambda c: F.to_json(F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>")))
    faq = F.to_json(F.coalesce(F.from_json("e.faq_json", "array<struct<q:string,a:string>>"), F.array().cast("array<struct<q:string,a:string>>")))
    return rows.select(
        "r.slug", *[text(f"r.{c}").alias(c) for c in ("name", "vendor", "website_url", "source_url")], F.lower(F.trim(F.coalesce("e.pricing", F.lit("unknown")))).alias("pricing"),
        *[text(f"e.{c}").alias(c) for c in _PLAIN], V.score_or_null(F.col("e.quality_score")).alias("quality_score"), F.coalesce(F.nullif("r.status", F.lit("")), F.lit("draft")).alias("status"),
        title.alias("seo_title"), description.alias("seo_description"), *[listed(F.col(f"e.{c}")).alias(n) for n, c in _LISTS.items()], F.sha2(faq, 256).alias("faq_hash"),
        F.lit("[]").alias("categories"), F.lit("").alias("primary_category"), F.lit("{}").alias("facets"), F.lit("[]").alias("tags"),
    )


def lookup_misses(spark: SparkSession, root: str) -> DataFrame:
    """How many tools have a vector and how many do not, and how many compare pages name two known tools or miss one."""
    tools = table(spark, root, "tools").select("slug").dropna().distinct()
    known = table(spark, root, "tool_embeddings").select("slug", F.lit(True).alias("hit")).dropna().distinct()
    one = tools.join(known, "slug", "left").agg(F.lit("vector").alias("lookup"), F.count("hit").alias("found"), F.count_if(F.col("hit").isNull()).alias("missed"))
    pages = table(spark, root, "raw_tools").select("slug").dropna().distinct()
    keys = table(spark, root, "page_seo").where("page_key LIKE '%-vs-%'").select("page_key", F.split("page_key", "-vs-").alias("p")).distinct()
    sides = keys.select("page_key", F.explode("p").alias("slug")).join(pages.withColumn("hit", F.lit(True)), "slug", "left").groupBy("page_key").agg(F.count_if(F.col("hit").isNull()).alias("gone"))
    two = sides.agg(F.lit("both sides").alias("lookup"), F.count_if(F.col("gone") == 0).alias("found"), F.count_if(F.col("gone") > 0).alias("missed"))
    return one.unionByName(two)


def localized_texts(spark: SparkSession, root: str, language: str = "fr") -> DataFrame:
    """The description of each documented tool in one language, else in English, and which of the two it is."""
    rows = table(spark, root, "documents").where("tool_slug IS NOT NULL AND trim(text) <> ''").select("tool_slug", "lang", "doc_id", "text")
    first = rows.groupBy(F.col("tool_slug").alias("slug")).agg(
        F.min_by("text", F.when(F.col("lang") == language, F.col("doc_id"))).alias("own"), F.min_by("text", F.when(F.col("lang") == "en", F.col("doc_id"))).alias("english")
    )
    shown = F.coalesce(F.nullif("own", F.lit("")), "english")
    return first.where(shown.isNotNull()).select("slug", F.when(F.nullif("own", F.lit("")).isNotNull(), language).otherwise("en").alias("shown_in"), F.sha2(shown, 256).alias("text_hash"))


def to_translate(spark: SparkSession, root: str, language: str = "fr") -> DataFrame:
    """Tools with an English document and none in the language."""
    rows = table(spark, root, "documents").where("tool_slug IS NOT NULL").select(F.col("tool_slug").alias("slug"), "lang")
    return rows.where("lang = 'en'").select("slug").distinct().join(rows.where(F.col("lang") == language), "slug", "left_anti")


def delete_where(spark: SparkSession, root: str) -> DataFrame:
    """Tools without those of a status that is given up; rows of a null status stay."""
    return writes.delete_where(table(spark, root, "tools").select("id", "slug", "status").distinct(), F.col("status") == "draft")


def audit_log(spark: SparkSession, root: str) -> DataFrame:
    """An audit log with a row appended for every tool that has several matches, under the run's id."""
    log = table(spark, root, "dedup_map").where("slug IS NOT NULL AND detected_at IS NOT NULL").select("slug", F.lit("match").alias("action"), F.col("detected_at").alias("at")).distinct()
    now = log.agg(F.max("at").alias("run_id"))
    many = log.groupBy("slug").agg(F.count("*").alias("n")).where("n > 2").join(F.broadcast(now), F.lit(True))  # one row
    return writes.append(log, many.select("slug", F.lit("review").alias("action"), F.col("run_id").alias("at")))


def pair_update(spark: SparkSession, root: str) -> DataFrame:
    """Reasons of alternatives by pair, null or blank ones filled with that of the pair the other way round."""
    rows = table(spark, root, "alternatives").dropna(subset=["tool_id", "alternative_id"]).groupBy("tool_id", "alternative_id").agg(F.max("reason").alias("reason"))
    back = rows.where(~X.blank(F.col("reason"))).select(F.col("alternative_id").alias("tool_id"), F.col("tool_id").alias("alternative_id"), F.col("reason").alias("other"))
    filled = rows.join(back, ["tool_id", "alternative_id"], "left")
    return filled.select("tool_id", "alternative_id", F.when(X.blank(F.col("reason")), F.col("other")).otherwise(F.col("reason")).alias("reason"))


def category_versions(spark: SparkSession, root: str) -> DataFrame:
    """Of each primary category its tools, and the hash that changes with its members but not with their order.

    The members' hashes (60 bits of each) are summed, so that sums are combined before the shuffle and no list is collected.
    """
    pages = _pages(spark, root, "primary_category").where("primary_category IS NOT NULL")
    bits = F.conv(F.substring(F.sha2("slug", 256), 1, 15), 16, 10).cast("decimal(20,0)")
    sums = pages.groupBy("primary_category").agg(F.count("*").alias("tools"), F.sum(bits).alias("members"))
    digest = F.concat_ws("|", F.lit("v1"), "primary_category", F.col("tools").cast("string"), F.coalesce(F.col("members").cast("string"), F.lit("0")))
    return sums.select("primary_category", "tools", F.sha2(digest, 256).alias("content_hash"))


def alias_resolved(spark: SparkSession, root: str) -> DataFrame:
    """Slugs of compare pages with an alias put in for those that a match calls by another name; the smallest name wins."""
    alias = table(spark, root, "dedup_map").where("slug <> canonical_slug").groupBy("slug").agg(F.min("canonical_slug").alias("name"))
    sides = table(spark, root, "page_seo").where("page_key LIKE '%-vs-%'").select("page_key").distinct().select("page_key", F.posexplode(F.split("page_key", "-vs-")).alias("side", "slug"))
    return sides.join(alias, "slug", "left").select("page_key", F.col("side").cast("int").alias("side"), F.coalesce("name", "slug").alias("slug"))


def enrich_delta(spark: SparkSession, root: str) -> DataFrame:
    """Pages to enrich again: those that were never enriched or whose enrichment is older than the page; failed ones (no text) wait."""
    pages = _pages(spark, root, "collected_at", "raw_text").where(~X.blank(F.col("raw_text"))).select("slug", V.moment(F.col("collected_at")).alias("collected"))
    done = table(spark, root, "enriched_tools").groupBy("slug").agg(F.max(V.moment(F.col("enriched_at"))).alias("enriched"))
    open_ = pages.join(done, "slug", "left").where("enriched IS NULL OR enriched < collected")
    return open_.select("slug", F.when(F.col("enriched").isNull(), "new").otherwise("stale").alias("why"))


_LINKS = f"""
nodes AS (SELECT DISTINCT slug FROM raw_tools WHERE slug IS NOT NULL), hosts AS (SELECT DISTINCT slug, {_STRICT.format(u='website_url')} AS host FROM raw_tools WHERE slug IS NOT NULL),
good AS (FROM hosts WHERE host IS NOT NULL), by_host AS (SELECT slug AS a, min(slug) OVER (PARTITION BY host) AS b FROM good),
by_vec AS (SELECT slug AS a, canonical_slug AS b, score FROM dedup_map WHERE score >= 0.92 AND slug <> canonical_slug AND slug IN (SELECT slug FROM good) AND canonical_slug IN (SELECT slug FROM good)),
pairs AS (SELECT a, b FROM by_host WHERE a <> b UNION SELECT b, a FROM by_host WHERE a <> b UNION SELECT a, b FROM by_vec UNION SELECT b, a FROM by_vec),
reach AS (SELECT slug AS a, slug AS b FROM nodes UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON pairs.a = reach.b),
grouped AS (SELECT a AS slug, min(b) AS g FROM reach GROUP BY a), facts AS (SELECT slug, max(quality_score) AS q, max(length(description_md)) AS len FROM enriched_tools GROUP BY slug),
ranked AS (SELECT g.slug, first_value(g.slug) OVER (PARTITION BY g ORDER BY q DESC NULLS LAST, coalesce(len, 0) DESC, g.slug) AS canonical_slug FROM grouped g LEFT JOIN facts USING (slug)),
why AS (SELECT slug, max(h) AS h, max(s) AS s FROM (SELECT a AS slug, 1 AS h, NULL AS s FROM by_host WHERE a <> b UNION ALL SELECT b, 1, NULL FROM by_host WHERE a <> b UNION ALL SELECT a, 0, score FROM by_vec UNION ALL SELECT b, 0, score FROM by_vec) GROUP BY slug)
"""
_MOMENT = "TRY_CAST(nullif(trim({0}), '') AS TIMESTAMPTZ)"
ENTRIES = {
    "search_tools": (search_tools, f"""WITH {_RICH}, v AS (SELECT tool_id, CAST(embedding AS DOUBLE[]) AS v FROM search_embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
q AS (FROM v ORDER BY tool_id, v LIMIT 1), best AS (SELECT v.tool_id AS id, max(round(list_cosine_similarity(v.v, q.v), 6)) AS similarity FROM v, q GROUP BY 1),
t AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, slug DESC, name DESC NULLS LAST, quality_score DESC NULLS LAST, status DESC NULLS LAST) AS n FROM tools)
SELECT t.id, t.slug, t.name, rich.short_desc, t.quality_score, similarity FROM best JOIN t ON t.id = best.id AND n = 1 AND t.status = 'published' LEFT JOIN rich ON rich.slug = t.slug WHERE similarity >= 0.3 ORDER BY similarity DESC, t.id LIMIT 10"""),
    "duplicate_report": (duplicate_report, f"WITH RECURSIVE {_LINKS} SELECT r.slug, canonical_slug, concat_ws('+', CASE WHEN h = 1 THEN 'domain' END, CASE WHEN s IS NOT NULL THEN 'embedding' END) AS reason, round(s, 4) AS score FROM ranked r JOIN why USING (slug)"),
    "export_records": (export_records, f"""WITH {_PAGES}, {_RICH}, j AS (SELECT e.*, r.name, r.vendor, r.website_url, r.source_url, r.status, CASE WHEN coalesce(r.name, '') = '' THEN r.slug ELSE r.name END AS shown,
  coalesce(nullif(coalesce(e.short_desc, ''), ''), nullif(coalesce(e.description_md, ''), ''), nullif(coalesce(r.name, ''), ''), '') AS src FROM pages r JOIN rich e ON r.slug = e.slug)
SELECT slug, coalesce(name, '') AS name, coalesce(vendor, '') AS vendor, coalesce(website_url, '') AS website_url, coalesce(source_url, '') AS source_url, lower(trim(coalesce(pricing, 'unknown'))) AS pricing,
  coalesce(pricing_note, '') AS pricing_note, coalesce(short_desc, '') AS short_desc, coalesce(description_md, '') AS description_md, coalesce(application_category, '') AS application_category,
  CASE WHEN quality_score IS NOT NULL THEN {_TEN.format('quality_score')} END AS quality_score, coalesce(nullif(status, ''), 'draft') AS status,
  CASE WHEN trim(coalesce(seo_title, ''), ' ') <> '' THEN seo_title ELSE left(regexp_replace(CASE WHEN coalesce(short_desc, '') = '' THEN shown ELSE shown || ' — ' || short_desc END, '^[ —]+|[ —]+$', '', 'g'), 60) END AS seo_title,
  CASE WHEN trim(coalesce(seo_description, ''), ' ') <> '' THEN seo_description ELSE left({_CLEAN.format('src')}, 155) END AS seo_description,
  CAST(to_json({_JSON.format('pros_json')}) AS VARCHAR) AS pros_jsonb, CAST(to_json({_JSON.format('cons_json')}) AS VARCHAR) AS cons_jsonb,
  sha256(CAST(to_json(coalesce(TRY_CAST(TRY_CAST(faq_json AS JSON) AS STRUCT(q VARCHAR, a VARCHAR)[]), [])) AS VARCHAR)) AS faq_hash, '[]' AS categories, '' AS primary_category, '{{}}' AS facets, '[]' AS tags FROM j"""),
    "lookup_misses": (lookup_misses, """
WITH t AS (SELECT DISTINCT slug FROM tools WHERE slug IS NOT NULL), k AS (SELECT DISTINCT page_key FROM page_seo WHERE page_key LIKE '%-vs-%'), s AS (SELECT page_key, unnest(string_split(page_key, '-vs-')) AS slug FROM k),
g AS (SELECT page_key, count(*) FILTER (slug NOT IN (SELECT slug FROM raw_tools WHERE slug IS NOT NULL)) AS gone FROM s GROUP BY 1)
SELECT 'vector' AS lookup, count(*) FILTER (slug IN (SELECT slug FROM tool_embeddings WHERE slug IS NOT NULL)) AS found, count(*) FILTER (slug NOT IN (SELECT slug FROM tool_embeddings WHERE slug IS NOT NULL)) AS missed FROM t
UNION ALL SELECT 'both sides', count(*) FILTER (gone = 0), count(*) FILTER (gone > 0) FROM g"""),
    "localized_texts": (localized_texts, """
WITH r AS (SELECT tool_slug AS slug, lang, doc_id, text FROM documents WHERE tool_slug IS NOT NULL AND trim(text, ' ') <> ''), o AS (SELECT slug, arg_min(text, doc_id) FILTER (lang = 'fr') AS own, arg_min(text, doc_id) FILTER (lang = 'en') AS english FROM r GROUP BY 1)
SELECT slug, CASE WHEN own IS NOT NULL THEN 'fr' ELSE 'en' END AS shown_in, sha256(coalesce(own, english)) AS text_hash FROM o WHERE own IS NOT NULL OR english IS NOT NULL"""),
    "to_translate": (to_translate, "SELECT DISTINCT tool_slug AS slug FROM documents WHERE lang = 'en' AND tool_slug IS NOT NULL AND tool_slug NOT IN (SELECT tool_slug FROM documents WHERE lang = 'fr' AND tool_slug IS NOT NULL)"),
    "delete_where": (delete_where, "SELECT DISTINCT id, slug, status FROM tools WHERE status IS DISTINCT FROM 'draft'"),
    "audit_log": (audit_log, """
WITH l AS (SELECT DISTINCT slug, 'match' AS action, detected_at AS "at" FROM dedup_map WHERE slug IS NOT NULL AND detected_at IS NOT NULL)
FROM l UNION ALL SELECT slug, 'review', (SELECT max("at") FROM l) FROM l GROUP BY slug HAVING count(*) > 2"""),
    "pair_update": (pair_update, f"""
WITH r AS (SELECT tool_id, alternative_id, max(reason) AS reason FROM alternatives WHERE tool_id IS NOT NULL AND alternative_id IS NOT NULL GROUP BY ALL)
SELECT a.tool_id, a.alternative_id, CASE WHEN {_CLEAN.format('a.reason')} = '' THEN b.reason ELSE a.reason END AS reason
FROM r a LEFT JOIN r b ON a.tool_id = b.alternative_id AND a.alternative_id = b.tool_id AND {_CLEAN.format('b.reason')} <> ''"""),
    "category_versions": (category_versions, f"""WITH {_PAGES} SELECT primary_category, count(*) AS tools,
sha256('v1|' || primary_category || '|' || count(*) || '|' || coalesce(sum(CAST('0x' || left(sha256(slug), 15) AS BIGINT)), 0)) AS content_hash FROM pages WHERE primary_category IS NOT NULL GROUP BY 1"""),
    "alias_resolved": (alias_resolved, """
WITH a AS (SELECT slug, min(canonical_slug) AS name FROM dedup_map WHERE slug <> canonical_slug GROUP BY 1), k AS (SELECT DISTINCT page_key FROM page_seo WHERE page_key LIKE '%-vs-%'),
s AS (SELECT page_key, unnest(string_split(page_key, '-vs-')) AS slug, generate_subscripts(string_split(page_key, '-vs-'), 1) - 1 AS side FROM k)
SELECT page_key, CAST(side AS INTEGER) AS side, coalesce(name, s.slug) AS slug FROM s LEFT JOIN a ON a.slug = s.slug"""),
    "enrich_delta": (enrich_delta, f"""WITH {_PAGES}, d AS (SELECT slug, max({_MOMENT.format('enriched_at')}) AS enriched FROM enriched_tools GROUP BY 1)
SELECT p.slug, CASE WHEN enriched IS NULL THEN 'new' ELSE 'stale' END AS why FROM pages p LEFT JOIN d USING (slug) WHERE {_CLEAN.format('raw_text')} <> '' AND (enriched IS NULL OR enriched < {_MOMENT.format('collected_at')})"""),
}
