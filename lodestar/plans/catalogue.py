"""Queries on the texts, scores, hashes and published form of the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import text as X
from lodestar.functions import values as V
from lodestar.operators.delta import changed, content_hash, latest, override_union
from lodestar.runtime import table


def _pages(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """The named columns of the last collected page of each slug; copies need no removal, as one row a slug is kept."""
    order = ["collected_at", "source_hash", "raw_title"]
    rows = table(spark, root, "raw_tools").select(*dict.fromkeys(["slug", *order, *columns]))
    return latest(rows, ["slug"], *map(F.desc_nulls_last, order)).select("slug", *columns)


def _enriched(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """The named columns of the last enrichment of each slug."""
    order = ["enriched_at", "content_hash", "short_desc"]
    rows = table(spark, root, "enriched_tools").select(*dict.fromkeys(["slug", *order, *columns]))
    return latest(rows, ["slug"], *map(F.desc_nulls_last, order)).select("slug", *columns)


def page_hashes(spark: SparkSession, root: str) -> DataFrame:
    """Hash of what a page is enriched from; copies drop out by their hash, so no text is shuffled."""
    digest = content_hash(F.col("name"), F.col("raw_title"), F.col("raw_meta_desc"), F.col("raw_text"))
    return table(spark, root, "raw_tools").select("slug", "collected_at", digest.alias("content_hash")).distinct()


def delta_changed(spark: SparkSession, root: str) -> DataFrame:
    """Slugs whose last page has another content than their first one."""
    digest = content_hash(F.col("name"), F.col("raw_title"), F.col("raw_meta_desc"), F.col("raw_text"))
    hashed = table(spark, root, "raw_tools").select("slug", "collected_at", digest.alias("content_hash"))
    last = latest(hashed, ["slug"], F.desc("collected_at"), F.desc("content_hash"))
    first = latest(hashed, ["slug"], F.asc("collected_at"), F.asc("content_hash"))
    return changed(last, first, "slug", "content_hash").select("slug", "collected_at", "content_hash")


def html_extract(spark: SparkSession, root: str) -> DataFrame:
    """Title, description and text by patterns, from pages put together from their parts."""
    part = lambda c: F.coalesce(F.regexp_replace(c, "[<>\"]", ""), F.lit(""))
    html = F.concat(F.lit("<html><head><TITLE lang='en'>"), part("raw_title"), F.lit("</TITLE><meta content=\""), part("raw_meta_desc"), F.lit("\" name=\"description\"></head><body><p>"), part("raw_text"), F.lit("</p></body></html>"))
    rows = table(spark, root, "raw_tools").select("slug", "collected_at", html.alias("html"))
    text = X.clean(F.regexp_replace("html", "(?s)<[^>]+>", " "))
    return rows.select(
        "slug", "collected_at", X.html_title(F.col("html")).alias("title"), X.html_description(F.col("html")).alias("description"),
        F.length(X.html_text(F.col("html"))).alias("text_length"), F.length(text).alias("whole_length"), F.sha2(text, 256).alias("text_hash"),
    ).distinct()


def html_dom(spark: SparkSession, root: str) -> DataFrame:
    """Hash of the visible text of pages put together from their parts: scripts and site frames are left out."""
    part = lambda c: F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "[<>&]", "")), r"(?U)^\s+|\s+$", "")
    html = F.concat(
        F.lit("<html><head><style>p > a { color: red }</style></head><body><header><nav>Home<ul><li>Docs</li></ul></nav> Top</header><script>if (1 < 2) x = '</p>';</script><div><p class='a>b'>"),
        part("raw_text"), F.lit(" &amp;&nbsp;more<br></div><footer><nav>Terms</nav>"), F.coalesce("vendor", F.lit("")), F.lit("</footer></body>"),
    )
    rows = table(spark, root, "raw_tools").select("slug", "collected_at", X.html_dom_text(html, None).alias("text"))
    return rows.select("slug", "collected_at", F.length("text").alias("text_length"), F.sha2("text", 256).alias("text_hash")).distinct()


def thin_content(spark: SparkSession, root: str) -> DataFrame:
    """Intros with fewer than 200 characters on one line, and all of them cut to 1,600."""
    body = X.clean(F.col("intro_md"))
    return table(spark, root, "page_seo").select("id", (F.length(body) < 200).alias("thin"), F.sha2(X.cut(body, 1600, trimmed=True), 256).alias("cut_hash")).distinct()


def seo_fallback(spark: SparkSession, root: str) -> DataFrame:
    """Titles and descriptions, made from other fields where they are missing."""
    rows = _enriched(spark, root, "seo_title", "seo_description", "short_desc").join(_pages(spark, root, "name"), "slug")
    return rows.select(
        "slug", X.title_or(F.col("seo_title"), F.col("name"), F.col("short_desc"), F.col("slug")).alias("title"), X.description_or(F.col("seo_description"), F.col("short_desc"), F.col("name")).alias("description")
    )


def score_normalize(spark: SparkSession, root: str) -> DataFrame:
    """Scores on one scale, with a default and without."""
    rows = table(spark, root, "enriched_tools").select("slug", "enriched_at", "quality_score").distinct()
    return rows.select("slug", "enriched_at", V.score_or_default(F.col("quality_score")).alias("score"), V.score_or_null(F.col("quality_score")).alias("score_or_null"), V.share(F.col("quality_score")).alias("share"))


def slug_labels(spark: SparkSession, root: str) -> DataFrame:
    """Slugs and labels of part types and names."""
    rows = table(spark, root, "part").select("p_partkey", X.slugify(F.concat_ws(" ", "p_type", "p_name"), plain=True).alias("slug"))
    return rows.select("p_partkey", "slug", X.pretty_label(F.col("slug")).alias("label"))


def compare_keys(spark: SparkSession, root: str) -> DataFrame:
    """Keys and symmetric hashes of the pairs that are alternatives of each other, both known."""
    tools = latest(table(spark, root, "tools"), ["id"], F.desc_nulls_last("updated_at"), F.desc("slug")).select("id", "slug", X.fingerprint(F.col("slug"), F.col("name"), F.col("pricing")).alias("fp"))
    pairs = table(spark, root, "alternatives").where("tool_id <> alternative_id").select(F.least("tool_id", "alternative_id").alias("x"), F.greatest("tool_id", "alternative_id").alias("y")).distinct()
    a, b = (tools.select(F.col("id").alias(k), F.col("slug").alias(k + "_slug"), F.col("fp").alias(k + "_fp")) for k in "xy")
    rows = pairs.join(a, "x").join(b, "y")
    ahead = F.col("x_slug") <= F.col("y_slug")
    ordered = F.concat(F.lit("v1|compare|"), F.when(ahead, F.col("x_fp")).otherwise(F.col("y_fp")), F.lit("||"), F.when(ahead, F.col("y_fp")).otherwise(F.col("x_fp")))
    return rows.select(X.pair_key(F.col("x_slug"), F.col("y_slug")).alias("page_key"), F.sha2(ordered, 256).alias("content_hash")).distinct()


def ranked_alternatives(spark: SparkSession, root: str) -> DataFrame:
    """Of each tool its ten best alternatives in order, and a hash of which they are that does not change with their order; null similarity counts as 0."""
    best = table(spark, root, "alternatives").dropna(subset=["tool_id", "alternative_id"]).groupBy("tool_id", "alternative_id").agg(F.max(F.coalesce("similarity", F.lit(0).cast("decimal(4,3)"))).alias("s"))
    ranked = latest_n(best, "tool_id", 10, F.desc("s"), F.asc("alternative_id"))
    lists = ranked.groupBy("tool_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "alternative_id"))), lambda x: x["alternative_id"].cast("string")), "|").alias("alternatives"))
    members = F.array_join(F.array_sort(F.split("alternatives", r"\|")), "|")
    return lists.select("tool_id", "alternatives", F.sha2(F.concat(F.lit("v1|alternatives|"), F.col("tool_id").cast("string"), F.lit("||"), members), 256).alias("content_hash"))


def latest_n(rows: DataFrame, key: str, n: int, *order) -> DataFrame:
    """The first ``n`` rows of each key with their rank; Spark limits groups before it shuffles them."""
    from pyspark.sql.window import Window as W

    return rows.withColumn("rank", F.row_number().over(W.partitionBy(key).orderBy(*order))).where(F.col("rank") <= n)


def export_entries(spark: SparkSession, root: str) -> DataFrame:
    """Published form of the pages that are enriched, with fallbacks, one row a slug."""
    raw, rich = _pages(spark, root, "name", "vendor", "status").alias("r"), _enriched(spark, root, "pricing", "quality_score", "pros_json", "cons_json").alias("e")
    rows = raw.join(rich, F.col("r.slug") == F.col("e.slug"))
    items = lambda c: F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))
    return rows.select(
        F.col("r.slug").alias("slug"), F.coalesce("r.name", "r.slug").alias("name"), F.coalesce(F.nullif("r.vendor", F.lit("")), F.lit("")).alias("vendor"),
        F.lower(F.trim(F.coalesce("e.pricing", F.lit("unknown")))).alias("pricing"), V.score_or_null(F.col("e.quality_score")).alias("quality_score"),
        F.array_join(items("e.pros_json"), "|").alias("pros"), F.array_join(items("e.cons_json"), "|").alias("cons"), F.coalesce(F.lower(F.trim("r.status")), F.lit("draft")).alias("status"),
    )


def export_override(spark: SparkSession, root: str) -> DataFrame:
    """Names by slug from three tables; the later table wins."""
    one = table(spark, root, "tools").groupBy("slug").agg(F.max("name").alias("name")).withColumn("origin", F.lit("tools"))
    two = table(spark, root, "raw_tools").groupBy("slug").agg(F.max("name").alias("name")).withColumn("origin", F.lit("raw_tools"))
    three = table(spark, root, "dedup_map").where("slug IS NOT NULL").select("slug", F.concat(F.lit("dup of "), F.coalesce("canonical_slug", F.lit("?"))).alias("name")).groupBy("slug").agg(F.min("name").alias("name")).withColumn("origin", F.lit("dedup_map"))
    return override_union([one, two, three], "slug")


def enriched_left(spark: SparkSession, root: str) -> DataFrame:
    """Every enriched tool with its page, or nothing where there is none, and its number of categories."""
    pages = _pages(spark, root, "primary_category", "categories_json").select("slug", "primary_category", F.size(F.coalesce(F.from_json("categories_json", "array<string>"), F.array().cast("array<string>"))).alias("n_categories"))
    return _enriched(spark, root, "application_category").join(pages, "slug", "left").select("slug", "application_category", "primary_category", F.coalesce("n_categories", F.lit(0)).alias("n_categories"))


def category_edges(spark: SparkSession, root: str) -> DataFrame:
    """Edges of tools and categories from JSON lists, in the order of the list."""
    rows = _pages(spark, root, "primary_category", "categories_json").select("slug", "primary_category", F.posexplode(F.from_json("categories_json", "array<string>")).alias("place", "category"))
    return rows.select("slug", "category", F.col("place").cast("int").alias("place"), (F.col("category") == F.col("primary_category")).alias("is_primary"))


def vocabulary_check(spark: SparkSession, root: str) -> DataFrame:
    """Categories of a page that are among those used as a primary one at least ten times: known ones, each once, two at most."""
    pages = _pages(spark, root, "primary_category", "categories_json")
    known = pages.where("primary_category IS NOT NULL").groupBy(F.col("primary_category").alias("category")).count().where("count >= 10").select("category")
    named = pages.select("slug", F.posexplode(F.from_json("categories_json", "array<string>")).alias("place", "category")).join(known, "category", "left_semi")
    firsts = latest_n(named.groupBy("slug", "category").agg(F.min("place").alias("place")), "slug", 2, F.asc("place"))
    lists = firsts.groupBy("slug").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "category"))), lambda x: x["category"]), "|").alias("categories"))
    return pages.select("slug").join(lists, "slug", "left").select("slug", F.coalesce("categories", F.lit("")).alias("categories"))


def embed_text(spark: SparkSession, root: str) -> DataFrame:
    """Texts that go to models: parts that are there, parts that always stand, and a request with a list."""
    rows = _enriched(spark, root, "short_desc", "description_md", "pros_json").join(_pages(spark, root, "name"), "slug")
    always = F.concat(F.coalesce("name", F.lit("")), F.lit(". "), F.coalesce("short_desc", F.lit("")), F.lit(". "), F.coalesce("description_md", F.lit("")))
    prompt = F.concat(F.lit("Tool: "), F.coalesce("name", F.lit("")), F.lit("\nPros:\n"), F.array_join(F.transform(F.coalesce(F.from_json("pros_json", "array<string>"), F.array().cast("array<string>")), lambda x: F.concat(F.lit("- "), x)), "\n"))
    return rows.select("slug", F.sha2(X.cut(X.joined(F.col("name"), F.col("short_desc"), F.col("description_md")), 8000), 256).alias("search_hash"), F.sha2(X.cut(always, 6000), 256).alias("embed_hash"), F.sha2(prompt, 256).alias("prompt_hash"))


def health_sections(spark: SparkSession, root: str) -> DataFrame:
    """What is wrong with each tool, by section: missing fields, score out of range, stale, no vector, no category, no primary one."""
    rich = _enriched(spark, root, "seo_title", "seo_description", "description_md", "quality_score")
    missing = V.missing_names(seo_title=F.col("seo_title"), seo_description=F.col("seo_description"), description_md=F.col("description_md"))
    fields = rich.select("slug", F.lit("missing").alias("section"), missing.alias("detail")).where("detail <> ''")
    score = rich.where("quality_score IS NULL OR quality_score < 0 OR quality_score > 10").select("slug", F.lit("score").alias("section"), F.lit("").alias("detail"))
    tools = table(spark, root, "tools").select("id", "slug", "updated_at").distinct()
    now = tools.agg(F.max("updated_at").alias("now"))
    stale = tools.join(F.broadcast(now), F.lit(True)).where(V.older_than(F.col("updated_at"), F.col("now"), 30)).select("slug", F.lit("stale").alias("section"), F.date_format("updated_at", "yyyy-MM-dd").alias("detail"))  # one row
    known = table(spark, root, "tool_embeddings").select("slug").distinct()
    bare = rich.select("slug").distinct().join(known, "slug", "left_anti").select("slug", F.lit("no vector").alias("section"), F.lit("").alias("detail"))
    pages = _pages(spark, root, "primary_category", "categories_json")
    some = F.coalesce(F.size(F.from_json("categories_json", "array<string>")), F.lit(0)) > 0
    places = pages.select("slug", F.when(~some, "no category").when(X.blank(F.col("primary_category")), "no primary").alias("section"), F.lit("").alias("detail")).where("section IS NOT NULL")
    return fields.unionByName(score).unionByName(stale).unionByName(bare).unionByName(places)


def health_totals(spark: SparkSession, root: str) -> DataFrame:
    return health_sections(spark, root).groupBy("section").agg(F.count("*").alias("problems"))


def changed_paths(spark: SparkSession, root: str) -> DataFrame:
    """Paths of pages to refresh, in two languages, each once."""
    slugs = table(spark, root, "tools").where("status = 'published'").select("slug").dropna()
    return slugs.select(F.explode(F.array(F.concat(F.lit("/tools/"), "slug"), F.concat(F.lit("/fr/tools/"), "slug"))).alias("path")).distinct().where("path LIKE '/%'")


_PAGES = """pages AS (SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY collected_at DESC NULLS LAST, source_hash DESC NULLS LAST, raw_title DESC NULLS LAST) AS n FROM (SELECT DISTINCT * FROM raw_tools)) WHERE n = 1)"""
_RICH = """rich AS (SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY enriched_at DESC NULLS LAST, content_hash DESC NULLS LAST, short_desc DESC NULLS LAST) AS n FROM (SELECT DISTINCT * FROM enriched_tools)) WHERE n = 1)"""
_HASHED = "hashed AS (SELECT slug, collected_at, sha256(coalesce(name, '') || coalesce(raw_title, '') || coalesce(raw_meta_desc, '') || coalesce(raw_text, '')) AS content_hash FROM (SELECT DISTINCT * FROM raw_tools))"
_CLEAN = r"trim(regexp_replace(coalesce({0}, ''), '[\s\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}]+', ' ', 'g'))"
_TEN = "round(greatest(0.0, least(10.0, CASE WHEN {0} > 10 THEN {0} / 10 ELSE {0} END)), 1)"
_JSON = "coalesce(TRY_CAST(TRY_CAST({0} AS JSON) AS VARCHAR[]), [])"
ENTRIES = {
    "page_hashes": (page_hashes, f"WITH {_HASHED} SELECT * FROM hashed"),
    "delta_changed": (delta_changed, f"""WITH {_HASHED},
l AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY collected_at DESC NULLS LAST, content_hash DESC) AS n FROM hashed),
f AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY collected_at ASC NULLS FIRST, content_hash) AS n FROM hashed)
SELECT l.slug, l.collected_at, l.content_hash FROM l JOIN f ON l.slug = f.slug WHERE l.n = 1 AND f.n = 1 AND l.content_hash <> f.content_hash"""),
    "html_extract": (html_extract, f"""
WITH p AS (SELECT DISTINCT * FROM raw_tools), q AS (SELECT slug, collected_at, regexp_replace(coalesce(raw_title, ''), '[<>"]', '', 'g') AS t, regexp_replace(coalesce(raw_meta_desc, ''), '[<>"]', '', 'g') AS d, regexp_replace(coalesce(raw_text, ''), '[<>"]', '', 'g') AS x FROM p)
SELECT slug, collected_at, trim(t) AS title, d AS description, CAST(length(left(y, 2000)) AS INTEGER) AS text_length, CAST(length(y) AS INTEGER) AS whole_length, sha256(y) AS text_hash
FROM (SELECT *, {_CLEAN.format("t || '  ' || x")} AS y FROM q)"""),
    "html_dom": (html_dom, None),
    "thin_content": (thin_content, f"SELECT id, length(b) < 200 AS thin, sha256(rtrim(left(b, 1600))) AS cut_hash FROM (SELECT id, {_CLEAN.format('intro_md')} AS b FROM (SELECT DISTINCT * FROM page_seo))"),
    "seo_fallback": (seo_fallback, f"""WITH {_PAGES}, {_RICH}, r AS (SELECT rich.*, pages.name FROM rich JOIN pages USING (slug)),
c AS (SELECT *, {_CLEAN.format('seo_title')} AS ct, {_CLEAN.format('name')} AS cn, {_CLEAN.format('short_desc')} AS cd, {_CLEAN.format('seo_description')} AS cs FROM r)
SELECT slug, left(CASE WHEN ct <> '' THEN seo_title WHEN cn = '' AND cd = '' THEN slug ELSE regexp_replace(cn || ' — ' || cd, '^[ —]+|[ —]+$', '', 'g') END, 60) AS title,
       left(coalesce(nullif(cs, ''), nullif(cd, ''), nullif(cn, '')), 155) AS description FROM c"""),
    "score_normalize": (score_normalize, f"""
SELECT slug, enriched_at, {_TEN.format('coalesce(quality_score, 5.0)')} AS score, CASE WHEN quality_score IS NOT NULL THEN {_TEN.format('quality_score')} END AS score_or_null,
       greatest(0.0, least(1.0, coalesce(quality_score, 0.0))) AS share FROM (SELECT DISTINCT * FROM enriched_tools)"""),
    "slug_labels": (slug_labels, """
WITH s AS (SELECT p_partkey, left(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(p_type || ' ' || p_name), '[\\s_]+', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g'), 40) AS slug FROM part)
SELECT p_partkey, slug, array_to_string(list_transform(list_filter(string_split(replace(slug, '-', ' '), ' '), lambda w: w <> ''),
  lambda w: CASE WHEN w IN ('ai','api','llm','ui','ux','seo','sql','gpt','ocr','3d','ml','nlp','sdk','crm','saas','b2b','b2c','ide','cli','tts','stt','pdf','csv','html','css','js','ar','vr','kpi','etl','rag') THEN upper(w) ELSE upper(left(w, 1)) || w[2:] END), ' ') AS label FROM s"""),
    "compare_keys": (compare_keys, """
WITH t AS (SELECT id, slug, coalesce(slug, '') || '~' || coalesce(name, '') || '~' || coalesce(pricing, '') AS fp FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, slug DESC) AS n FROM (SELECT DISTINCT * FROM tools)) WHERE n = 1),
p AS (SELECT DISTINCT least(tool_id, alternative_id) AS x, greatest(tool_id, alternative_id) AS y FROM alternatives WHERE tool_id <> alternative_id)
SELECT DISTINCT least(a.slug, b.slug) || '-vs-' || greatest(a.slug, b.slug) AS page_key, sha256('v1|compare|' || CASE WHEN a.slug <= b.slug THEN a.fp || '||' || b.fp ELSE b.fp || '||' || a.fp END) AS content_hash
FROM p JOIN t a ON a.id = x JOIN t b ON b.id = y"""),
    "ranked_alternatives": (ranked_alternatives, """
WITH b AS (SELECT tool_id, alternative_id, max(coalesce(similarity, 0)) AS s FROM alternatives WHERE tool_id IS NOT NULL AND alternative_id IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY tool_id ORDER BY s DESC, alternative_id) AS n FROM b), l AS (SELECT tool_id, string_agg(CAST(alternative_id AS VARCHAR), '|' ORDER BY n) AS alternatives FROM r WHERE n <= 10 GROUP BY tool_id)
SELECT tool_id, alternatives, sha256('v1|alternatives|' || tool_id || '||' || array_to_string(list_sort(string_split(alternatives, '|')), '|')) AS content_hash FROM l"""),
    "export_entries": (export_entries, f"""WITH {_PAGES}, {_RICH}
SELECT r.slug, coalesce(r.name, r.slug) AS name, coalesce(r.vendor, '') AS vendor, lower(trim(coalesce(e.pricing, 'unknown'))) AS pricing, CASE WHEN e.quality_score IS NOT NULL THEN {_TEN.format('e.quality_score')} END AS quality_score,
       array_to_string({_JSON.format('e.pros_json')}, '|') AS pros, array_to_string({_JSON.format('e.cons_json')}, '|') AS cons, coalesce(lower(trim(r.status)), 'draft') AS status FROM pages r JOIN rich e ON r.slug = e.slug"""),
    "export_override": (export_override, """
WITH u AS (SELECT slug, max(name) AS name, 'tools' AS origin, 0 AS p FROM tools GROUP BY slug UNION ALL SELECT slug, max(name), 'raw_tools', 1 FROM raw_tools GROUP BY slug
UNION ALL SELECT slug, min('dup of ' || coalesce(canonical_slug, '?')), 'dedup_map', 2 FROM dedup_map WHERE slug IS NOT NULL GROUP BY slug)
SELECT slug, name, origin FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY p DESC) AS n FROM u) WHERE n = 1"""),
    "enriched_left": (enriched_left, f"""WITH {_PAGES}, {_RICH} SELECT e.slug, application_category, primary_category, CAST(coalesce(len({_JSON.format('categories_json')}), 0) AS INTEGER) AS n_categories FROM rich e LEFT JOIN pages p ON e.slug = p.slug"""),
    "category_edges": (category_edges, f"""WITH {_PAGES}, x AS (SELECT slug, primary_category, unnest({_JSON.format('categories_json')}) AS category, generate_subscripts({_JSON.format('categories_json')}, 1) - 1 AS place FROM pages)
SELECT slug, category, CAST(place AS INTEGER) AS place, category = primary_category AS is_primary FROM x"""),
    "vocabulary_check": (vocabulary_check, f"""WITH {_PAGES}, known AS (SELECT primary_category AS c FROM pages WHERE primary_category IS NOT NULL GROUP BY 1 HAVING count(*) >= 10),
x AS (SELECT slug, unnest({_JSON.format('categories_json')}) AS category, generate_subscripts({_JSON.format('categories_json')}, 1) AS place FROM pages),
y AS (SELECT slug, category, min(place) AS place FROM x WHERE category IN (FROM known) GROUP BY ALL), z AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY place) AS n FROM y),
l AS (SELECT slug, string_agg(category, '|' ORDER BY place) AS categories FROM z WHERE n <= 2 GROUP BY slug)
SELECT p.slug, coalesce(categories, '') AS categories FROM pages p LEFT JOIN l ON p.slug = l.slug"""),
    "embed_text": (embed_text, f"""WITH {_PAGES}, {_RICH}, r AS (SELECT rich.*, pages.name FROM rich JOIN pages USING (slug))
SELECT slug, sha256(left(concat_ws('. ', nullif(name, ''), nullif(short_desc, ''), nullif(description_md, '')), 8000)) AS search_hash,
       sha256(left(coalesce(name, '') || '. ' || coalesce(short_desc, '') || '. ' || coalesce(description_md, ''), 6000)) AS embed_hash,
       sha256('Tool: ' || coalesce(name, '') || chr(10) || 'Pros:' || chr(10) || array_to_string(list_transform({_JSON.format('pros_json')}, lambda x: '- ' || x), chr(10))) AS prompt_hash FROM r"""),
    "health_sections": (health_sections, None),
    "health_totals": (health_totals, None),
    "changed_paths": (changed_paths, """SELECT DISTINCT path FROM (SELECT unnest(['/tools/' || slug, '/fr/tools/' || slug]) AS path FROM tools WHERE status = 'published' AND slug IS NOT NULL)"""),
}
_HEALTH = f"""WITH {_RICH}, {_PAGES}, t AS (SELECT DISTINCT * FROM tools), found AS (
  SELECT slug, 'missing' AS section, concat_ws(', ', CASE WHEN trim(coalesce(seo_title, '')) = '' THEN 'seo_title' END, CASE WHEN trim(coalesce(seo_description, '')) = '' THEN 'seo_description' END, CASE WHEN trim(coalesce(description_md, '')) = '' THEN 'description_md' END) AS detail FROM rich
  UNION ALL SELECT slug, 'score', '' FROM rich WHERE quality_score IS NULL OR quality_score < 0 OR quality_score > 10
  UNION ALL SELECT slug, 'stale', strftime(updated_at AT TIME ZONE 'UTC', '%Y-%m-%d') FROM t WHERE updated_at < (SELECT max(updated_at) FROM t) - INTERVAL 30 DAYS
  UNION ALL SELECT slug, CASE WHEN len({_JSON.format('categories_json')}) = 0 THEN 'no category' ELSE 'no primary' END, '' FROM pages WHERE len({_JSON.format('categories_json')}) = 0 OR {_CLEAN.format('primary_category')} = ''
  UNION ALL SELECT slug, 'no vector', '' FROM rich WHERE slug NOT IN (SELECT slug FROM tool_embeddings WHERE slug IS NOT NULL))"""
ENTRIES["health_sections"] = (health_sections, _HEALTH + " SELECT * FROM found WHERE section <> 'missing' OR detail <> ''")
ENTRIES["health_totals"] = (health_totals, _HEALTH + " SELECT section, count(*) AS problems FROM found WHERE section <> 'missing' OR detail <> '' GROUP BY section")
ENTRIES["html_dom"] = (html_dom, r"""
SELECT slug, collected_at, CAST(length(t) AS INTEGER) AS text_length, sha256(t) AS text_hash
FROM (SELECT slug, collected_at, ltrim(x || ' &' || chr(160) || 'more') AS t FROM (SELECT slug, collected_at, regexp_replace(trim(regexp_replace(coalesce(raw_text, ''), '[<>&]', '', 'g')), '^[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+|[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+$', '', 'g') AS x FROM (SELECT DISTINCT * FROM raw_tools)))""")
