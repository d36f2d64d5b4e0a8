"""Problem 6: values that a field limit or a broken transfer cut off, and how often each source cuts.

Method: the length of every value is recomputed under other encodings (UTF-8 bytes, UTF-16 units), with entities escaped,
with JSON escapes and with other line ends; grouped by field, source and measure, lengths at which values pile up with
nothing beyond them expose storage limits. A value at a limit without an end of its own, or with a
dot that may stand inside a sentence, is cut. Then the endings of all are inspected: a mark of a cut, a broken character, a last
sentence without its end, or a single phrase whose last word is the start of another word, never ends a sentence elsewhere,
or which starts as sentences do. All of it is built of Spark expressions and aggregates over all values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.runtime import cut_lineage, table

STOP = ".!?。！？؟।"
CLOSE = "\"'”’»)\\]」』）"
#: A length is a limit if at least so many values have it, and it is so many times as frequent as lengths near it.
LIMIT_VALUES, LIMIT_PEAK, NEAR = 4, 3, 12
#: A word ends sentences if at least this share of its uses does; list items may end in any known word.
RARE_END = 0.02
#: Characters at the end of a value in which its ending is looked for; all patterns but runs of closing marks are shorter.
TAIL = 64
# Abbreviations that want something after them, and words that may stand before dots without a cut.
WANTS_MORE = r"(?i)(?:^|[\s(])(?:e\.g|i\.e|vs|cf|approx|no|dr|mr|mrs|ms|prof|sr|sra|dra|st|mme|p\. ?ex|p\. ?ej|z\. ?b|d\. ?h|u\. ?a|nr|bzw|ca|art|pág|fig|jan|feb)\.$"
OPEN_END = r"(?i)(?:and (?:much |many )?more|and so on|and so forth|et (?:bien )?plus encore|et cetera|y (?:mucho )?más|und (?:vieles |so )?(?:mehr|weiter)|など|等等)(?:\.{3}|…)[\"”»]?$"


def measures(text: Column) -> dict[str, Column]:
    """The lengths of a value under the encodings and escapings a store may count in."""
    # One pass leaves the characters that any escaping changes; they are few, and each kind is counted among them.
    special = F.regexp_replace(text, "[^&<>\"\\\\\\n\\t\\r]+", "")
    extra = lambda kind, by: F.length(F.regexp_replace(special, f"[^{kind}]+", "")) * F.lit(by)
    points, bytes_, units = F.length(text), F.octet_length(text), (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")
    escapes = extra("\"\\\\\\n\\t\\r", 1)
    beyond = F.octet_length(F.encode(F.regexp_replace(text, "[\\x00-\\x7f]+", ""), "UTF-16BE")) / 2
    return {
        "code_points": points,
        "utf8_bytes": bytes_,
        "utf16_units": units,
        "html_escaped": points + extra("&", 4) + extra("<>", 3) + extra("\"", 5),
        "json_escaped": points + escapes,
        "json_ascii": (units + escapes + beyond * 5).cast("int"),
        "crlf": points + extra("\\n", 1),
    }


def hidden_limits(values: DataFrame) -> DataFrame:
    """(field, site, measure, limit, at_limit): lengths at which the values of a field pile up with none longer.

    ``values`` has field, site and lengths (a map by measure). Limits are looked for in each source and, with a null site, in
    each whole field.
    """
    lengths = values.select("field", "site", F.explode("lengths").alias("measure", "length"))
    counted = lengths.groupBy("field", "site", "measure", "length").agg(F.count("*").alias("n"))
    counted = counted.select("field", "measure", "length", "n", F.explode(F.array(F.col("site"), F.lit(None))).alias("site"))
    counted = counted.groupBy("field", "site", "measure", "length").agg(F.sum("n").alias("n"))
    # One row for each length that occurs: at most the field's limit, so the struct of a source stays small.
    shape = counted.groupBy("field", "site", "measure").agg(F.max(F.struct("length", "n")).alias("top"), F.collect_list(F.struct("length", "n")).alias("all"))
    near = F.aggregate("all", F.lit(0).cast("long"), lambda s, x: s + F.when((x["length"] < F.col("top.length")) & (x["length"] >= F.col("top.length") - NEAR), x["n"]).otherwise(0))
    return shape.where((F.col("top.n") >= LIMIT_VALUES) & (F.col("top.n") * NEAR >= near * LIMIT_PEAK)).select(
        "field", "site", "measure", F.col("top.length").alias("limit"), F.col("top.n").alias("at_limit")
    )


def with_lengths(values: DataFrame) -> DataFrame:
    """Adds lengths: the length of text by measure."""
    return values.withColumn("lengths", F.map_from_arrays(*_arrays(measures(F.col("text")))))


def _arrays(columns: dict[str, Column]) -> tuple[Column, Column]:
    return F.array(*[F.lit(name) for name in columns]), F.array(*columns.values())


def _word(token: Column) -> Column:
    """A token in lower case without the marks around it."""
    return F.lower(F.regexp_replace(token, "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", ""))


def _endings(values: DataFrame) -> DataFrame:
    """Adds what the ending of a value says: ``verdict`` (true, false or null for a single phrase) and the words to look up."""
    v = F.regexp_replace("text", "^[\\s\\u00a0\\ufeff]+|[\\s\\u00a0\\ufeff]+$", "")
    values = values.where(F.col("text").rlike("[^\\s\\u00a0\\ufeff]")).withColumn("v", v)  # not v <> '', which would trim twice
    v = F.col("v")
    last_part = F.regexp_replace(v, f"(?s)^.*(?:[.!?؟।…][{CLOSE}]*[\\s\\u00a0]|[。！？][{CLOSE}]*|\\n)[\\s\\u00a0]*", "")
    # Endings are read from a short tail, as a pattern with an end is tried at each character; where closing marks fill it, from the value.
    end = F.right(v, F.lit(TAIL))
    end = F.when(end.rlike(f"(?s)^.{{3}}[{CLOSE}\\x{{85}}\\x{{2028}}\\x{{2029}}]*$"), v).otherwise(end)
    values = values.withColumn("part", last_part).withColumn("tail", end)
    part, tail = F.col("part"), F.col("tail")
    dots = tail.rlike(f"(?:…|\\.{{3}}|\\[…\\])[{CLOSE}]*$")
    whole_part = (
        part.rlike(r"^(?:https?://|www\.)?[\w-]+(?:\.[\w-]+)+\.?[a-z]{2,}(?:/\S*)?$") & ~part.rlike(r"^www\.[\w-]+$")
        | part.rlike(r"^\([^()]*\)$") | part.rlike(r"\[[^\[\]]+\]\([^()\s]+\)$") | part.rlike("^[^\\p{L}\\p{N}]*$") | tail.rlike("[\\x{1F300}-\\x{1FAFF}\\x{2600}-\\x{27BF}]\\x{FE0F}?$")
    )
    listed = part.rlike(r"^(?:[-*•✓]|\d{1,2}[.)])\s")
    first_only = part == v
    verdict = (
        F.when(tail.rlike("\\x{FFFD}$"), True)
        .when(tail.rlike(OPEN_END), False)
        .when(dots, True)
        .when(tail.rlike(f"[{STOP}][{CLOSE}]*$"), tail.rlike(WANTS_MORE))
        .when(whole_part, False)
        .when(tail.rlike("[,;:(\\[-]$"), True)
        .when(listed | first_only, F.when(part.rlike("[\\x{3040}-\\x{30FF}\\x{3400}-\\x{9FFF}]$"), part.rlike("[はをが、，]")))
        .otherwise(True)
    )
    return values.select(
        "field", "row_key", "row_version", "site", "lengths", "v", verdict.alias("verdict"), listed.alias("listed"), tail.rlike(r"(?:\d|\b\p{L}|\b(?:approx|incl|excl|max|min|vol|ext|dept|est|resp|inkl|evtl))\.$").alias("dotted"),
        _word(F.regexp_replace(part, r"(?s)^.*\s", "")).alias("last_word"), F.regexp_extract(part, r"^(\S+\s+\S+)", 1).alias("opening"),
    )


def _vocabulary(values: DataFrame, open_words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(last_word, ends, goes_on), (last_word) that begin longer words, and (opening, sentences): counts over all values.

    Words are cut into beginnings no longer than the longest of ``open_words``, for which they are looked up.
    """
    sentences = values.select(F.explode(F.split("v", f"(?<=[.!?])[{CLOSE}]?\\s+")).alias("s"))
    at_end = lambda token: token.rlike(f"[{STOP}][{CLOSE}]*$")
    split = values.select(F.split("v", "\\s+").alias("all"))
    # The last word of a value counts only where a sentence ends there.
    used = F.when(at_end(F.element_at("all", -1)), F.col("all")).otherwise(F.slice("all", F.lit(1), F.size("all") - 1))
    # Equal tokens are counted before any is taken apart: there are many times fewer of them than tokens.
    tokens = split.select(F.explode(used).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    marked = tokens.select(_word(F.col("t")).alias("last_word"), at_end(F.col("t")).alias("at_end"), "n").where("last_word <> ''")
    uses = lambda kind: F.sum(F.when(kind, F.col("n")).otherwise(F.lit(0)))
    words = cut_lineage(marked.groupBy("last_word").agg(uses(F.col("at_end")).alias("ends"), uses(~F.col("at_end")).alias("goes_on")))
    longest = open_words.agg(F.coalesce(F.max(F.length("last_word")), F.lit(0)).alias("longest"))
    begun = words.where("length(last_word) > 1").join(F.broadcast(longest), F.lit(True)).where("longest > 0")  # one row
    starts = begun.select(F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("last_word") - 1, F.col("longest"))), lambda i: F.substring("last_word", F.lit(1), i))).alias("last_word"))
    finished = sentences.where(F.right("s", F.lit(4)).rlike(f"[.!?][{CLOSE}]?$"))
    openings = finished.select(F.regexp_extract("s", r"^(\S+\s+\S+)", 1).alias("opening")).where("opening <> ''").groupBy("opening").agg(F.count("*").alias("sentences"))
    return words, starts.distinct(), openings.where("sentences >= 2")


def cut_values(values: DataFrame) -> DataFrame:
    """(field, row_key, row_version, site, limit_measure): the values that stop inside a word or sentence because they were cut.

    ``values`` has field, row_key, row_version, site and text. Null and blank texts are no cases; repeated rows count once;
    a null site counts for the whole field only; other columns are not read. limit_measure names a measure under which the
    value has the length of a hidden limit, or is null. No rows give no rows.
    """
    values = values.select("field", "row_key", "row_version", "site", "text").where("text IS NOT NULL").distinct()
    ended = cut_lineage(_endings(with_lengths(values)))
    limits = hidden_limits(ended)
    of_field = limits.where("site IS NULL").groupBy("field").agg(F.map_from_entries(F.collect_list(F.struct("measure", "limit"))).alias("field_limits"))
    of_site = limits.where("site IS NOT NULL").groupBy("field", "site").agg(F.map_from_entries(F.collect_list(F.struct("measure", "limit"))).alias("site_limits"))
    open_words = ended.where("verdict IS NULL").select("last_word").distinct()
    words, starts, openings = _vocabulary(ended, open_words)
    facts = (
        open_words.join(words, "last_word", "left")
        .join(starts.join(open_words, "last_word", "left_semi").withColumn("begins_word", F.lit(True)), "last_word", "left")
        .select("last_word", F.coalesce("ends", F.lit(0)).alias("ends"), F.coalesce("goes_on", F.lit(0)).alias("goes_on"), F.coalesce("begins_word", F.lit(False)).alias("begins_word"))
    )
    told = (
        ended.drop("v").join(F.broadcast(of_field), "field", "left").join(of_site, ["field", "site"], "left")
    )  # one row for each of the few fields, so a broadcast
    hit = lambda limits_: F.filter(F.map_keys("lengths"), lambda m: F.coalesce(F.element_at("lengths", m) == F.try_element_at(F.col(limits_), m), F.lit(False)))
    told = told.withColumn("limit_measure", F.coalesce(F.get(hit("site_limits"), F.lit(0)), F.get(hit("field_limits"), F.lit(0))))
    # A length at its source's limit overrules a dot that may stand inside: after one letter, a number or an abbreviation.
    sure = told.where("verdict OR NOT verdict AND dotted AND limit_measure IS NOT NULL")
    phrases = told.where("verdict IS NULL").join(facts, "last_word", "left").join(openings, "opening", "left")
    inside = f"coalesce(ends, 0) < {RARE_END} * (coalesce(ends, 0) + coalesce(goes_on, 0)) AND NOT listed"
    broken_word = f"last_word <> '' AND ({inside} OR coalesce(ends + goes_on, 0) = 0 AND coalesce(begins_word, false))"
    as_sentence = "NOT listed AND sentences IS NOT NULL"
    unsure = phrases.where(f"({broken_word}) OR ({as_sentence}) OR limit_measure IS NOT NULL")
    columns = ["field", "row_key", "row_version", "site", "limit_measure"]
    return sure.select(*columns).unionByName(unsure.select(*columns))


def host(url: Column) -> Column:
    """Host of an address: lower case, without scheme, login, port and ``www.``; null where there is none."""
    bare = F.regexp_replace(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*:)?/*(?:[^/@]*@)?(?:www\.)?", "")
    return F.nullif(F.regexp_extract(bare, r"^([^/?#:\s]*)", 1), F.lit(""))


def sourced_values(spark: SparkSession, root: str) -> DataFrame:
    """The values of the three fields that are asked for, with the host of their tool."""
    sites = table(spark, root, "raw_tools").select("slug", host(F.col("website_url")).alias("site")).groupBy("slug").agg(F.min("site").alias("site"))
    tools = table(spark, root, "enriched_tools").select(
        "slug", F.coalesce("enriched_at", F.lit("")).alias("row_version"),
        F.explode(F.map_from_arrays(F.array(F.lit("seo_description"), F.lit("short_desc")), F.array("seo_description", "short_desc"))).alias("field", "text"),
    )
    tools = tools.select("slug", "field", F.col("slug").alias("row_key"), "row_version", "text")
    pages = table(spark, root, "page_seo").select(
        F.element_at(F.split("page_key", "-vs-"), 1).alias("slug"), F.lit("intro_md").alias("field"), F.col("id").cast("string").alias("row_key"), F.lit("").alias("row_version"), F.col("intro_md").alias("text")
    )
    values = tools.unionByName(pages).where("text IS NOT NULL").distinct()
    return values.join(sites, "slug", "left").drop("slug")


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return cut_values(sourced_values(spark, root)).select("field", "row_key", "row_version").distinct()


def p6_rates(spark: SparkSession, root: str) -> DataFrame:
    """Of each field and source: values, cut values and their share; a source without an address has a null site."""
    values = sourced_values(spark, root).where("trim(text) <> ''")
    total = values.groupBy("field", "site").agg(F.count("*").alias("n_values"))
    cut = cut_values(values).groupBy("field", "site").agg(F.count("*").alias("n_cut"))
    joined = total.alias("t").join(cut.alias("c"), (F.col("t.field") == F.col("c.field")) & F.col("t.site").eqNullSafe(F.col("c.site")), "left")
    n_cut = F.coalesce("c.n_cut", F.lit(0))
    return joined.select("t.field", "t.site", "n_values", n_cut.alias("n_cut"), F.round(n_cut / F.col("n_values"), 6).alias("share_cut"))


def p6_limits(spark: SparkSession, root: str) -> DataFrame:
    """The hidden limits of fields and sources, by measure."""
    return hidden_limits(with_lengths(sourced_values(spark, root).where("trim(text) <> ''")))


QUERIES = {"p6_found": p6_found, "p6_rates": p6_rates, "p6_limits": p6_limits}
_HOST = r"nullif(regexp_extract(regexp_replace(lower(trim(website_url)), '^(?:[a-z][a-z0-9+.-]*:)?/*(?:[^/@]*@)?(?:www\.)?', ''), '^([^/?#:\s]*)', 1), '')"
_CHARACTERS = {"amps": "&", "angles": "[<>]", "quotes": '"', "breaks": r"\n", "escapes": r'["\\\n\t\r]', "beyond": r"[^\x00-\x7f]", "far": r"[\x{10000}-\x{10FFFF}]"}
_COUNTS = ", ".join(f"length(text) - length(regexp_replace(text, '{pattern}', '', 'g')) AS {name}" for name, pattern in _CHARACTERS.items())
_MEASURES = {
    "code_points": "length(text)", "utf8_bytes": "strlen(text)", "utf16_units": "length(text) + far", "html_escaped": "length(text) + 4 * amps + 3 * angles + 5 * quotes",
    "json_escaped": "length(text) + escapes", "json_ascii": "length(text) + far + escapes + 5 * (beyond + far)", "crlf": "length(text) + breaks",
}
_EACH = " UNION ALL ".join(f"SELECT field, site, '{name}' AS measure, {length} AS length FROM c" for name, length in _MEASURES.items())
ORACLES = {
    "p6_limits": f"""
WITH s AS (SELECT slug, min({_HOST}) AS site FROM raw_tools GROUP BY slug),
v AS (SELECT slug, 'seo_description' AS field, slug AS row_key, coalesce(enriched_at, '') AS row_version, seo_description AS text FROM enriched_tools
  UNION SELECT slug, 'short_desc', slug, coalesce(enriched_at, ''), short_desc FROM enriched_tools UNION SELECT string_split(page_key, '-vs-')[1], 'intro_md', CAST(id AS VARCHAR), '', intro_md FROM page_seo),
c AS (SELECT field, site, text, {_COUNTS} FROM v LEFT JOIN s USING (slug) WHERE trim(text) <> ''),
l AS ({_EACH}), m AS (SELECT field, site, measure, length, count(*) AS n FROM l GROUP BY ALL),
b AS (SELECT field, site, measure, length, sum(n) AS n FROM (FROM m UNION ALL SELECT field, NULL, measure, length, n FROM m) GROUP BY ALL),
t AS (SELECT field, site, measure, max(length) AS top FROM b GROUP BY ALL),
r AS (SELECT t.field, t.site, t.measure, top, sum(n) FILTER (length = top) AS at_top, coalesce(sum(n) FILTER (length < top AND length >= top - {NEAR}), 0) AS near
  FROM t JOIN b ON t.field = b.field AND t.site IS NOT DISTINCT FROM b.site AND t.measure = b.measure GROUP BY ALL)
SELECT field, site, measure, CAST(top AS INTEGER) AS "limit", CAST(at_top AS BIGINT) AS at_limit FROM r WHERE at_top >= {LIMIT_VALUES} AND at_top * {NEAR} >= near * {LIMIT_PEAK}"""
}
