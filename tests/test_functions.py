import pytest
from pyspark.sql import functions as F

from lodestar.functions import text as X
from lodestar.functions import values as V


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("url, loose, strict", [("HTTPS://www.A.com/x/", "a.com", "a.com"), ("a.com:8080/x", "a.com:8080", "a.com"), ("", None, None), (None, None, None), ("https://a.com?x=1", "a.com?x=1", "a.com")])
def test_hosts(spark, url, loose, strict):
    u = F.lit(url).cast("string")
    assert (one(spark, X.loose_host(u)), one(spark, X.strict_host(u))) == (loose, strict)


def test_slug_and_label(spark):
    assert one(spark, X.slugify(F.lit("Text to_Speech!"))) == "text-to-speech"
    assert one(spark, X.slugify(F.lit("Éditeur  IA"))) == "editeur-ia"
    assert one(spark, X.slugify(F.lit(None).cast("string"))) == ""
    assert len(one(spark, X.slugify(F.lit("a" * 90)))) == 40
    assert one(spark, X.pretty_label(F.lit("ai-coding api"))) == "AI Coding API"


def test_pair_key_is_symmetric(spark):
    assert one(spark, X.pair_key(F.lit("jasper"), F.lit("copy-ai"))) == one(spark, X.pair_key(F.lit("copy-ai"), F.lit("jasper"))) == "copy-ai-vs-jasper"


@pytest.mark.parametrize("score, expected", [(85, 8.5), (7.3, 7.3), (120, 10.0), (-5, 0.0), (None, None), ("abc", None), (10, 10.0)])
def test_scores(spark, score, expected):
    value = F.lit(score) if isinstance(score, str) else F.lit(score).cast("double")
    assert one(spark, V.score_or_null(value)) == expected
    assert one(spark, V.score_or_default(value)) == (5.0 if expected is None else expected)


@pytest.mark.parametrize("value, expected", [(5.0, 1.0), (-2.0, 0.0), (0.3, 0.3)])
def test_share(spark, value, expected):
    assert one(spark, V.share(F.lit(value))) == expected
    assert one(spark, V.share(F.lit("haut"))) == 0.0


def test_cosine_of_odd_vectors(spark):
    a = F.array(F.lit(1.0), F.lit(2.0))
    assert one(spark, V.cosine(a, F.array(F.lit(1.0)))) == 0.0
    assert one(spark, V.cosine(a, F.array(F.lit(0.0), F.lit(0.0)))) == 0.0
    assert one(spark, V.cosine(a, a)) == pytest.approx(1.0)
    assert one(spark, V.clamp_similarity(F.lit(0.5496))) == 0.55


def test_stale_is_strict(spark):
    now = F.lit("2026-03-31 00:00:00").cast("timestamp")
    assert one(spark, V.older_than(F.lit("2026-03-01 00:00:00").cast("timestamp"), now, 30)) is False
    assert one(spark, V.older_than(F.lit("2026-02-28 23:59:59").cast("timestamp"), now, 30)) is True
    assert one(spark, V.older_than(F.lit(None).cast("timestamp"), now, 30)) is False


def test_titles_and_descriptions(spark):
    none = F.lit(None).cast("string")
    title = one(spark, X.title_or(none, F.lit("Demo Tool"), F.lit("does things"), F.lit("demo")))
    assert title == "Demo Tool — does things"
    assert one(spark, X.title_or(none, none, none, F.lit("demo"))) == "demo"
    assert len(one(spark, X.description_or(F.lit("x" * 400)))) == 155


def test_html(spark):
    html = F.lit('<TITLE a="1">A <b>B</b> </TITLE><meta content="it\'s so" property="og:description"><p>x&amp;y</p>')
    assert one(spark, X.html_title(html)) == "A B"
    assert one(spark, X.html_description(html)) == "it's so"
    assert one(spark, X.html_description(F.lit("<p>none</p>"))) == ""
    assert one(spark, X.html_text(html)) == "A B x&amp;y"


def test_known_first(spark):
    allowed = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert one(spark, V.known_first(F.array(F.lit("c"), F.lit("x"), F.lit("c"), F.lit("a"), F.lit("b")), allowed, 2)) == ["c", "a"]
    assert one(spark, V.known_first(F.lit(None).cast("array<string>"), allowed, 2)) == []


def test_html_dom_text(spark):
    html = F.lit("<html><nav>Home <b>x</b></nav><script>var a = '<p>';</script><p> A &amp; B </p><div>C<style>p{}</style></div><footer>f</footer></html>")
    assert one(spark, X.html_dom_text(html)) == "A & B C"
    assert one(spark, X.html_dom_text(F.lit(None).cast("string"))) is None
    assert one(spark, X.html_dom_text(F.lit("plain <b>text"))) == "plain text"
