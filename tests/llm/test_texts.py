import time

import pytest
from pyspark.sql import functions as F

from lodestar.llm.boilerplate import frame_lines, frame_titles, repeated_lines, train_tree
from lodestar.llm.frames import FEATURES, line_features, site_of, title_has_frame
from lodestar.llm.labelled_pages import labelled_pages
from lodestar.llm.frames import mask
from lodestar.llm.residue import ARTICLE, has_cue, has_slot, is_filler, merge_lines, mine_templates, own_lines, spoilt_values
from lodestar.llm.sentences import sentence_offsets, split_sentences
from lodestar.llm.tokens import encoding, VOCABULARY, with_token_counts
from lodestar.llm.truncation import cut_values, hidden_limits, with_lengths

PAGE = "slug string, collected_at string, raw_text string, raw_title string, raw_meta_desc string, name string, website_url string, source_url string, line_no int, x string, field string"


def units(text):
    return [text[a:b] for a, b in sentence_offsets(text)]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("One. Two! Three? Four", ["One.", "Two!", "Three?", "Four"]),
        ('The manual says: "Stop. Save. Restart." Then go.', ['The manual says: "Stop. Save. Restart."', "Then go."]),
        ('"Does it scale?" asked one. Yes.', ['"Does it scale?" asked one.', "Yes."]),
        ("Dr. Vey paid $3.50 vs. $4.00, e.g. in the U.S. and more. It rose... slowly.", ["Dr. Vey paid $3.50 vs. $4.00, e.g. in the U.S. and more.", "It rose... slowly."]),
        ("You get a, b, etc. 🙂 The end.", ["You get a, b, etc. 🙂", "The end."]),
        ("See no. 4 (i.e. the one on p. 3). (It is small.) Fine.", ["See no. 4 (i.e. the one on p. 3).", "(It is small.)", "Fine."]),
        ("## Notes\n- one. two\n- three\nSome text.", ["## Notes", "- one. two", "- three", "Some text."]),
        ("- first item that\n  goes on. Here too\n  - nested one\n    and its rest\n  - second\n- last\nText after. More.", ["- first item that\n  goes on. Here too", "- nested one\n    and its rest", "- second", "- last", "Text after.", "More."]),
        ("See Sect. 3 for more. Maj. Lee wrote it.", ["See Sect. 3 for more.", "Maj. Lee wrote it."]),
        ("Q: Does it work?\nA: No, not yet.", ["Q: Does it work?", "A: No, not yet."]),
        ("Paid plans add form builders and a long row of other\nthings that nobody ever asked for in the first place and\nnever will. Next.", ["Paid plans add form builders and a long row of other\nthings that nobody ever asked for in the first place and\nnever will.", "Next."]),
        ("price went to $39 lol\nanyone got it working", ["price went to $39 lol", "anyone got it working"]),
        ("Am 3. Mai kam z. B. Version 2.1. „Lohnt sich das?“, fragte sie.", ["Am 3. Mai kam z. B. Version 2.1.", "„Lohnt sich das?“, fragte sie."]),
        ("« Est-ce fiable ? » demande M. Roy. Oui !", ["« Est-ce fiable ? » demande M. Roy.", "Oui !"]),
        ("¿Vale? ¡Sí! EE. UU. es grande.", ["¿Vale?", "¡Sí!", "EE. UU. es grande."]),
        ("Есть отчёты и т. д. для всех. Вышла в 2026 г. и всё.Конец.", ["Есть отчёты и т. д. для всех.", "Вышла в 2026 г. и всё.", "Конец."]),
        ("Αξίζει για ομάδες; Κοστίζει 3 €, π.χ. για όλους.", ["Αξίζει για ομάδες;", "Κοστίζει 3 €, π.χ. για όλους."]),
        ("他说：“停下。保存。”它很好。“可靠吗？”客户问道。", ["他说：“停下。保存。”", "它很好。", "“可靠吗？”客户问道。"]),
        ("担当者は「止めて。保存して。」と言いました。速い！", ["担当者は「止めて。保存して。」と言いました。", "速い！"]),
        ("क्या यह काफ़ी है? डॉ. Roy ने परखा।", ["क्या यह काफ़ी है?", "डॉ. Roy ने परखा।"]),
        ("قال د. Roy إن هذا مفيد. هل يكفي؟", ["قال د. Roy إن هذا مفيد.", "هل يكفي؟"]),
        ("แผนฟรีรองรับ 29 โครงการ มีสรุปให้ใช้ทุกคืน ดร. Roy ทดสอบเป็นเวลา 5 วัน", ["แผนฟรีรองรับ 29 โครงการ", "มีสรุปให้ใช้ทุกคืน", "ดร. Roy ทดสอบเป็นเวลา 5 วัน"]),
        ("﻿  One.\xa0\tTwo.  ", ["One.", "Two."]),
        ('An "open quote. And on.', ['An "open quote.', "And on."]),
        ("", []),
        (" \n\t ", []),
    ],
)
def test_sentences(text, wanted):
    assert units(text) == wanted


def test_sentences_of_a_table(spark):
    table = spark.createDataFrame([(1, "Ab. Cd ef.", 5), (2, None, 5), (3, "  ", 5), (4, "Long one. " * 20_000, 5)], "doc_id long, text string, start_pos int")
    got = split_sentences(table, "doc_id", "text")
    assert sorted(map(tuple, got.where("doc_id < 4").collect())) == [(1, 0, 3), (1, 4, 10)]
    assert got.where("doc_id = 4").count() == 20_000
    assert split_sentences(table.limit(0), "doc_id", "text").count() == 0


def test_site_and_titles():
    assert site_of("HTTPS://www.A.example:8080/x?y", None) == site_of(None, "//a.example") == "a.example" and site_of(None, "") == ""
    for title, found in (("Baro - Tulobe", True), ("Docs › Baro", True), ("(3) Baro", True), ("Home", True), ("Baro - shared drafts", False), ("Baro: page builder", False), ("Page builder Baro", False)):
        assert title_has_frame(title, "Baro", "tulobe.example") is found, title


def test_tree_on_held_out_pages(spark):
    made = labelled_pages(300, seed=77)
    rows = [(str(i), "1", "\n".join(t for t, _ in lines), None, None, name, site, None, 1, "x", "f") for i, (name, site, lines) in enumerate(made)]
    pages, tree = spark.createDataFrame(rows, PAGE), train_tree(spark)
    found = {(int(r["slug"]), r["line_no"]) for r in frame_lines(pages, tree).collect()}
    wanted = [((i, n), mark) for i, (_, _, lines) in enumerate(made) for n, (_, mark) in enumerate(lines)]
    assert sum((at in found) == mark for at, mark in wanted) / len(wanted) > 0.95


def test_a_widget_list_goes_on_for_as_long_as_its_kind():
    for others in ([f"Muvo{'abcdefghijkl'[i]}" for i in range(12)], [f"Muvo sorts the mail of shop {i}." for i in range(12)], [f"Muvo{'abcdefghijkl'[i]} – page builder" for i in range(12)]):
        found = line_features(["Related tools", *others, "- 4 seats included", others[0]], "Baro", "tulobe.example", {}, set())
        assert [x[FEATURES.index("widget_run")] for x in found] == [0, *[1] * 12, 0, 0]


def test_frame_lines_of_a_long_list(spark):
    names = [f"Muvo {x}ari" for x in "ABCDEFGHIJKL"]
    teasers = [f"{x} sorts the mail of a small shop." for x in names]
    for entries in (names, teasers):
        text = "\n".join(["Baro sorts mail. It is fast and small.", "Related tools", *entries, "© 2025 Tulobe"])
        pages = spark.createDataFrame([("baro", "2026", text, None, None, "Baro", "https://tulobe.example", None, 1, "x", "f")], PAGE)
        assert sorted(r["line_no"] for r in frame_lines(pages, train_tree(spark)).collect()) == list(range(1, 15))


def test_frame_lines(spark):
    text = "We use cookies to improve the visit.\nAccept all\n\nHome | Pricing | Docs\nBaro Kit\nPricing\nBaro Kit sorts mail. It is fast and small, and it asks visitors for consent to cookies.\n- 4 seats included\nRelated tools\nMuvo\nTari Desk\n© 2025 Tulobe"
    page = ("baro", "2026", text, "Baro Kit - Tulobe", "x", "Baro Kit", "https://tulobe.example", None, 1, "x", "f")
    pages = spark.createDataFrame([page, page, ("n", "2026", None, None, None, None, None, None, 1, "x", "f"), ("e", None, " \n ", " ", "", "E", "", "", 1, "x", "f")], PAGE)
    got = frame_lines(pages, train_tree(spark)).distinct().collect()
    assert sorted(r["line_no"] for r in got) == [0, 1, 3, 8, 9, 10, 11] and {r["slug"] for r in got} == {"baro"}
    assert [tuple(r) for r in frame_titles(pages).collect()] == [("baro", "2026")]
    assert frame_lines(pages.limit(0), train_tree(spark)).count() == 0


@pytest.mark.parametrize("line, found", [("Try [[headline]] today", True), ("Hello *|FNAME|*,", True), ("{$title}", True), ("((vendor)) helps", True), ("Built for YOUR_TEXT_HERE", True), ("A [[" + "very " * 20 + "long]] slot", True), ("© {{ year }} Tulobe", True), ("From %ITEM% per month", True), ("Welcome to __BRAND__, friend", True), ("Built for [object Object] and you", True), ("undefined helps teams", True), ("[link](/tools/x)", False), ("46% error, 5% more", False), ("Write {{first_name}} and Baro fills in the name", False), ("Variables such as ${TEAM} are replaced", False), ("call to undefined function f()", False)])
def test_slots(line, found):
    assert has_slot(line) is found


def test_filler_messages_and_templates():
    assert is_filler("Sed ut perspiciatis unde omnis iste natus.") and is_filler("Lorem ipsum dolor sit amet.") and is_filler("Your description goes here") and is_filler("TODO: write a summary")
    assert not is_filler("Designers can drop lorem ipsum into a frame with one shortcut.")
    for line in ("You need to enable JavaScript to run this app.", "502 Bad Gateway", "Hmm, that page is no longer here (error 404).", "Seite nicht gefunden", "This content is not available in your region."):
        assert has_cue(mask(line, "Baro", "tulobe.example")), line
    for line in ("Baro groups server errors (500, 502) by cause.", 'A visitor sees "Access denied" and the log tells why.', "It offers bulk imports."):
        masked = mask(line, "Baro", "tulobe.example")
        assert not has_cue(masked) or ARTICLE.search(masked), line
    found = merge_lines([("sorry, this page has moved.", 3), ("sorry, that page has moved.", 1), ("it costs ten euros here.", 1)])
    assert [t for t, _ in found] == ["sorry, <*> page has moved.", "sorry, <*> page has moved.", "it costs ten euros here."]


def test_spoilt_values(spark):
    article = "Baro sorts mail for small teams. Please enable scripts for the best experience."
    data = [
        ("a", "1", "Home | Docs | Blog\nBaro\n502 Bad Gateway\nRelated tools\nMuvo\n© 2025 Tulobe", None, "Baro sorts mail.", "Baro", "tulobe.example", None),
        ("b", "1", article + "\nTry {{name}} today.", None, "Page not found", "Baro", None, None),
        ("c", "1", article, None, "Baro fills {{name}} fields in your mails.", "Baro", None, None),
        ("d", None, None, None, None, None, None, None),
        ("e", "1", "", None, "Lorem ipsum dolor sit.", None, None, None),
    ]
    pages = spark.createDataFrame([(*r, 1, "x", "f") for r in data + data[:1]], PAGE)
    assert sorted(map(tuple, spoilt_values(pages).collect())) == [("a", "1", "raw_text"), ("b", "1", "raw_meta_desc"), ("b", "1", "raw_text"), ("e", "1", "raw_meta_desc")]
    assert spoilt_values(pages.limit(0)).count() == 0


def test_templates_count_the_lines_of_all_records(spark):
    article = "Baro sorts mail for small teams and it never loses a single letter of them."
    texts = ["502 Bad Gateway", article + "\n502 Bad Gateway", "Try {{name}} today.\n502 Bad Gateway", "502 Bad Gateway\n- 4 seats included"]
    pages = spark.createDataFrame([(str(i), "1", t, None, None, "Baro", None, None, 1, "x", "f") for i, t in enumerate(texts)], PAGE)
    found = mine_templates(own_lines(pages)).where("message")
    assert [(r["masked"], r["n"]) for r in found.collect()] == [("# bad gateway", 4)]


def test_a_sentence_is_judged_by_its_template(spark):
    texts = [f"Sorry, the page you want was {word}." for word in ("moved", "moved", "eaten")]
    pages = spark.createDataFrame([(str(i), "1", t, None, None, "Baro", None, None, 1, "x", "f") for i, t in enumerate(texts)], PAGE)
    assert sorted(r["slug"] for r in spoilt_values(pages).collect()) == ["0", "1", "2"]


def _site_pages(spark):
    """Pages of six sites whose frames use words that no list of the library has, and one page of each kind of article."""
    frames = ["Webinars | Investors | Press room", "Manage preferences", "Affiliate disclosure", "The letter of record for busy buyers of software.", "Ombudsman"]
    rows = []
    for i in range(24):
        name, site = f"Tool{'abcdefghijklmnopqrstuvwx'[i]}o", f"site{i % 6}.example"
        article = [name, "Overview", f"{name} sorts mail number {i}. It is fast and small.", f"- {i} seats included", f"It saves the {i}th hour of every day for teams that write, read and answer."]
        rows.append((name, "1", "\n".join([frames[0], frames[1], *article, *frames[2:]]), None, None, name, f"https://{site}", None, 1, "x", "f"))
    return spark.createDataFrame(rows, PAGE)


def test_frames_in_words_of_their_own_are_found_by_what_repeats(spark):
    pages, tree = _site_pages(spark), train_tree(spark)
    lines = lambda found: {(r["slug"], r["line_no"]) for r in found.collect()}
    wanted = {(r["slug"], n) for r in pages.collect() for n in (0, 1, 7, 8, 9)}
    whole, blind = lines(frame_lines(pages, tree)), lines(frame_lines(pages, tree, repeats=False))
    assert len(whole & wanted) >= 0.5 * len(wanted) and len(whole - wanted) <= 0.05 * len(wanted)
    assert len(blind & wanted) < len(whole & wanted)  # without the counts of what repeats, true cases are lost
    assert repeated_lines(pages.limit(0))[0] == {}


def test_a_template_without_known_words_is_judged_by_where_it_stands(spark):
    article = "Baro sorts mail for small teams and it never loses a single letter of them, said the owner of a shop. It is a fast tool that all of them like to use."
    texts = [f"Hier wohnt niemand mehr, Raum {n}." for n in range(3)]
    texts += [f"{article}\nThe old form was removed in May."] * 3 + ["The old form was removed in May.\nA quiet word on prices follows soon."]
    pages = spark.createDataFrame([(str(i), "1", t, None, None, "Baro", None, None, 1, "x", "f") for i, t in enumerate(texts)], PAGE)
    # The first wording is no known message, but never stands beside an article; the last has words of messages, but articles have it.
    assert sorted(r["slug"] for r in spoilt_values(pages).collect()) == ["0", "1", "2"]
    assert not any(has_cue(mask(t, "Baro", "")) for t in texts[:3]) and has_cue(mask(texts[-1], "Baro", ""))
    assert spoilt_values(pages.where("slug = '0'")).count() == 0  # one page alone tells nothing


def _values(spark, texts, site="s"):
    return spark.createDataFrame([("f", str(i), "", site, t, 1) for i, t in enumerate(texts)], "field string, row_key string, row_version string, site string, text string, lengths int").drop("lengths")


def test_cut_values(spark):
    whole = [f"Reviewers praise the drafts, and the tool sorts {n} mails for small teams." for n in range(30)] + ["Page builder for small teams", "It works. And much more...", "It works. (see below)", "It works. www.baro.example", "Fine. 🚀", "It works.\n\n- drafts\n- small teams", "それは速いです。", None, "", "  "]
    cut = ["Reviewers praise the drafts, and the tool sor", "It works. Reviewers praise the", "It works for teams. Reviewers praise the…", "It works. The editor lo�", "Reviewers praise the drafts, and"]
    table = _values(spark, whole + cut + cut[:0])
    got = {int(r["row_key"]) for r in cut_values(table.unionByName(table.limit(3))).collect()}
    assert got == set(range(len(whole), len(whole) + len(cut)))
    assert cut_values(table.limit(0)).count() == 0


def test_limits_decide_what_endings_cannot(spark, monkeypatch):
    from lodestar.llm import truncation

    # A store of 37 characters: these stop after a word that ends sentences as often as not, or after a dot inside one.
    words = ["drafts for small teams", "mail for teams"]
    whole = [f"It sorts {w} in less than {n} days for teams." for n in range(10, 40) for w in words] + ["Notes for small teams", "Page builder for shops with many teams"]
    cut = [f"{x} builder of pages and mail for teams" for x in "ABCDE"] + ["Mails are sorted in three days, incl."]
    assert {len(c) for c in cut} == {37}
    table = _values(spark, cut, "small").unionByName(_values(spark, whole, "large").withColumn("row_key", F.concat(F.lit("w"), "row_key")))
    found = {r["row_key"] for r in cut_values(table).collect() if not r["row_key"].startswith("w")}
    monkeypatch.setattr(truncation, "hidden_limits", lambda values, real=truncation.hidden_limits: real(values.limit(0)))
    blind = {r["row_key"] for r in cut_values(table).collect() if not r["row_key"].startswith("w")}
    assert found == set(map(str, range(len(cut)))) and "5" not in blind and len(blind) < len(found)


def test_a_cut_inside_a_very_long_word(spark):
    long = "donau" * 12 + "fahrt"
    table = _values(spark, [f"We like the {long} a lot, said {n} people." for n in range(6)] + [f"Tour of the {long[:50]}"])
    assert "6" in {r["row_key"] for r in cut_values(table).collect()}


def test_a_very_long_word_inside_a_value_takes_no_time_of_its_own(spark):
    # Cut patterns that end a value must not be tried from every character of it: 300,000 here, so 45,000 million steps.
    table = _values(spark, [f"Reviewers praise {'x' * 300_000} of drafts, {end}" for end in ("said one of them.", "sa", "and")] + ["He said it works, and it does."])
    began = time.monotonic()
    got = {r["row_key"] for r in cut_values(table).collect()}
    assert got == {"1", "2"} and time.monotonic() - began < 40


def test_endings_behind_many_closing_marks(spark):
    cases = {"It works. Reviewers praise the…": True, "It works. Reviewers praise the...": True, "It works. Reviewers praise them.": False, "It works. Reviewers praise e.g.": True}
    texts = [(text + ")" * n, cut) for text, cut in cases.items() if not text.endswith("e.g.") for n in (0, 59, 60, 61, 62, 63, 64, 65, 200)] + [*cases.items()]
    texts += [(f"{'y' * n} {text}", cut) for text, cut in cases.items() for n in (30, 100)]
    got = {int(r["row_key"]) for r in cut_values(_values(spark, [t for t, _ in texts])).collect()}
    assert got == {i for i, (_, cut) in enumerate(texts) if cut}


def test_lengths_of_odd_characters(spark):
    texts = ["", "plain", "a & b <c> \"d\" \\ e", "tab\tline\nend\r\n", "été", "日本\u2028語", "🚀é&🚀\n", "\"" * 50 + "ü", "\x00\x7f\x80"]
    got = {r["text"]: r["lengths"] for r in with_lengths(_values(spark, texts)).collect()}
    for t in texts:
        units, escapes = len(t.encode("utf-16-be")) // 2, sum(map(t.count, "\"\\\n\t\r"))
        beyond = sum(len(c.encode("utf-16-be")) // 2 for c in t if ord(c) > 127)
        html = len(t) + 4 * t.count("&") + 3 * (t.count("<") + t.count(">")) + 5 * t.count("\"")
        assert got[t] == {
            "code_points": len(t), "utf8_bytes": len(t.encode()), "utf16_units": units, "html_escaped": html,
            "json_escaped": len(t) + escapes, "json_ascii": units + escapes + 5 * beyond, "crlf": len(t) + t.count("\n"),
        }


def test_hidden_limits_in_bytes(spark):
    texts = ["é" * n for n in range(5, 40)] + ["é" * 40 + "x" * k + "é" * (20 - k // 2) for k in (0, 2, 4, 6, 8, 10)]
    found = {(r["site"], r["measure"]): r["limit"] for r in hidden_limits(with_lengths(_values(spark, texts))).collect()}
    assert found[("s", "utf8_bytes")] == found[(None, "utf8_bytes")] == 120 and ("s", "code_points") not in found


def test_tokens(spark):
    table = with_token_counts(spark.createDataFrame([("Hello world",), (None,), ("",)], "t string"), "t")
    assert sorted(r["tokens"] for r in table.collect()) == [0, 0, len(encoding(VOCABULARY).encode_ordinary("Hello world"))]
    assert encoding(VOCABULARY).decode(encoding(VOCABULARY).encode_ordinary("你好 – ok")) == "你好 – ok"
