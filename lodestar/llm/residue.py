"""Problem 3: template residue, filler and error pages among page texts and descriptions.

Method: a fixed-depth prefix tree. Lines outside the frame of every page, with numbers and the names of tool and site
masked, go down a tree by their number of words and their first words; lines of one leaf that agree in enough places share
a template. Each template is classified once, by what all its lines show together: how many pages it stands on, how many of
these have an article, whether it names the tool, and the share of its lines that have words of messages.
A template that stands on several pages and never beside an article is a message whatever it says; one with the words of
messages is none if articles have it. The verdict goes to all lines of the template; a page with such a line and without an
article is spoilt. Unfilled slots and filler are looked for in every line of every record.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.frames import BULLET, HEADINGS, STOPS, frame_sentence, in_frame, mask, site_of
from lodestar.runtime import balance, cut_lineage, let_workers_import, spread, table

#: A line with more words, and more than one sentence, is running text of an article.
PROSE_WORDS = 24
#: Words of a line that choose its leaf, and share of places in which lines of one template agree.
DEPTH, AGREE = 2, 0.65
#: Parts of a leaf that are merged in tasks of their own.
PARTS = 16
#: Lines of a template that never stand beside an article make it a message from so many pages on.
ALONE_PAGES = 2
#: A template with message words is none if more than this share of the pages it stands on has an article.
BESIDE_ARTICLES = 0.5

_INSIDE = r"[A-Za-z_][\w.\- ]*"
#: Slots: a name between signs that mirror each other, or statements of template languages.
SLOT = re.compile(
    r"\{\{[^{}\n]*\}\}|[$#]\{[^{}\n]+\}|\{%[^%\n]+%\}|<%[=-]?[^%\n]+%>|\[%[^%\n]+%\]|\[\[[^\[\]\n]+\]\]|\{[!$@#&][^{}\n]+\}|<\?[^?\n]+\?>"
    rf"|@@ ?{_INSIDE}@@|%%{_INSIDE}%%|%[A-Za-z_][\w.]*(?: [\w.]+){{0,2}}%|\$[A-Za-z_][\w.]*(?: [\w.]+){{0,2}}\$|__{_INSIDE}?__(?!\w)|\{{(?:\d+|{_INSIDE})\}}|~[A-Za-z_][\w.]*(?: \w+){{0,3}}~"
    rf"|\(\( ?{_INSIDE}\)\)|\*\| ?{_INSIDE}\|\*|\|\*? ?{_INSIDE}\*\||##{_INSIDE}##|!!{_INSIDE}!!|\^\^?{_INSIDE}\^\^?|<<{_INSIDE}>>|::{_INSIDE}::|==[A-Z_]{{2,}}=="
    rf"|<(?!/|a\b|b\b|i\b|p\b|br\b|div\b|em\b|ul\b|li\b|span\b|strong\b){_INSIDE}>|\[(?!\d|x\]|\w+\]\(){_INSIDE}\](?!\()|\bXXX-\w+-XXX\b|\b(?:YOUR|INSERT|ENTER|ADD|TODO)_[A-Z][A-Z_]*\b|\b[A-Z]+(?:_[A-Z]+)*_HERE\b"
    r"|\[object Object\]|(?<![\w.'\"-])undefined(?!\s+(?:function|variable|index|method|symbol|reference|behaviou?r|offset))\b|\bnull - null\b|^(?:null|NaN|None|undefined)$"
)
_LETTERS = re.compile(r"[\W\d_]+")
#: Words with which a text speaks about slots and filler instead of having one left over.
SPEAKS = re.compile(r"(?i)\b(?:fills?(?: in| out)?|filled|replaced?|replaces|variables?|placeholders?|substitut\w*|merge (?:tags?|fields?)|drop|shortcut|swap|syntax|snippets?|when it is sent|remplac\w*|variable|rellena|reemplaza|ersetzt|platzhalter)\b")
# Words of the usual Latin filler.
LATIN = set("""lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud
exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat
non proident sunt culpa qui officia deserunt mollit anim id est laborum vitae massa augue quam sem lectus porta eros ullam cor vel nunc eget mauris tellus perspiciatis unde omnis iste natus error voluptatem accusantium doloremque laudantium totam rem aperiam eaque ipsa quae ab illo inventore veritatis quasi architecto beatae dicta explicabo nemo ipsam quia aspernatur aut odit fugit consequuntur magni dolores eos ratione sequi nesciunt neque porro quisquam""".split())  # fmt: skip
FILLER = re.compile(
    r"(?i)^\W*(?:your (?:\w+ ){0,2}(?:text|description|title|content|tagline|copy) (?:goes )?here|(?:add|insert|enter|put|write) (?:a |an |your |the )?(?:\w+ ){0,3}(?:text|description|summary|title|tagline|content)(?: of your \w+)?(?: here)?"
    r"|replace this (?:text|copy|description)\b.*|(?:meta )?(?:description|title|summary|text) (?:goes )?here\b.*|meta[ -]?description|(?:todo|tbd|fixme|xxx)\b.*|(?:sample|dummy|placeholder|filler|example|default) (?:text|description|content|copy)\b.*"
    r"|blah(?: blah)+|asdf\w*|test test\b.*|text kommt noch|hier steht ihr text|texte à venir|votre texte ici|texto de (?:ejemplo|relleno)|su texto aquí|tu texto aquí|beispieltext|blindtext)\W*$"
)
_SCRIPTS = r"(?:java\s?script|client-side\ scripting|scripting|scripts?|js)\b"
MESSAGE = re.compile(
    rf"(?ix) \b(?:enable|enabled|activate|turn\ on|switch\ on|allow|requires?|needs?|activer|activez|aktivieren|activar?|active|habilit\w*|permit)\b .{{0,40}} {_SCRIPTS} | {_SCRIPTS} .{{0,40}} \b(?:is|are|seems?|be|to\ be|est|ist|está)\b .{{0,12}} \b(?:disabled|off|required|needed|blocked|désactivé|deaktiviert|desactivado)\b"
    rf"| {_SCRIPTS}\ (?:is\ |are\ )?(?:required|needed|disabled|blocked)\b | \b(?:engineers?|team|admin\w*)\ (?:has|have|was|were)\ (?:been\ )?(?:told|notified|informed) | \b(?:please\ )?try\ again\ (?:later|in\ a|soon)"
    rf"| \bdoes\ not\ (?:run|support)\ {_SCRIPTS}"
    r"| \b(?:error|http|status|fehler|erreur)\W{0,3}[45]\d\d\b | ^\W*[45]\d\d\b(?:\W*$|\W+\D{0,40}$) | \berror\ [45]\#+ | ^\W*\#+\W*$"
    r"| \bnot\ found\b | \bno\ longer\ (?:here|available|exists?) | \bcould\ (?:not|n't)\ be\ (?:found|loaded|shown|displayed) | \bcan(?:not|'t)\ (?:find|be\ found|be\ reached) | \b(?:was|has\ been|were)\ (?:removed|deleted|taken\ down|moved)\b | \bhas\ moved\b | \bnever\ existed | \b(?:does|do)(?:\ not|n't)\ exist | \bnothing\ lives\ at | \bwent\ missing | \b(?:page|address|link)\ (?:is|seems)\ (?:gone|broken|missing)"
    r"| n'existe\ (?:pas|plus) | \bintrouvable | \bn'est\ (?:plus|pas)\ disponible | nicht\ (?:gefunden|vorhanden|verfügbar|erreichbar) | \bno\ (?:existe|se\ encuentra|está\ disponible) | \bno\ encontrad[ao] | \bwurde\ (?:entfernt|gelöscht|verschoben) | \ba\ été\ (?:supprimée?|déplacée?) | \b(?:ha\ sido|fue)\ (?:eliminad|borrad|movid)[ao] | \b(?:page|link)\ (?:has\ )?expired | \babgelaufen\W*$ | \ba\ expiré | \bha\ caducado"
    r"| \bbad\ gateway | \bservice\ (?:is\ )?(?:temporarily\ )?unavailable | \binternal\ server\ error | \bgateway\ time-?out | \bdatabase\ connection | \b(?:fatal|parse|syntax|runtime|server)\ error\b | \btraceback\ \( | \b\w*(?:error|exception):\s | \buncaught\b | \bstack\ trace | \bsomething\ (?:broke|went\ wrong) | \b(?:down|closed)\ for\ maintenance | \bunder\ (?:maintenance|construction) | \bbe\ (?:right\ )?back\ (?:soon|shortly) | \bmaintenance\ en\ cours | \bwartungsarbeiten | \ben\ mantenimiento | \bcoming\ soon\W*$"
    r"| \baccess\ (?:is\ |was\ )?denied | \bforbidden\b | \b(?:do\ not|don't)\ have\ permission | \bnot\ authori[sz]ed | \bunauthori[sz]ed | \bnot\ available\ in\ your\ (?:region|country) | \bverify\ (?:that\ )?you\ are\ (?:a\ )?human | \bchecking\ your\ browser | \bare\ you\ a\ robot | \bcaptcha\b | \btoo\ many\ requests | \bunusual\ traffic | \b(?:request|ip|address|you)\ (?:has\ been|have\ been|was|is|are)\ blocked | \bsession\ (?:has\ )?expired | \b(?:log|sign)\ in\ to\ (?:continue|view) | \baccès\ (?:refusé|interdit) | \bzugriff\ (?:verweigert|verboten) | \bacceso\ (?:denegado|prohibido)"
)
#: A line of an article by its words: it names the tool, quotes, or is an item of a list.
ARTICLE = re.compile(r"<name>|\"[^\"]+\"|[“«„]")


#: What a line must hold before it can have a slot.
_SIGNS = ("{", "[", "<", "~", "%", "$", "@@", "__", "((", "*|", "|*", "##", "!!", "^", "::", "==", "XXX-", "YOUR_", "INSERT_", "ENTER_", "ADD_", "TODO_", "_HERE", "undefined", "null", "NaN", "None")


@lru_cache(100_000)
def has_slot(line: str) -> bool:
    """Whether a line has an unfilled slot; a line that speaks about slots has none."""
    return any(x in line for x in _SIGNS) and bool(SLOT.search(line)) and not SPEAKS.search(SLOT.sub(" ", line))


@lru_cache(100_000)
def is_filler(line: str) -> bool:
    """Whether a line is filler: mostly words of Latin filler text, or a stock phrase that holds a place."""
    words = _LETTERS.sub(" ", line.lower()).split()
    latin = sum(w in LATIN for w in words)
    return len(words) > 2 and latin >= 0.6 * len(words) or bool(FILLER.match(line))


@lru_cache(50_000)
def _is_prose(line: str) -> bool:
    """Whether a line is running text of an article by itself, whatever stands around it."""
    return line.count(" ") >= PROSE_WORDS and len(STOPS.findall(line)) > 1 and not frame_sentence(line)


_LINE = "slug string, collected_at string, field string, masked string, words int, n long, texts long, beside long, sentence boolean, residue boolean"
_COLUMNS = [x.split()[0] for x in _LINE.split(", ")]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """The lines outside the frame of every record, and a row for each record with residue.

    Lines of records that are open, with neither residue nor an article by what their lines look like, keep the record's key;
    those of all others are only counted. ``texts`` and ``beside`` count the lines of page texts and those beside an article,
    ``sentence``: an article line unless its template is a message.
    """
    counted: Counter = Counter()

    def out(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=_COLUMNS)

    def sums() -> list[tuple]:
        return [(None, None, None, masked, masked.count(" ") + 1, n, n if text else 0, n if beside else 0, False, False) for (masked, text, beside), n in counted.items()]

    for batch in batches:
        rows = []
        for slug, at, text, about, name, url, source in zip(*(c.to_pylist() for c in batch.columns)):
            site, name = site_of(url, source), (name or "").strip()
            for field, value in (("raw_text", text), ("raw_meta_desc", about)):
                lines = [s for line in (value or "").split("\n") if (s := line.strip())]
                if not lines:
                    continue
                key, of_text = (slug, at, field), field == "raw_text"
                residue = any(has_slot(x) or is_filler(x) for x in lines)
                if residue:
                    rows.append((*key, None, 0, 0, 0, 0, False, True))
                article = of_text and any(_is_prose(x) for x in lines)
                frame = in_frame(lines, name, site) if of_text else [False] * len(lines)
                own = []
                for line, framed in zip(lines, frame):
                    if framed or line == name or line.lower() in HEADINGS or _is_prose(line):
                        continue
                    masked = mask(line, name, site)
                    words = masked.count(" ") + 1
                    article |= of_text and bool(words > PROSE_WORDS and STOPS.search(line) or BULLET.match(line) or ARTICLE.search(masked))
                    own.append((masked, words, of_text and words > 5 and bool(STOPS.search(line))))
                if residue or article:
                    counted.update((masked, of_text, article) for masked, _, _ in own)
                else:
                    rows += [(*key, masked, words, 1, int(of_text), 0, sentence, False) for masked, words, sentence in own]
        if len(counted) > 100_000:
            rows += sums()
            counted = Counter()
        yield out(rows)
    yield out(sums())


def _read_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c, {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}[x.split()[1]]) for c, x in zip(_COLUMNS, _LINE.split(", "))])
    for rows in _read(batches):
        yield pa.RecordBatch.from_pandas(rows, schema=schema, preserve_index=False)


def own_lines(pages: DataFrame) -> DataFrame:
    """What ``_read`` tells of the pages: rows with masked, words and counts, of open records with their key.

    Copies of a page are read as often as they occur; counts of pages are of rows.
    """
    let_workers_import(pages.sparkSession)
    pages = balance(pages.select("slug", "collected_at", "raw_text", "raw_meta_desc", "name", "website_url", "source_url"))
    return cut_lineage(pages.mapInArrow(_read_arrow, _LINE))


def merge_lines(lines: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Template of each line of one leaf, all of the same number of words: the first template that agrees in enough places.

    Places that differ become ``<*>``. Lines come with their counts, most frequent first; the result keeps their order.
    """
    codes: dict[str, int] = {"<*>": 0}
    coded = np.array([[codes.setdefault(w, len(codes)) for w in line.split()] for line, _ in lines], np.int64)
    templates, held, at = np.zeros((16, coded.shape[1]), np.int64), 0, []
    known: dict[tuple[int, ...], int] = {}
    for words in coded:
        found = known.get(key := tuple(words.tolist()))
        if found is None:
            own = templates[:held]
            same = ((own == words) | (own == 0)).sum(1)
            found = int(same.argmax()) if held else -1
            if found < 0 or same[found] < AGREE * len(words):
                if held == len(templates):
                    templates = np.vstack([templates, np.zeros_like(templates)])
                found = held
                templates[found] = words
                held += 1
            else:
                templates[found] = np.where(templates[found] == words, words, 0)
            known[key] = found
        at.append(found)
    said = list(codes)
    texts = [" ".join(said[c] for c in template) for template in templates[:held].tolist()]
    return [(texts[i], count) for i, (_, count) in zip(at, lines)]


def has_cue(line: str) -> bool:
    """Whether a masked line has words of an error, a refusal or a script notice and does not name the tool."""
    return bool(MESSAGE.search(line)) and "<name>" not in line


@F.pandas_udf(T.BooleanType())
def _has_cue(lines: pd.Series) -> pd.Series:
    return lines.map(has_cue).astype(bool)


def _merge_groups(columns: list[str]):
    """Gives every row, which come by group (leaf, part) and most frequent first, the template of its line (the third column)."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group: list[tuple] = []
        done: list[tuple] = []

        def close() -> None:
            templates = merge_lines([(r[2], r[3]) for r in group]) if len(group) > 1 else [(r[2], r[3]) for r in group]
            done.extend((*r, t) for r, (t, _) in zip(group, templates))

        for batch in batches:
            for row in batch.itertuples(index=False, name=None):
                if group and row[:2] != group[0][:2]:
                    close()
                    group = []
                group.append(row)
            yield pd.DataFrame(done, columns=columns)
            done = []
        close()
        yield pd.DataFrame(done, columns=columns)

    return merge


def mine_templates(lines: DataFrame) -> DataFrame:
    """(masked, template, n, message): the template of every distinct line, and whether the template is a message.

    ``lines`` is as from ``own_lines``. Lines are first counted, so that repeats travel once. The lines of a leaf are merged
    in PARTS tasks, then the templates of these, which are far fewer, once more together; a template is judged by the counts
    of all its lines. Null lines do not count; no lines give no rows.
    """
    counted = lines.where("masked IS NOT NULL").groupBy("masked", "words").agg(*[F.sum(c).alias(c) for c in ("n", "texts", "beside")])
    word = lambda i: F.get(F.split("masked", " "), F.lit(i))
    counted = counted.withColumn("leaf", F.concat_ws(" ", F.col("words").cast("string"), *[F.when(word(i).rlike(r"[#<{\[]"), "<*>").otherwise(word(i)) for i in range(DEPTH)]))
    counted = counted.select("leaf", F.pmod(F.xxhash64("masked"), F.lit(PARTS)).alias("part"), F.col("masked").alias("line"), "n", "texts", "beside")
    order = ["leaf", "part", F.desc("n"), "line"]
    mined = spread(counted, "leaf", "part").sortWithinPartitions(*order).mapInPandas(_merge_groups([*counted.columns, "template"]), T.StructType([*counted.schema.fields, T.StructField("template", T.StringType())]))
    mined = cut_lineage(mined.select("leaf", F.col("line").alias("masked"), "n", "texts", "beside", F.col("template").alias("part_template"), _has_cue("line").alias("cue")))
    facts = mined.groupBy("leaf", "part_template").agg(*[F.sum(c).alias(c) for c in ("n", "texts", "beside")], F.sum(F.when(F.col("cue"), F.col("n")).otherwise(0)).alias("cues"))
    again = facts.select("leaf", F.lit(0).alias("part"), F.col("part_template").alias("line"), "n")
    merged = spread(again, "leaf").sortWithinPartitions(*order).mapInPandas(_merge_groups([*again.columns, "template"]), T.StructType([*again.schema.fields, T.StructField("template", T.StringType())]))
    merged = cut_lineage(merged.select("leaf", F.col("line").alias("part_template"), "template"))
    facts = facts.join(merged, ["leaf", "part_template"]).groupBy("leaf", "template").agg(*[F.sum(c).alias(c) for c in ("n", "texts", "beside", "cues")])
    names_tool, alone = F.col("template").contains("<name>"), (F.col("beside") == 0) & (F.col("texts") >= ALONE_PAGES)
    worded = (F.col("cues") * 2 > F.col("n")) & (F.col("beside") <= BESIDE_ARTICLES * F.col("texts"))
    verdicts = facts.select("leaf", "template", (~names_tool & (alone | worded)).alias("message")).join(merged, ["leaf", "template"])
    return mined.join(verdicts, ["leaf", "part_template"]).select("masked", "template", "n", "message")


def spoilt_values(pages: DataFrame) -> DataFrame:
    """(slug, collected_at, field): the raw_text and raw_meta_desc values with residue or filler, or a message for content.

    ``pages`` has slug, collected_at, raw_text, raw_meta_desc, name, website_url and source_url; other columns are not read.
    Null and blank values are no cases, repeated rows count once, texts are read whole. An empty table gives no rows.
    """
    lines = own_lines(pages)
    told = lines.where("field IS NOT NULL AND masked IS NOT NULL").join(mine_templates(lines).select("masked", "message"), "masked")
    key = ["slug", "collected_at", "field"]
    open_ = told.groupBy(*key).agg(F.bool_or("message").alias("message"), F.bool_or(F.col("sentence") & ~F.col("message")).alias("article"))
    return open_.where("message AND NOT article").select(*key).unionByName(lines.where("residue").select(*key)).distinct()


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return spoilt_values(table(spark, root, "raw_tools"))


def p3_templates(spark: SparkSession, root: str) -> DataFrame:
    """The message templates of all pages, with the number of lines each covers."""
    lines = own_lines(table(spark, root, "raw_tools"))
    return mine_templates(lines).where("message").groupBy("template").agg(F.sum("n").alias("lines"))


QUERIES = {"p3_found": p3_found, "p3_templates": p3_templates}
ORACLES: dict[str, str] = {}
