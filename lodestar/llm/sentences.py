"""Problem 9: sentence units of documents in any script.

Method: a pushdown automaton. A first pass over the lines, with a stack of list levels, tells list items (with their more
deeply indented lines), headings and loose lines, which are units of their own, from running text that was wrapped. Over running text the automaton keeps a stack of open quotations and
brackets; sentence ends count only with an empty stack, or where the closing of a quotation that held a whole sentence
empties it. Dots are looked up backwards in a trie of abbreviations. Thai, which has no sentence mark, is cut at blanks
between words that do not continue a sentence. Only offsets leave the automaton.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.runtime import let_workers_import, parallelism, table

# Abbreviations after which a sentence goes on whatever follows, and those that may also end one.
GO_ON = (
    "dr mr mrs ms prof st sr sra dra srta hr fr m mm mme mlle me e.g i.e cf vs approx no nos fig sect vol p pp pg ed eds nr art pág págs "
    "p.ex p.ej c.-à-d z.b d.h u.a ca bzw usf vgl abb bd т.е т.н см рис стр ул гл π.χ δηλ σελ κ. αρ д-р д डॉ श्री د ดร น.ส ม.ล gen col capt lt maj sgt lic ing rev hon sen rep gov ee"
).split()
MAY_END = (
    "etc inc ltd co corp bros jr u.s u.k e.u a.m p.m jan feb mar apr jun jul aug sep sept oct nov dec usw usf uu ee.uu "
    "т.д т.п др г мес руб тыс млн коп κ.ά κ.λπ al bibl tel ext dept est approx.no min max avg"
).split()
GERMAN_MONTHS = "Januar Februar März April Mai Juni Juli August September Oktober November Dezember".split()
# Thai words that carry a sentence on after a blank, and those that want more after one.
THAI_GOES_ON = "และ หรือ แต่ ถูกกว่า แพงกว่า แล้ว เป็น คือ ทดสอบ เพิ่ม กับ ที่ ซึ่ง โดย ให้ ว่า จึง ก็ รองรับ มีราคา".split()
THAI_WANTS_MORE = "ใช้ กว่า รุ่น กับ เชื่อม ของ โดย ดร. ราคา ชื่อ ที่ คือ และ หรือ จาก สำหรับ".split()

OPENERS = {"“": "”", "„": "“”", "«": "»", "‹": "›", "「": "」", "『": "』", "《": "》", "（": "）", "(": ")", "[": "]", "{": "}", "【": "】", "‘": "’"}
CLOSERS = set("”»›」』》）)]}】")
QUOTES = set("“„«‹「『\"")
WIDE_STOPS = set("。！？")
STOPS = set(".!?…。！？।॥؟‼⁇⁈⁉۔።")
EVENT = re.compile("[.!?…。！？।॥؟‼⁇⁈⁉۔።;\"“”„«»‹›「」『』《》（）()\\[\\]{}【】]")
LIST_LINE = re.compile(r"\s*(?:[-*•‣▪◦·✓✔→–]\s|\d{1,3}[.)]\s|#{1,6}\s|[a-z]\)\s)")
LABEL_LINE = re.compile(r"\s*(?:[QA]|[FR]|[PR]|В|О|Ε|Α|س|ج|问|答|問)\s?[:：]\s?\S")
END_OF_TEXT = re.compile(r"[.!?…。！？।॥؟‼⁇⁈⁉۔።;:：][\"”’“»›」』）)\]}\s️\U0001F300-\U0001FAFF☀-➿]*$")
EMOJI = re.compile(r"[\s﻿]*(?:[\U0001F000-\U0001FAFF☀-➿⬀-⯿][️‍\U0001F3FB-\U0001F3FF]*)+")
CASELESS = re.compile("[぀-ヿ㐀-鿿가-힯֐-ࣿऀ-෿฀-໿]")
CJK = re.compile("[぀-ヿ㐀-鿿]")
THAI = re.compile("[฀-๿]")
THAI_GAP = re.compile(r"\s+")


def _trie(words: list[str], kind: int, into: dict) -> dict:
    """Adds the words to a trie that is read backwards."""
    for word in words:
        node = into
        for letter in reversed(word):
            node = node.setdefault(letter, {})
        node[""] = kind
    return into


_ABBREVIATIONS = _trie(MAY_END, 1, _trie(GO_ON, 2, {}))


def abbreviation(text: str, dot: int, start: int) -> int:
    """2 if the dot belongs to an abbreviation after which a sentence goes on, 1 if it may also end one, else 0."""
    node, at, found = _ABBREVIATIONS, dot - 1, 0
    while at >= start:
        letter = text[at].lower()
        if letter.isspace() and at > start and text[at - 1] in ".-":
            at -= 1  # "z. B." and "т. д." are written with or without a blank, and may be wrapped
            continue
        node = node.get(letter)
        if node is None:
            break
        if "" in node and (at == start or not (text[at - 1].isalnum() or text[at - 1] in "-_/'’") or text[at - 1] in "'’"):
            found = max(found, node[""]) if found != 1 or len(text[at:dot]) < 3 else node[""]
        at -= 1
    if not found and dot > start and text[dot - 1].isalpha() and (dot - 1 == start or not (text[dot - 2].isalnum() or text[dot - 2] in ".'")):
        return 2  # an initial, or the first letter of several
    return found


def _word_start(text: str, start: int, end: int) -> int:
    """Where the word that ends at ``end`` starts, not before ``start``."""
    while end > start and not text[end - 1].isspace():
        end -= 1
    return end


class _Automaton:
    """Reads one stretch of running text and gives the ends of its sentences."""

    def __init__(self, text: str, start: int, stop: int):
        self.text, self.stop = text, stop
        self.begin = start  # of the sentence being read
        self.stack: list[tuple[str, int, bool, bool]] = []  # closer, place, opens the sentence, follows a colon
        self.pairs = self._pairs(start, stop)
        self.ends: list[int] = []

    def _pairs(self, start: int, stop: int) -> set[int]:
        """Places of the marks that open or close something; marks without a partner in the stretch play no part."""
        text, matched, stack = self.text, set(), []
        for found in EVENT.finditer(text, start, stop):
            at, mark = found.start(), found.group()
            if mark == '"':
                held = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == '"'), None)
                if held is None:
                    stack.append(('"', at))
                    continue
            elif any(mark in closers for closers, _ in stack):
                held = next(i for i in range(len(stack) - 1, -1, -1) if mark in stack[i][0])
            elif mark in OPENERS:
                stack.append((OPENERS[mark], at))
                continue
            else:
                continue
            matched.update((stack[held][1], at))
            del stack[held:]
        return matched

    def run(self) -> list[int]:
        at = self.begin
        while found := EVENT.search(self.text, at, self.stop):
            at = self._read(found.start(), found.group())
        return self.ends

    def _read(self, at: int, mark: str) -> int:
        if at in self.pairs:
            if self.stack and mark in self.stack[-1][0]:
                return self._close(at)
            before = self.text[self.begin : at].strip(" \t\n\xa0﻿")
            closers = '"' if mark == '"' else OPENERS[mark]
            self.stack.append((closers, at, not before or all(c in QUOTES or c in "([（" for c in before), before.endswith((":", "："))))
            return at + 1
        if mark == ";" and not ("Ͱ" <= self.text[at - 1 : at] <= "Ͽ" or "ἀ" <= self.text[at - 1 : at] <= "῿"):
            return at + 1
        if mark not in STOPS and mark != ";":
            return at + 1
        end = at + 1
        while end < self.stop and (self.text[end] in STOPS):
            end += 1
        if not self.stack and self._ends(at, end):
            return self._cut(end)
        return end

    def _cut(self, end: int) -> int:
        if emoji := EMOJI.match(self.text, end, self.stop):
            end = emoji.end()
        self.ends.append(end)
        self.begin = end
        return end

    def _next(self, end: int) -> tuple[str, bool]:
        """The first mark after ``end`` that is no blank, and whether a blank stands before it."""
        at = end
        while at < self.stop and (self.text[at].isspace() or self.text[at] == "﻿"):
            at += 1
        return self.text[at : at + 1] if at < self.stop else "", at > end

    def _ends(self, at: int, end: int) -> bool:
        text, mark = self.text, self.text[at:end]
        following, apart = self._next(end)
        if not following:
            return True
        if EMOJI.match(following):
            return True
        if mark[-1] in WIDE_STOPS:
            return True
        if following.islower():
            return False
        if mark[-1] == "…" and (len(mark) > 1 or CJK.match(following)) and not apart:
            return False
        if following in ",;:،、，；：" or (following in "—–-" and apart and not text[end:self.stop].lstrip()[1:2].isdigit()):
            return False
        if mark == ".":
            kind = abbreviation(text, at, self.begin)
            if kind == 2 and text[max(self.begin, at - 2) : at].lower() == "no" and not following.isdigit():
                kind = 0  # the answer, not the number
            if kind == 2 or (kind == 1 and (following.isdigit() or not apart and CASELESS.match(following))):
                return False
            before = text[_word_start(text, self.begin, at) : at]
            if before.isdigit() and len(before) < 3 and text[end : self.stop].lstrip().startswith(tuple(GERMAN_MONTHS)):
                return False
            if not apart:
                if before[-1:].isdigit() and following.isdigit():
                    return False
                if CASELESS.match(following):
                    return bool(CASELESS.match(before[-1:] or " ")) and not CJK.match(following)
                if following.isupper():
                    return len(before) > 1 and not before[-1:].isupper() and "." not in before[:-1].strip(".") or before.endswith(")")
                return following in QUOTES or following in "¿¡(["
            return True
        if not apart and mark in (".", "!", "?", "...", "…", "؟", "।"):
            return following.isupper() or bool(CASELESS.match(following)) or following in QUOTES or following in "¿¡(["
        return True

    def _close(self, at: int) -> int:
        _, opened, first, after_colon = self.stack.pop()
        end = at + 1
        inner = self.text[opened + 1 : at].rstrip().rstrip("”»」』\"")
        if self.stack or not inner or inner[-1] not in STOPS and not (inner[-1] == ";" and self.text[opened] in QUOTES):
            return end
        following, apart = self._next(end)
        if following and following in STOPS:
            return end
        if not following:
            return self._cut(end)
        emoji = bool(EMOJI.match(following))
        if not emoji and (following.islower() or following in ",;:،、，；：" or following in "—–-" or following in CLOSERS):
            return end
        bracket = self.text[opened] in "([（{【"
        caseless = bool(CASELESS.match(following)) or following.isdigit()
        if after_colon or emoji:
            return self._cut(end)
        if bracket:
            return self._cut(end) if first else end
        if first:
            statement = inner[-1] in ".。।…"
            return self._cut(end) if statement or not (caseless or CJK.search(inner)) else end
        return self._cut(end) if apart and following.isupper() and not CASELESS.search(inner) else end


def _thai_ends(text: str, start: int, stop: int) -> list[int]:
    """Blanks of Thai text at which a new sentence can start."""
    ends, begin = [], start
    for gap in THAI_GAP.finditer(text, start, stop):
        if gap.end() >= stop or gap.start() <= begin:
            continue
        before = text[_word_start(text, begin, gap.start()) : gap.start()]
        after = re.compile(r"\S*").match(text, gap.end(), stop).group()
        if not before or not after or before.startswith(("-", "•", "*", "#")):
            continue
        if EMOJI.match(after):
            continue
        if EMOJI.match(before) and EMOJI.match(before).end() == len(before):
            cut = True
        elif after[0].isdigit() or re.match(r"v\d", after) or after.startswith(tuple(THAI_GOES_ON)) or before.endswith(tuple(THAI_WANTS_MORE)):
            cut = False
        elif re.fullmatch(r"[v\d.,%]+", before) and not before.endswith((".", "!")) or not THAI.search(before + after) and before[-1] not in ".!?…":
            cut = _name_starts(text, begin, gap.start(), gap.end(), stop) if not before[-1:].isdigit() else False
        elif not THAI.search(after):  # a name after Thai words starts a sentence if it is what the sentence is about
            cut = bool(re.compile(r"(?:[A-Z][\w-]*\s){1,3}เป็น").match(text, gap.end(), stop))
        else:
            cut = True
        if cut:
            ends.append(gap.start())
            begin = gap.end()
    return ends


@lru_cache(8)
def _subjects(text: str) -> Counter:
    """How often a name of one or two words is what a Thai text speaks of, counted once for each text."""
    return Counter(m.group(1) for n in (0, 1) for m in re.finditer(rf"(?<!\S)(?=([A-Z][\w-]*(?: [A-Z][\w-]*){{{n}}}) (?:แล้ว|เป็น))", text))


def _name_starts(text: str, begin: int, end: int, at: int, stop: int) -> bool:
    """Whether the name at ``at``, right after another name, begins a sentence about itself."""
    ahead = re.compile(r"((?:[A-Z][\w-]*\s){1,2})เป็น").match(text, at, stop)
    behind = re.search(r"กว่า\s+((?:[A-Z][\w-]*\s?)+)$", text[begin:end])
    if not ahead or not behind:
        return False
    name = ahead.group(1).strip()
    return _subjects(text)[name] > 1 or len(name.split()) == 2 or len(behind.group(1).split()) == 2


def _stretches(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, stop, whole): stretches of text no sentence leaves; ``whole`` ones are units as they are.

    A stack holds the indents of the list items that are open. An item begins at its marker and takes in the unmarked lines
    that are indented more deeply; items of no deeper indent, and lines that are not, close it.
    """
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, at + len(line)))
        at += len(line) + 1
    block: list[tuple[int, int]] = []
    levels: list[int] = []
    item: tuple[int, int] | None = None
    for start, stop in [*lines, (at, at)]:
        raw = text[start:stop]
        line = raw.strip().strip("﻿").strip()
        listed = bool(line) and bool(LIST_LINE.match(line + " "))
        labelled = bool(LABEL_LINE.match(line))
        indent = len(raw) - len(raw.lstrip())
        if item and line and not listed and not labelled and indent > levels[-1]:
            item = (item[0], stop)
            continue
        if item:
            yield *item, True
            item = None
        while levels and (not listed or levels[-1] >= indent):
            levels.pop()
        if not line or listed or labelled:
            yield from _block(text, block)
            block = []
        if listed:
            levels.append(indent)
            item = (start, stop)
        elif line:
            block.append((start, stop))
    yield from _block(text, block)


def _joins(text: str, block: list[tuple[int, int]]) -> list[bool]:
    """For each line break in a block, whether wrapping made it: the line had no room for the next line's first word.

    The width is that of the longest line, with some slack, as wrapping counts odd blanks and hyphens differently. No break
    is of that kind where lines are far longer or shorter than wrapped ones, where most of the letters need no blanks, or
    where the last line does not end as text does.
    """
    lines = [text[a:b].strip(" \t\ufeff") for a, b in block]
    width = max(map(len, lines))
    apart = [False] * (len(lines) - 1)
    if len(lines) < 2 or not 25 <= width <= 110 or len(CJK.findall("".join(lines))) * 4 > sum(map(len, lines)):
        return apart
    if not END_OF_TEXT.search(lines[-1].rstrip()) and not THAI.search(lines[-1]):
        return apart
    full = [len(x) + 1 + len(y.split(" ")[0]) > 0.8 * width for x, y in zip(lines, lines[1:])]
    open_ones = [f for f, x in zip(full, lines) if not END_OF_TEXT.search(x.rstrip())]
    return full if sum(open_ones) * 5 >= len(open_ones) * 3 else apart


def _block(text: str, block: list[tuple[int, int]]) -> Iterator[tuple[int, int, bool]]:
    if not block:
        return
    begin = block[0][0]
    for (_, stop), (start, _), joined in zip(block, block[1:], _joins(text, block)):
        if not joined:
            yield begin, stop, False
            begin = start
    yield begin, block[-1][1], False


def sentence_offsets(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence unit in code points, without blanks and byte-order marks around it."""
    units = []
    for start, stop, whole in _stretches(text):
        ends = [] if whole else _Automaton(text, start, stop).run()
        if not whole and THAI.search(text, start, stop):
            ends = sorted({*ends, *_thai_ends(text, start, stop)})
        begin = start
        for end in [*ends, stop]:
            a, b = begin, end
            while a < b and (text[a].isspace() or text[a] == "﻿"):
                a += 1
            while b > a and (text[b - 1].isspace() or text[b - 1] == "﻿"):
                b -= 1
            if a < b:
                units.append((a, b))
            begin = max(begin, end)
    return units


def _units_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, starts, ends = [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            for a, b in sentence_offsets(text):
                ids.append(i)
                starts.append(a)
                ends.append(b)
        keys = batch.column(0).take(pa.array(np.array(ids, dtype=np.int64)))
        yield pa.RecordBatch.from_arrays([keys, pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["key", "start_pos", "end_pos"])


def split_sentences(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, start_pos, end_pos): the sentence units of every document, as offsets in code points.

    Null and blank texts give no rows. Repeated rows give their units once for each repeat of the key; texts of any length
    are read whole. Other columns are not read. An empty table gives no rows.
    """
    let_workers_import(documents.sparkSession)
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    kind = rows.schema["key"].dataType.simpleString()
    spread = rows.repartition(max(parallelism(rows.sparkSession), 2 * rows.sparkSession.sparkContext.defaultParallelism))
    return spread.mapInArrow(_units_of, f"key {kind}, start_pos int, end_pos int").withColumnRenamed("key", key)


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return split_sentences(table(spark, root, "documents"), "doc_id", "text").distinct()


def p9_units_by_kind(spark: SparkSession, root: str) -> DataFrame:
    """How many units and how long units the documents of each kind have."""
    units = split_sentences(table(spark, root, "documents"), "doc_id", "text")
    documents = table(spark, root, "documents").select("doc_id", "kind")
    length = F.col("end_pos") - F.col("start_pos")
    return units.join(documents, "doc_id").groupBy("kind").agg(F.count("*").alias("units"), F.avg(length).alias("mean_length"), F.max(length).alias("longest"))


QUERIES = {"p9_found": p9_found, "p9_units_by_kind": p9_units_by_kind}
ORACLES: dict[str, str] = {}
