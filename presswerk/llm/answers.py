"""Broken prompt and response pairs (problem 3): each answer gets at most one kind of defect.

A pushdown parser follows fences, brackets, quotations, list items and markup to see whether an answer ends complete;
greedy string tiling measures how much of the answer is tiled by the article's title or story lines; function words
and scripts give its language; a small grammar of refusals covers answers that decline.
"""

from __future__ import annotations

import json
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswerk.llm.blocks import STOP_WORDS, STORY, PublisherNames, has_text, label_lines, publisher_names
from presswerk.llm.filters import asked_for
from presswerk.session import read_table

MIN_TILE = 4
COPY_COVERAGE = 0.95
#: Texts of so many words and more have at least this share of function words of their language (sf0.1, 4,767 sound answers: 0.2 or more).
MIN_LANGUAGE_WORDS, MIN_FUNCTION_SHARE = 8, 0.15
#: Kinds of defects, the one that counts where several hold first.
PRECEDENCE = ("empty", "refusal", "copy", "language", "truncated")

_LABEL = re.compile(r"^\W{0,3}(?:summary|abstract|answer|response|output|title|headline|résumé|zusammenfassung|resumen|riassunto|resumo)\s*[:\-–—]\s*", re.I)
_PLACEHOLDERS = frozenset("none null nil nan na n/a n.a. empty (empty) tbd todo undefined unknown blank - -- — … ... .".split() + ["no summary", "no answer", "not available", "no content", "n / a", "to be completed", "summary", "lorem ipsum"])
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
_TOKEN = re.compile(r"[^\W_]+")

# Function words that tell the six languages apart.
_FUNCTION_WORDS = {
    "en": "the of and to in that for on with by from was were said their would who is are has have been after while about heard not this",
    "fr": "le les des du et dans pour sur que qui ne est ont été cette après tandis selon une aux avec par son",
    "de": "der die das den und im von mit für nicht sich nach wegen einen eine dem über zu ein wurden sagte",
    "es": "el los las del y por con según mientras hasta tras una un su que en ha",
    "it": "il gli di della dei nel non ha che dopo secondo mentre una un per hanno alla è si sono",
    "pt": "o os um uma do da dos das no na ao em com não que após segundo enquanto pela se",
}
_BY_WORD: dict[str, list[str]] = {}
for _code, _words in _FUNCTION_WORDS.items():
    for _word in _words.split():
        _BY_WORD.setdefault(_word, []).append(_code)

# Further function words of English, to tell it from languages that no list here knows.
_COMMON = {
    "en": frozenset(_FUNCTION_WORDS["en"].split())
    | frozenset("a an at as it its he she they we you i his her our your my be but or if than then there here before later against without within between behind through under out up down into during each every all any some other more most no nor so such only own same too very can will just should could may might must both when where why how what which these those ahead again off until since because despite following further two one three".split())
}

# The grammar of refusals: an answerer that speaks of itself, or an answer spoken of as a thing, with a negation.
_SELF = r"(?:i|we|me|my|i['’]m|i['’]d|i['’]ve)"
_CANNOT = r"(?:can\s?not|can['’]t|could not|couldn['’]t|won['’]t|will not|(?:am|are|is|be) (?:not able|unable)|not be able|unable|must decline|decline|declined|have to decline|would rather not|(?:would|['’]d) prefer|(?:do not|don['’]t|cannot|won['’]t) (?:feel|want|take part)|refuse)"
_LACK = r"(?:have no|do(?: not|n['’]t) have|lack|without|not? (?:given|provided))\s+(?:any\s+)?(?:access|enough|sufficient|the (?:text|article)|information|permission)"
_TASK = r"(?:summar\w+|abstract|answer\w*|respon\w+|request\w*|paragraph|text|article|story|piece|material|content|process\w*|comply|help\w*|assist\w*|produce\w*|write|writ\w+|discuss\w*|matters?|subject|unanswered)"
_REFUSALS = [
    re.compile(rf"\b{_SELF}\b[^.!?]{{0,60}}\b{_CANNOT}\b[^.!?]{{0,80}}\b{_TASK}\b"),
    re.compile(rf"\b{_SELF}['’]?(?:d|m)?\b[^.!?]{{0,30}}{_CANNOT}[^.!?]{{0,40}}\b(?:that|this|it)\b"),
    re.compile(rf"\b{_SELF}\b[^.!?]{{0,40}}\b{_LACK}"),
    re.compile(r"\bit is not possible for me\b|\b(?:impossible|not allowed|not permitted) (?:for me )?to (?:write|produce|answer|summar\w+)"),
    re.compile(rf"\bno (?:summary|answer|response|paragraph|abstract)\b[^.!?]{{0,40}}\b(?:was|is|has been|can be|could be|will be|is being)?\s?(?:given|offered|produced|provided|possible|available|written)\b"),
    re.compile(rf"\b(?:summary|answer|response|material|text|article|request|piece|content)\b[^.!?]{{0,40}}\b(?:cannot|can['’]t|could not|must not|may not) be (?:summar\w+|written|answered|processed|given|produced|fulfilled)"),
    re.compile(r"\b(?:summary|answer|response)\b[^.!?]{0,20}\b(?:is|was|has been) (?:omitted|withheld|declined|refused)\b"),
    re.compile(rf"\b(?:outside|beyond|against|violat\w+)\b[^.!?]{{0,30}}\b(?:what i am|my|our|usage|the) (?:allowed|guidelines|rules|policy|policies|permitted|scope|usage)"),
    re.compile(r"\bas (?:a|an) (?:\w+ ){0,2}(?:assistant|model|ai)\b"),
]
_QUOTED = re.compile(r"[“„«][^“”„«»]{0,600}[”“»]|\"[^\"]{0,600}\"")


class Ending:
    """Result of the pushdown parser: what was left open, and whether the last sentence ended."""

    def __init__(self, open_marks: list[str], ended: bool, listed: bool):
        self.open_marks, self.ended, self.listed = open_marks, ended, listed

    @property
    def truncated(self) -> bool:
        return bool(self.open_marks) or not (self.ended or self.listed)


_CLOSERS = {")": "(", "]": "[", "}": "{"}
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*)?(/?)>")
_VOID_TAGS = frozenset("br hr img input meta link".split())
_ITEM = re.compile(r"[ \t]*(?:[-*•]|\d{1,3}[.)])[ \t]+(?=\S)")
ITEM = "item"


def parse_ending(text: str) -> Ending:
    """Follow brackets, quotations, code fences, tags and list items with a stack; look at how the text ends outside of them.

    An item opens at its mark and is closed by the next one or by a blank line; one left open at the end must be complete.
    """
    stack: list[str] = []
    items: list[str] = []
    i, n, begin = 0, len(text), -1
    while i < n:
        c = text[i]
        top = stack[-1] if stack else ""
        if (i == 0 or text[i - 1] == "\n") and top != "```":
            mark = _ITEM.match(text, i)
            blank = c == "\n"
            if (mark or blank) and begin >= 0:
                items.append(text[begin:i])
                begin = -1
                if blank:
                    items = []
            if mark:
                begin = i = mark.end()
                continue
        if text.startswith("```", i):
            stack.pop() if top == "```" else stack.append("```")
            i += 3
            continue
        if top == "```":
            i += 1
            continue
        if c == "<" and (tag := _TAG.match(text, i)):
            name = tag[2].lower()
            if tag[1]:
                if f"<{name}>" in stack:
                    while stack.pop() != f"<{name}>":
                        pass
            elif not tag[3] and name not in _VOID_TAGS:
                stack.append(f"<{name}>")
            i = tag.end()
            continue
        if c in "([{":
            stack.append(c)
        elif c in _CLOSERS:
            if _CLOSERS[c] in stack:
                while stack.pop() != _CLOSERS[c]:
                    pass
        elif c in "„«" or (c == "“" and top not in ("„", "“")):
            stack.append(c)
        elif c in "”»“":
            if any(x in "“„«" for x in stack if len(x) == 1):
                while stack and stack.pop() not in ("“", "„", "«", '"'):
                    pass
        elif c == '"':
            quotes = [k for k, x in enumerate(stack) if x in ('"', "“", "„", "«")]
            if quotes:
                del stack[quotes[-1] :]
            else:
                stack.append(c)
        i += 1
    if begin >= 0:
        items.append(text[begin:])
    else:
        items = []
    ended = _ended(text)
    # A quotation that is still open at a full stop may continue in a later paragraph; one cut off before is open.
    left = [x for x in stack if x not in ("“", "„", "«", '"')] if ended else stack
    closed = bool(items) and not left and _items_closed(items)
    return Ending([*left, ITEM] if items and not (ended or closed) else left, ended, closed)


def _ended(text: str) -> bool:
    """Whether the last sentence is complete, whatever closes behind it."""
    bare = text.rstrip()
    while bare and bare[-1] in "”\"’'»“)]}*_`  ":
        bare = bare[:-1].rstrip()
    if bare.endswith(">"):
        bare = re.sub(r"(?:<[^<>]*>\s*)+$", "", bare).rstrip()
    return bool(bare) and bare[-1] in ".!?" and not bare.endswith("...")


def _items_closed(items: list[str]) -> bool:
    """Whether the last item of a list, which does not end a sentence, is complete as the items before it are.

    Items that are sentences must all end; items that are labels must not stop at a word that calls for another one.
    """
    if len(items) < 2 or any(_ended(x) for x in items[:-1]):
        return False
    words = _TOKEN.findall(items[-1].casefold())
    return bool(words) and words[-1] not in STOP_WORDS and items[-1].rstrip()[-1] not in ",;:-–—("


def tiles(answer: list[str], source: list[str], min_tile: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: longest common token runs first, none overlapping; (answer start, source start, length)."""
    if len(answer) < min_tile or len(source) < min_tile:
        return []
    where: dict[tuple, list[int]] = {}
    for j in range(len(source) - min_tile + 1):
        where.setdefault(tuple(source[j : j + min_tile]), []).append(j)
    matches = []
    for i in range(len(answer) - min_tile + 1):
        for j in where.get(tuple(answer[i : i + min_tile]), ()):
            if i and j and answer[i - 1] == source[j - 1]:
                continue  # inside a longer run that began before
            k = min_tile
            while i + k < len(answer) and j + k < len(source) and answer[i + k] == source[j + k]:
                k += 1
            matches.append((k, i, j))
    matches.sort(key=lambda x: (-x[0], x[1], x[2]))
    used_a, used_s, out = bytearray(len(answer)), bytearray(len(source)), []
    for k, i, j in matches:
        while k and (used_a[i] or used_s[j]):
            i, j, k = i + 1, j + 1, k - 1
        m = 0
        while m < k and not used_a[i + m] and not used_s[j + m]:
            m += 1
        if m >= min_tile:
            used_a[i : i + m] = b"\1" * m
            used_s[j : j + m] = b"\1" * m
            out.append((i, j, m))
    return out


def language_of(text: str, wanted: str = "en") -> str:
    """Code of the language most of the function words belong to; 'xx' for another script or tongue, '' without evidence.

    Running text of one of the six languages has its function words in number, so a longer text with hardly any of
    `wanted` is in another language even if no list knows it.
    """
    letters = [c for c in text if c.isalpha()]
    if letters and sum(ord(c) > 0x24F for c in letters) > len(letters) / 2:
        return "xx"
    scores = dict.fromkeys(_FUNCTION_WORDS, 0)
    words = _TOKEN.findall(text.lower())
    for word in words:
        for code in _BY_WORD.get(word, ()):
            scores[code] += 1
    best = max(scores, key=lambda c: (scores[c], c == wanted))
    common = _COMMON.get(wanted) or frozenset(_FUNCTION_WORDS[wanted].split())
    if best == wanted and len(words) >= MIN_LANGUAGE_WORDS and sum(w in common for w in words) < MIN_FUNCTION_SHARE * len(words):
        return "xx"
    return best if scores[best] else ""


def bare_answer(text: str) -> str:
    """The answer without a label, a JSON wrapping that parses, and white space around."""
    text = unicodedata.normalize("NFC", text).strip()
    if text.startswith("{"):
        try:
            value = json.loads(text)
        except ValueError:
            value = None
        if isinstance(value, dict):
            return "\n".join(str(v) for v in value.values() if v).strip()
    return _LABEL.sub("", text).strip()


def is_refusal(text: str) -> bool:
    plain = _QUOTED.sub(" ", text).strip()
    if len(_TOKEN.findall(plain)) < 4:
        plain = text
    low = re.sub(r"\s+", " ", plain.lower())
    return any(x.search(low) for x in _REFUSALS)


def _squeezed(text: str) -> str:
    return "".join(_TOKEN.findall(text.casefold()))


def is_copy(answer: str, title: str | None, content: str | None, names: PublisherNames) -> bool:
    """Whether the title, or a stretch of the story lines, makes up the whole answer."""
    words = _TOKEN.findall(answer.casefold())
    if not words:
        return False
    if title and has_text(title) and _squeezed(title) == "".join(words):
        return True
    if not has_text(content):
        return False
    low = content.casefold()
    # A copy has its words in the article; look at three runs of them before tiling.
    spots = {0, max(0, len(words) // 2 - 1), max(0, len(words) - 3)}
    flat = " ".join(_TOKEN.findall(low)) if any(words[s] in low for s in spots) else ""
    if sum(" ".join(words[s : s + 3]) in flat for s in spots) < min(2, len(spots)):
        return False
    lines = content.split("\n")
    story = "\n".join(x for x, k in zip(lines, label_lines(lines, names), strict=True) if k == STORY)
    source = _TOKEN.findall(story.casefold())
    found = tiles(words, source, min(MIN_TILE, len(words)))
    # The first and last word of a stretch may have been cut.
    if sum(t[2] for t in found) < min(COPY_COVERAGE * len(words), len(words) - 2 if len(words) >= 20 else len(words)):
        return False
    found.sort()
    return all(b[1] >= a[1] for a, b in zip(found, found[1:], strict=False))


def defect_of(answer: str | None, title: str | None, content: str | None, names: PublisherNames, language: str = "en") -> str | None:
    """The answer's defect: empty, refusal, copy, language, truncated, in this order of precedence, or None."""
    text = bare_answer(answer or "")
    core = text.strip(" \t\n\r \"'“”‘’«»()[]{}<>*_`-–—.…:;,|#=~").casefold()
    if not core or text.casefold() in _PLACEHOLDERS or core in _PLACEHOLDERS:
        return "empty"
    if is_refusal(text):
        return "refusal"
    if is_copy(text, title, content, names):
        return "copy"
    if language_of(text, language) not in ("", language):
        return "language"
    return "truncated" if parse_ending(text).truncated else None


def _judge_batches(names: list[str], language: str):
    def run(batches):
        finder = PublisherNames(names)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            found = [(key, kind) for key, answer, title, content in zip(*columns, strict=True) if (kind := defect_of(answer, title, content, finder, language))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string())], names=["id", "defect"])

    return run


def find_defects(answers: DataFrame, articles: DataFrame, sources: DataFrame, language: str = "en", id_col: str = "id", key_col: str = "article_id", text_col: str = "summary_fr", article_id_col: str = "id", title_col: str = "title", content_col: str = "content") -> DataFrame:
    """Rows (id, defect), one for each defective answer.

    A null answer is empty; an answer without its article is judged without the copy check; null ids give no rows;
    repeated rows of an answer or an article count once; extra columns are ignored, whatever their names; empty
    tables give an empty result. Texts are read whole.
    """
    left = answers.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(key_col).alias("key"), F.col(text_col).alias("answer"))
    right = articles.where(F.col(article_id_col).isNotNull()).select(F.col(article_id_col).alias("key"), F.col(title_col).alias("title"), F.col(content_col).alias("content"))
    # Articles without an answer stay where they are.
    right = asked_for(right, left.select("key").where("key is not null"), "key")
    joined = left.join(right, "key", "left").select("id", "answer", "title", "content")
    judged = joined.mapInArrow(_judge_batches(publisher_names(sources), language), "id long, defect string")
    # An answer may meet several versions of its article; the first kind in the order of precedence counts.
    place = F.array_position(F.array(*[F.lit(x) for x in PRECEDENCE]), F.col("defect"))
    return judged.groupBy("id").agg(F.min_by("defect", place).alias("defect"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_defects(read_table(spark, sf_dir, "article_summaries"), read_table(spark, sf_dir, "articles"), read_table(spark, sf_dir, "sources"))
