"""Keyword-stuffed and link-list pages (problem 10), by mean pointwise mutual information of neighbouring words.

Stretches of a page, its lines and sentences, are spam if they consist of links, tags, excessively repeated collocations
or incoherent words; a page is spam if more than two thirds of its words stand in such stretches. A first pass counts all
words and neighbouring pairs exactly. The second judges the pages; every sentence that is not spam already is open to the
test of coherence. The most frequent words and pairs, a table of bounded size, give a lower bound of a stretch's mean;
stretches that it leaves in doubt, on pages that depend on them, get their exact counts by a join. Pairs that no other
page holds have a smoothed value and so lower the mean.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswerk.llm.blocks import STOP_WORDS
from presswerk.llm.words import WORD, WordHashes, mix
from presswerk.session import cut_lineage, read_table

#: Most words and pairs whose counts every task gets; those of the others are joined where they matter.
MAX_KNOWN = 1 << 17
#: Hashes that are counted at once.
COUNTED_AT_ONCE = 1 << 20
MIN_SHARE = 2 / 3
#: Mean smoothed PMI, the page itself left out. Measured on sf0.01 and sf0.1: random words of any frequency have at most
#: 0.7, 99 of 100 stretches of them at most 0.11; 99.5 of 100 sentences of eight words or more have at least 0.65 and 1.91,
#: 95 of 100 of those with few function words at least 0.79 and 1.85.
MIN_MEAN_PMI = 0.5
#: Added to the count of a pair and to the count expected of independent words.
SMOOTHING = 0.5
#: Words that coherence is judged on; shorter sentences are judged together with those next to them.
MIN_RUN = 8
#: Sentences with this share of function words, and runs of short ones, are incoherent only if at least half of their other
#: words occur so often on other pages: a corpus that hardly knows the words of a told sentence cannot know their pairs.
#: Measured on docstrings of Python (250, 600, 2,000 and 3,481 pages, with 20 pages of their words in random order): of such
#: sentences 95 % have a mean of at least 0.10, 0.16, 0.31 and 0.38, of the random ones 95 % at most 0.09. Chosen on these pages.
MIN_STOP_SHARE, MIN_ELSEWHERE, MIN_TOLD_PMI = 0.12, 8, 0.1
MIN_REPEATS = 3
MIN_REPEATED_SHARE = 0.3
MIN_PAGE_WORDS = 12
#: Stuffed sentences have over half of their words in repeated collocations and a small vocabulary (log types over log words).
MAX_REPEATED_PROSE = 0.5
MIN_VARIETY = 0.81

_LINK = re.compile(r"(?:https?://|www\.)\S+|\b[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}/\S*|\b[\w-]+(?:\.[\w-]+)+\b(?=\s|$|[|,;])", re.I)
_TAG = re.compile(r"(?<!\w)[#+@][^\W\d][\w-]*|\btags?:\s*\w[\w-]*", re.I)
_DOTTED = re.compile(r"\w\.[a-zA-Z]")
_SPLIT = re.compile(r"\n+|(?<=[.!?…])[\"”»“’)]*\s+(?=[\"“„«»A-ZÀ-Þ•*-])")
_ENDED = re.compile(r"[.!?…][\"'”»“’)\]]*\s*$")
_STOP_HASHES = WordHashes().array(sorted(STOP_WORDS))


def _marks(stretch: str) -> list[str]:
    """Links and tags of a stretch; most stretches have not even a character of one."""
    found = []
    if "://" in stretch or "/" in stretch or _DOTTED.search(stretch):
        found += [m.group(0) for m in _LINK.finditer(stretch)]
    if "#" in stretch or "+" in stretch or "@" in stretch or "tag" in stretch or "TAG" in stretch or "Tag" in stretch:
        found += [m.group(0) for m in _TAG.finditer(stretch)]
    return found


def _pair(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])


class Counts:
    """Counts of hashed words and pairs, sorted by key; those of fewer than `floor` occurrences may be missing."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, total: int, floor: int = 1):
        order = np.argsort(keys)
        self.keys, self.n, self.total, self.floor = keys[order], n[order].astype(float), total, floor

    def of(self, keys: np.ndarray, missing: int) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), float(missing))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.n[at], float(missing))


def _own(keys: np.ndarray, page: np.ndarray) -> np.ndarray:
    """How often the page itself holds the keys."""
    page = np.sort(page)
    return np.searchsorted(page, keys, "right") - np.searchsorted(page, keys)


def mean_pmi(page: np.ndarray, stretches: list[np.ndarray], counts: Counts) -> np.ndarray:
    """Mean smoothed PMI of the pairs of each stretch, the page itself left out; a lower bound if counts are missing."""
    joined = np.concatenate(stretches)
    starts = np.cumsum([0, *map(len, stretches)])
    pairs, words = _pair(joined), counts.of(joined, counts.floor - 1)
    elsewhere = np.maximum(counts.of(pairs, 0) - _own(pairs, _pair(page)), 0)
    pmi = np.log((elsewhere + SMOOTHING) / (words[:-1] * words[1:] / max(1, counts.total) + SMOOTHING))
    pmi[starts[1:-1] - 1] = 0  # from one stretch to the next
    return np.add.reduceat(pmi, starts[:-1]) / (np.diff(starts) - 1)


def incoherent(page: np.ndarray, stretches: list[np.ndarray], told: list[bool], counts: Counts) -> list[bool]:
    """Which stretches of a page are incoherent, or may be if counts are missing; `told` are those of told text."""
    low = (mean_pmi(page, stretches, counts) < np.where(told, MIN_TOLD_PMI, MIN_MEAN_PMI)).tolist()
    for i, x in enumerate(stretches):
        if low[i] and told[i]:
            words = x[~np.isin(x, _STOP_HASHES)]
            known = counts.of(words, counts.floor - 1) - _own(words, page) >= MIN_ELSEWHERE
            low[i] = len(words) > 0 and bool(2 * known.sum() >= len(words))
    return low


class PageJudge:
    """Words of a page that stand in links or tags or in repeated collocations, and stretches that coherence decides on."""

    def _stuffed(self, sentences: list[list[str]]) -> list[bool]:
        """Which sentences are spam, made of collocations the page repeats.

        Texts that come back to one subject repeat it too, but between its mentions their words vary.
        """
        words = [w for x in sentences for w in x]
        if len(words) < MIN_PAGE_WORDS:
            return [False] * len(sentences)
        if math.log(len(set(words))) / math.log(len(words)) >= MIN_VARIETY:
            return [False] * len(sentences)
        counts = Counter(pair for x in sentences for pair in zip(x, x[1:], strict=False))
        covered = []
        for x in sentences:
            inside = [False] * len(x)
            for i, pair in enumerate(zip(x, x[1:], strict=False)):
                if counts[pair] >= MIN_REPEATS:
                    inside[i] = inside[i + 1] = True
            covered.append(sum(inside))
        stuffed = sum(covered) > MAX_REPEATED_PROSE * len(words)
        return [stuffed and 4 * n >= len(x) for x, n in zip(sentences, covered, strict=True)]

    def _runs(self, sentences: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Sentences (number, words) as runs of `MIN_RUN` words or more, from number to number; a shorter one goes with its
        neighbours, if it has any."""
        runs: list[tuple[int, int]] = []
        first, size, after, joined = 0, 0, -1, False  # the sentences from `first` to `after` wait for more words
        for k, n in [*sentences, (-2, 0)]:
            if k != after:
                if size and joined:
                    runs[-1] = runs[-1][0], after
                first, size, joined = k, 0, False
            size, after = size + n, k + 1
            if size >= MIN_RUN:
                runs.append((first, after))
                first, size, joined = after, 0, True
        return runs

    def spam_words(self, text: str) -> tuple[int, list[str], list[slice], list[slice]]:
        """How many words are spam, all words, and where those stretches are that are spam besides if incoherent.

        The latter are given in two lists, the second for told text: sentences with function words, and short ones.
        """
        stretches = [x for x in _SPLIT.split(text) if x and x.strip()]
        tokens = [WORD.findall(x.lower()) for x in stretches]
        total = sum(map(len, tokens))
        if not total:
            return 0, [], [], []
        everything = list(chain.from_iterable(tokens))
        starts = list(accumulate(map(len, tokens), initial=0))
        listed: list[int] = []
        prose: list[int] = []
        spam = 0
        for k, (stretch, words) in enumerate(zip(stretches, tokens, strict=True)):
            if not words:
                continue
            marks = _marks(stretch)
            if marks and 2 * sum(len(WORD.findall(m)) for m in marks) >= len(words):
                spam += len(words)
            elif _ENDED.search(stretch) and len(words) >= 2:
                prose.append(k)
            else:
                listed.append(k)
        if total < MIN_PAGE_WORDS:
            return spam, everything, [], []  # so few words can be links or tags, but neither repeat themselves nor cohere
        stuffed = self._stuffed([tokens[k] for k in prose])
        spam += sum(len(tokens[k]) for k, x in zip(prose, stuffed, strict=True) if x)
        open_: list[slice] = []
        told: list[slice] = []
        for first, after in self._runs([(k, len(tokens[k])) for k, x in zip(prose, stuffed, strict=True) if not x and not all(map(str.isdigit, tokens[k]))]):
            run = slice(starts[first], starts[after])
            short = all(len(x) < MIN_RUN for x in tokens[first:after])
            (told if short or sum(map(STOP_WORDS.__contains__, everything[run])) >= MIN_STOP_SHARE * (run.stop - run.start) else open_).append(run)
        seen = Counter(w for k in listed for w in tokens[k])
        for k in listed:
            words = [w for w in tokens[k] if not w.isdigit() and w not in STOP_WORDS]
            if not words:
                continue
            repeated = sum(seen[w] >= MIN_REPEATS for w in words) / len(words)
            if repeated >= MIN_REPEATED_SHARE:
                if len(tokens[k]) >= 7 and 2 * repeated < 1 + MIN_REPEATED_SHARE and sum(w in STOP_WORDS for w in tokens[k]) >= 0.2 * len(tokens[k]):
                    open_.append(slice(starts[k], starts[k + 1]))  # a headline, if coherent
                else:
                    spam += len(tokens[k])
            elif len(words) >= MIN_RUN:
                open_.append(slice(starts[k], starts[k + 1]))
        return spam, everything, open_, told


def _doubtful(page: np.ndarray, stretches: list[np.ndarray], told: list[bool], counts: Counts, least: float | None) -> list[int]:
    """The stretches that may be incoherent; none if these have no more than `least` words."""
    lengths = [len(x) for x in stretches]
    left, doubtful, split = sum(lengths), [], 0
    if least is not None:  # first as many stretches as settle the page if they cohere
        split = int(np.searchsorted(np.cumsum(lengths), left - least)) + 1
    for at, part in ((0, stretches[:split]), (split, stretches[split:])):
        if not part:
            continue
        for i, low in enumerate(incoherent(page, part, told[at : at + len(part)], counts), at):
            if low:
                doubtful.append(i)
            else:
                left -= lengths[i]
        if least is not None and left <= least:
            return []
    return doubtful


def _judge_batches(counts, min_share):
    """mapInArrow over (key, text) -> (doc_id, spam, words, page, stretches, told); with `min_share` only stretches that can matter."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("spam", pa.int64()), ("words", pa.int64()), ("page", longs), ("stretches", pa.list_(longs)), ("told", pa.list_(pa.bool_()))])

    def run(batches):
        judge, cache = PageJudge(), WordHashes()
        keys, n, total_words, floor = counts.value
        known = Counts(np.frombuffer(keys, np.uint64), np.frombuffer(n, np.int64), total_words, floor)
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                spam, words, open_, told = judge.spam_words(text)
                least = None if min_share is None else min_share * len(words) - spam
                page, stretches, flags = [], [], []
                if (open_ or told) and (least is None or 0 <= least < sum(x.stop - x.start for x in open_ + told)):
                    whole = cache.array(words)
                    arrays, of_told = [whole[x] for x in open_ + told], [False] * len(open_) + [True] * len(told)
                    for i in _doubtful(whole, arrays, of_told, known, least):
                        stretches.append(arrays[i].view(np.int64).tolist())
                        flags.append(of_told[i])
                    page = whole.view(np.int64).tolist() if stretches else []
                out.append((key, spam, len(words), page, stretches, flags))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(schema.types)], schema=schema)

    return run


def _key_batches(batches):
    """(doc_id, stretches) -> (doc_id, key): the words and pairs of a page's stretches."""
    for batch in batches:
        ids, keys = [], []
        for doc_id, stretches in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            joined = np.concatenate([np.array(x, np.int64).view(np.uint64) for x in stretches])
            own = np.unique(np.concatenate([joined, _pair(joined)])).view(np.int64)
            ids.append(np.full(len(own), doc_id, np.int64))
            keys.append(own)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids or [np.empty(0, np.int64)])), pa.array(np.concatenate(keys or [np.empty(0, np.int64)]))], names=["doc_id", "key"])


def _count_batches(batches):
    """(text) -> (key, n): counts of the words and pairs; all words under key 0."""
    cache = WordHashes()

    def counted(parts, total):
        keys, n = np.unique(np.concatenate(parts or [np.empty(0, np.uint64)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(np.append(keys.view(np.int64), 0)), pa.array(np.append(n, total).astype(np.int64))], names=["key", "n"])

    parts, waiting, total = [], 0, 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            hashes = cache.array(WORD.findall(text.lower()))
            parts += [hashes, _pair(hashes)] if len(hashes) > 1 else [hashes]
            waiting, total = waiting + 2 * len(hashes), total + len(hashes)
            if waiting >= COUNTED_AT_ONCE:
                yield counted(parts, total)
                parts, waiting, total = [], 0, 0
    yield counted(parts, total)


def _settle_batches(total):
    """(doc_id, page, stretches, told, keys, counts) -> (doc_id, more): words in incoherent stretches."""

    def run(batches):
        for batch in batches:
            ids, more = [], []
            for doc_id, page, stretches, told, keys, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                arrays = [np.array(x, np.int64).view(np.uint64) for x in stretches]
                low = incoherent(np.array(page, np.int64).view(np.uint64), arrays, told, Counts(np.array(keys, np.int64).view(np.uint64), np.array(n), total))
                ids.append(doc_id)
                more.append(sum(len(x) for x, y in zip(arrays, low, strict=True) if y))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(more, pa.int64())], names=["doc_id", "more"])

    return run


def _known_counts(counts: DataFrame) -> tuple[bytes, bytes, int, int]:
    """The counts of at most `MAX_KNOWN` of the most frequent keys, all words, and the least count from which on none is missing.

    Keys that occur once are left out always: a page's own pairs are not counted, so these say nothing.
    """
    sizes = counts.where("key != 0 and n > 1").groupBy(F.floor(4 * F.log2("n")).alias("size")).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("keys")).orderBy(F.desc("size")).collect()  # four a doubling
    floor, room = sizes[0].most + 1 if sizes else 2, MAX_KNOWN
    for x in sizes:
        room -= x["keys"]
        if room < 0:
            break
        floor = x.least
    if sizes and room >= 0:
        floor = 2
    total = counts.where("key = 0").agg(F.sum("n")).first()[0] or 0
    known = counts.where((F.col("key") != 0) & (F.col("n") >= floor)).toArrow()
    return known["key"].to_numpy().tobytes(), known["n"].to_numpy().tobytes(), total, floor


def spam_shares(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_share: float | None = None) -> DataFrame:
    """Rows (doc_id, spam_share, words) for every document with text.

    Null ids and null texts give no rows, an empty text has share 0; repeated rows give the same row once; extra
    columns are ignored; an empty table gives an empty result. Texts are read whole. With `min_share` the share is right
    only as to whether it is larger, and coherence is looked at only where that depends on it.
    """
    rows = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts = cut_lineage(rows.select("text").mapInArrow(_count_batches, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "spam-counts")
    known = _known_counts(counts)
    judged = cut_lineage(rows.mapInArrow(_judge_batches(df.sparkSession.sparkContext.broadcast(known), min_share), "doc_id long, spam long, words long, page array<long>, stretches array<array<long>>, told array<boolean>"), "spam-pages")
    asked = judged.where(F.size("stretches") > 0).dropDuplicates(["doc_id"]).select("doc_id", "page", "stretches", "told")
    keys = asked.select("doc_id", "stretches").mapInArrow(_key_batches, "doc_id long, key long")
    found = keys.join(counts, "key").groupBy("doc_id").agg(F.collect_list(F.struct("key", "n")).alias("k"))
    settled = asked.join(found, "doc_id").select("doc_id", "page", "stretches", "told", F.col("k.key").alias("keys"), F.col("k.n").alias("counts")).mapInArrow(_settle_batches(known[2]), "doc_id long, more long")
    judged = judged.select("doc_id", "spam", "words").join(settled, "doc_id", "left").select("doc_id", "words", F.when(F.col("words") > 0, (F.col("spam") + F.coalesce("more", F.lit(0))) / F.col("words")).otherwise(0.0).alias("spam_share"))
    return judged.groupBy("doc_id").agg(F.max("spam_share").alias("spam_share"), F.max("words").alias("words"))


def find_spam(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """Ids of the documents with more than `min_share` of their words in spam stretches.

    A page of fewer than `MIN_PAGE_WORDS` words is spam only by its links and tags.
    """
    return spam_shares(df, id_col, text_col, min_share).where(F.col("spam_share") > min_share).select("doc_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_spam(read_table(spark, sf_dir, "documents"))
