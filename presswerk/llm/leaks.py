"""Evaluation texts leaking into training text (problem 8), by spaced-seed hashing.

Fixed masks take five words out of a window of six and ignore the other one. The seeds of the test items are joined
with those of the documents; a document with enough seeds of an item near one another goes to an exact check, which
aligns both texts around the hits and looks for a stretch of the item with at most one edit in eight words. The test
table is the stated query set: it is looked up in blocks of a fixed size, one pass over the documents each, so nothing
that grows is broadcast and no document is shuffled.

How many seeds are asked for follows from the definition. L words with E = L // 8 edits leave L - E equal words in at
most E + 1 runs, so at least L - 6 E - 5 windows of six words without an edit (t more if t edits are added words), and
each of them is a seed of every mask. A changed word adds the windows in which a mask ignores it. A stretch that can be
cut into two parts that both qualify is found by either, which bounds the stretches to look at: any part of m words
with m - m // 8 >= min_words can lose the edits at its end and is still long enough, so stretches of 2 m - 1 words are
the longest that cannot be cut. Their seeds stand within 2 m - 1 words and as many edits, on as many diagonals.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswerk.llm.words import PLAIN_WORD, WordHashes, runs
from presswerk.session import cut_lineage, read_table

#: Offsets of the words that a seed takes out of a window of six; each mask ignores one word.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 4, 5))
SPAN = 6
MIN_WORDS = 36
EDIT_SHARE = 8
#: Words of the test table in one block, at most, or of one longer piece: with their seeds 56 bytes a word, so about
#: 60 MB travel to the executors.
BLOCK_WORDS = 1_000_000
#: Documents are looked up together until they have so many words.
CHUNK_WORDS = 100_000
#: Longer texts are cut into pieces that overlap by more than any stretch that must be found whole.
PIECE_WORDS, PIECE_OVERLAP = 1 << 20, 1 << 12


class Limits:
    """What any stretch of at least `min_words` words must show: seeds, within so many words, on so many diagonals."""

    def __init__(self, min_words: int = MIN_WORDS):
        part = min_words
        while part - part // EDIT_SHARE < min_words:
            part += 1
        longest = 2 * part - 1
        windows = min(n - 6 * (n // EDIT_SHARE) - 5 for n in range(min_words, longest + 1))
        if windows < 1 or longest + longest // EDIT_SHARE > PIECE_OVERLAP // 2:
            raise ValueError(f"stretches of {min_words} words are too short or too long to be found by these seeds")
        self.min_words, self.seeds = min_words, windows * len(MASKS)
        self.drift = longest // EDIT_SHARE
        self.window = longest + self.drift


def _tokens(text: str | None) -> list[str]:
    return PLAIN_WORD.findall(text.casefold()) if text else []


def _pieces(words: np.ndarray):
    for at in range(0, max(1, len(words) - PIECE_OVERLAP), PIECE_WORDS - PIECE_OVERLAP):
        yield words[at : at + PIECE_WORDS]


def _seeds(words: np.ndarray) -> list[np.ndarray]:
    """The seeds of all windows of six words, for each mask."""
    return [runs(words, mask)[: max(0, len(words) - SPAN + 1)] * np.uint64(2 * k + 1) for k, mask in enumerate(MASKS)]


def _item_batches(batches):
    """(key, text) -> (key, words, n): the words' hashes of each piece of an item."""
    cache = WordHashes()
    for batch in batches:
        out = [(key, piece.tobytes(), len(piece)) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for piece in _pieces(cache.array(_tokens(text)))]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.int64()))], names=["key", "words", "n"])


class TestTable:
    """One block of the test table: its items' words, and its seeds in order with the item and position of each."""

    def __init__(self, keys: list[int], texts: list[np.ndarray]):
        self.keys, self.texts = keys, texts
        found, items, places = [], [], []
        for i, words in enumerate(texts):
            for seeds in _seeds(words):
                found.append(seeds)
                items.append(np.full(len(seeds), i, np.int32))
                places.append(np.arange(len(seeds), dtype=np.int32))
        seeds = np.concatenate(found) if found else np.empty(0, np.uint64)
        order = np.argsort(seeds, kind="stable")
        self.items, self.places = (np.concatenate(x)[order] if x else np.empty(0, np.int32) for x in (items, places))
        seeds = seeds[order]
        new = np.flatnonzero(np.append(True, seeds[1:] != seeds[:-1])) if len(seeds) else np.empty(0, np.int64)
        self.seeds, self.first = seeds[new], np.append(new, len(seeds))

    def filter(self) -> np.ndarray:
        """A bit table, sixteen bits for each seed or more, made where it is used."""
        self.shift = np.uint64(64 - max(16, math.ceil(math.log2(16 * max(1, len(self.seeds))))))
        bits = np.zeros(1 << (64 - int(self.shift)), dtype=bool)
        bits[self.seeds >> self.shift] = True
        return bits


def candidates(words: np.ndarray, lengths: np.ndarray, table: TestTable, bits: np.ndarray, limits: Limits):
    """(document number, item number, lowest and highest diagonal) of places where enough seeds meet.

    `words` are the documents' words behind one another. A group of seeds that a stretch must have lies whole in one of
    four layouts of cells twice as large, each half a cell off the others in position or diagonal.
    """
    ends = np.cumsum(lengths)
    doc_of = np.repeat(np.arange(len(lengths)), lengths)
    whole = doc_of[: len(words) - SPAN + 1] == doc_of[SPAN - 1 :] if len(words) >= SPAN else np.empty(0, bool)
    at, seeds = [], []
    for found in _seeds(words):
        known = np.flatnonzero(whole & bits[found >> table.shift])
        at.append(known)
        seeds.append(found[known])
    at, seeds = np.concatenate(at), np.concatenate(seeds)
    near = min(limits.seeds, len(at)) - 1
    if len(at) < limits.seeds:
        return []
    # Hits with too few others around them are dropped before they are looked up.
    order = np.argsort(at, kind="stable")
    at, seeds = at[order], seeds[order]
    dense = np.flatnonzero(at[near:] - at[: len(at) - near] <= limits.window)
    cover = np.zeros(len(at) + 1, np.int64)
    np.add.at(cover, dense, 1)
    np.add.at(cover, dense + near + 1, -1)
    inside = np.cumsum(cover)[:-1] > 0
    at, seeds = at[inside], seeds[inside]
    where = np.searchsorted(table.seeds, seeds)
    known = np.flatnonzero(table.seeds[np.minimum(where, len(table.seeds) - 1)] == seeds)
    at, where = at[known], where[known]
    first, many = table.first[where], table.first[where + 1] - table.first[where]
    rows = np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
    at, item, place = np.repeat(at, many), table.items[rows].astype(np.int64), table.places[rows].astype(np.int64)
    # An item without enough seeds in the whole document has not enough in any cell either.
    pair = doc_of[at] * len(table.keys) + item
    pairs, number = np.unique(pair, return_inverse=True) if len(lengths) * len(table.keys) > 1 << 24 else (None, pair)
    enough = np.bincount(number)[number] >= limits.seeds
    at, item, place, pair = at[enough], item[enough], place[enough], pair[enough]
    if not len(at):
        return []
    local = at - (ends - lengths)[doc_of[at]]
    diagonal = local - place
    window, drift = limits.window, limits.drift
    across, down = int(local.max()) // (2 * window) + 2, (int(diagonal.max()) - int(diagonal.min())) // (2 * drift) + 2
    assert int(pair.max() + 1) * across * down < 1 << 63, "a chunk is bounded in words and a block in items"
    level = diagonal - diagonal.min()
    out = []
    for a in (0, window):
        for b in (0, drift):
            cell = (pair * across + (local + a) // (2 * window)) * down + (level + b) // (2 * drift)
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            counts = np.diff(np.append(starts, len(cell)))
            sorted_diagonal = diagonal[order]
            low, high = np.minimum.reduceat(sorted_diagonal, starts), np.maximum.reduceat(sorted_diagonal, starts)
            full = counts >= limits.seeds
            out.append((pair[order[starts[full]]], low[full], high[full]))
    pair, low, high = (np.concatenate(x) for x in zip(*out, strict=True))
    spots = np.unique(np.stack([pair, low, high]), axis=1) if len(pair) else np.empty((3, 0), np.int64)
    return [(p // len(table.keys), p % len(table.keys), a, b) for p, a, b in spots.T.tolist()]


def _search_batches(table, limits: Limits):
    """mapInArrow over (key, text) -> (doc_id, item_id, words): seeds, cells and the exact check, chunk by chunk."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("words", pa.int32())])

    def search(keys, texts, block, bits):
        out = []
        spots: dict[tuple[int, int], list[int]] = {}
        for doc, item, low, high in candidates(np.concatenate(texts), np.array([len(x) for x in texts]), block, bits, limits):
            spots.setdefault((doc, item), []).extend((low, high))
        for (doc, item), diagonals in spots.items():
            words = longest_stretch(block.texts[item], texts[doc], diagonals, limits.min_words)
            if words:
                out.append((keys[doc], block.keys[item], words))
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(schema.types)], schema=schema)

    def run(batches):
        cache, block = WordHashes(), table.value
        bits = block.filter()
        keys, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for piece in _pieces(cache.array(_tokens(text.as_py()))):
                    if len(piece) >= SPAN:
                        keys.append(key)
                        texts.append(piece)
                        size += len(piece)
                    if size >= CHUNK_WORDS:
                        yield search(keys, texts, block, bits)
                        keys, texts, size = [], [], 0
        if texts:
            yield search(keys, texts, block, bits)

    return run


def longest_stretch(item: np.ndarray, doc: np.ndarray, diagonals: list[int], min_words: int = MIN_WORDS) -> int:
    """Words of the longest stretch of `item` found in `doc` with at most one edit in eight words; 0 if there is none.

    `diagonals` are document minus item positions of seed hits. A stretch begins and ends with an equal word; its edits
    are those of an alignment near the hits' diagonals. Whether there is a stretch is exact; where a longer
    one ends right behind several edits in a row, its length may be a few words short.
    """
    best = 0
    drift = Limits(min_words).drift
    for low, high in _bands(diagonals, drift):
        low, high = max(low - drift, 1 - len(item)), min(high + drift, len(doc) - 1)
        if low <= high and len(item) - max(0, -high) > best:
            best = max(best, _longest_in_band(item, doc, low, high, max(min_words, best + 1)))
    return best


def _longest_in_band(item: np.ndarray, doc: np.ndarray, low: int, high: int, least: int) -> int:
    """Longest stretch of `least` words or more on the diagonals `low` to `high`, by furthest reaches for 0, 1, 2 ... edits."""
    n = len(item)
    equal = _equal_words(item, doc, low, high)
    # A word that no diagonal holds costs an edit in any alignment, which bounds where a stretch from i can end.
    balance = np.arange(n + 1) - EDIT_SHARE * np.concatenate([[0], np.cumsum(~equal.any(axis=0))])
    highest = np.maximum.accumulate(balance[::-1])
    if n < least or (highest[::-1][least:] < balance[: n + 1 - least]).all():
        return 0
    # end[d, i]: where the run of equal words ends that begins at i of diagonal d.
    end = np.full((len(equal), n + 1), n)
    end[:, :n] = np.minimum.accumulate(np.where(equal, n, np.arange(n))[:, ::-1], axis=1)[:, ::-1]
    row, start = np.nonzero(equal & ~np.pad(equal, ((0, 0), (1, 0)))[:, :-1])
    limit = n - np.searchsorted(highest, balance[start], "left")
    at = np.full((len(start), len(equal)), -1)
    at[np.arange(len(start)), row] = end[row, start]
    best, edits, unsure = 0, 0, set()
    rows = np.arange(len(equal))
    while True:
        alive = limit - start >= max(least, best + 1, EDIT_SHARE * edits)
        if not alive.any():
            break
        if not alive.all():
            row, start, limit, at = row[alive], start[alive], limit[alive], at[alive]
        if edits:
            # A changed word, a dropped one (from the diagonal above) or an added one (from the one below).
            step = np.where(at >= 0, at + 1, -1)
            step[:, :-1] = np.maximum(step[:, :-1], np.where(at[:, 1:] >= 0, at[:, 1:] + 1, -1))
            step[:, 1:] = np.maximum(step[:, 1:], at[:, :-1])
            at = np.where(step >= 0, end[rows, np.minimum(step, n)], -1)
        words = at - start[:, None]
        enough = (at >= 0) & (np.minimum(words, (limit - start)[:, None]) >= max(least, EDIT_SHARE * edits))
        if enough.any():
            last = equal[rows, np.maximum(at, 1) - 1]
            best = max(best, int(words[enough & last].max(initial=0)))
            # Reached with an edit as the last step: an end with an equal word may lie shortly before it.
            open_end = (enough & ~last).any(axis=1)
            unsure.update(zip(row[open_end].tolist(), start[open_end].tolist(), strict=True))
        edits += 1
    if not best:
        best = max((_longest_from(equal, d, i, least) for d, i in unsure), default=0)
    return best


def _equal_words(item: np.ndarray, doc: np.ndarray, low: int, high: int) -> np.ndarray:
    """equal[d, i]: whether word i of the item stands on diagonal low + d of the document."""
    n = len(item)
    begin, end = max(0, low), min(len(doc), n + high)
    padded = np.zeros(n + high - low, dtype=np.uint64)
    there = np.zeros(n + high - low, dtype=bool)
    padded[begin - low : end - low] = doc[begin:end]
    there[begin - low : end - low] = True
    window = np.lib.stride_tricks.sliding_window_view
    return (window(padded, n) == item) & window(there, n)


def _longest_from(equal: np.ndarray, row: int, start: int, least: int) -> int:
    """Longest stretch that begins with the equal word at `start` of a diagonal, by the whole table of edit distances."""
    n, best = equal.shape[1], 0
    rows = np.arange(len(equal))
    cost = np.where(rows >= row, rows - row, n)
    for i in range(start + 1, n):
        words = i + 1 - start
        ends = equal[:, i] & (EDIT_SHARE * cost <= words)
        if words >= least and ends.any():
            best = words
        below = np.append(cost[1:], n) + 1
        cost = np.minimum(cost + ~equal[:, i], below)
        cost = np.minimum.accumulate(cost - rows) + rows
        if EDIT_SHARE * cost.min() > n - start:
            break
    return best


def _bands(diagonals: list[int], drift: int) -> list[tuple[int, int]]:
    """Groups of diagonals that one passage with its dropped and added words can touch."""
    out: list[tuple[int, int]] = []
    for d in sorted(set(diagonals)):
        if out and d - out[-1][1] <= 2 * drift:
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def _blocks(test: DataFrame, block_words: int):
    """The test table in blocks of `block_words` at most, streamed through the driver piece by piece."""
    keys, texts, size = [], [], 0
    for key, words, n in test.toLocalIterator():
        if keys and size + n > block_words:
            yield TestTable(keys, texts)
            keys, texts, size = [], [], 0
        keys.append(key)
        texts.append(np.frombuffer(words, np.uint64))
        size += n
    if keys:
        yield TestTable(keys, texts)


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "content", min_words: int = MIN_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (doc_id, item_id, words): documents that hold a stretch of at least `min_words` words of an item.

    Null, empty and short texts give no rows, repeated rows count once, extra columns are ignored, empty tables give
    an empty result. Texts of any length are read whole; stretches longer than 4,096 words may be reported shorter
    where a text has over a million words. A `min_words` for which the seeds guarantee nothing (under 18) is an error.
    """
    spark, limits = docs.sparkSession, Limits(min_words)
    left = docs.where(F.col(doc_id).isNotNull() & F.col(doc_text).isNotNull()).select(F.col(doc_id).cast("long").alias("key"), F.col(doc_text).alias("text"))
    right = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("long").alias("key"), F.col(item_text).alias("text"))
    test = right.distinct().mapInArrow(_item_batches, "key long, words binary, n long").where(F.col("n") >= min_words)
    found: list[DataFrame] = []

    def search(block: TestTable, last: bool) -> None:
        table = spark.sparkContext.broadcast(block)
        hits = left.mapInArrow(_search_batches(table, limits), "doc_id long, item_id long, words int")
        if found or not last:  # one of several: its result is written, and its table leaves the executors
            hits = cut_lineage(hits, "leaks")
            table.destroy()
        found.append(hits)

    waiting = None
    for block in _blocks(cut_lineage(test.select("key", "words", "n"), "test-items"), block_words):
        if waiting is not None:
            search(waiting, False)
        waiting = block
    if waiting is not None:
        search(waiting, True)
    if not found:
        return spark.createDataFrame([], "doc_id long, item_id long, words int")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.groupBy("doc_id", "item_id").agg(F.max("words").alias("words"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_articles")).select("doc_id", "item_id")
