"""Near-duplicate records with small edits (problem 2), by fast similarity sketching.

A record is the set of its runs of three words. Fast similarity sketching fills the coordinates of a sketch in
rounds: in a round every element is thrown into one hashed bin with a hashed value, a bin keeps the smallest value of
the first round that reached it, and after as many rounds as there are bins round t + i throws everything into bin i,
so every coordinate is filled, at a cost near that of one hash for each element. Equal coordinates estimate the
Jaccard similarity with concentration bounds; runs of coordinates (bands) find candidates, a few bits of other
coordinates thin them out, and the exact similarity decides. Records with equal sets are one class throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswerk.llm.blocks import has_text
from presswerk.llm.filters import asked_for
from presswerk.llm.words import WORD, WordHashes, mix, runs
from presswerk.session import cut_lineage, read_table, release

RUN = (0, 1, 2)
MIN_SIMILARITY = 0.5
BANDS, ROWS = 96, 5
SKETCH = BANDS * ROWS
#: Coordinates kept with eight bits each for thinning out candidates: at similarity 0.5 they show 0.502 with a
#: standard deviation of 0.063, so a true pair stays below the limit with a chance of about 1 in 100,000.
THIN, THIN_LIMIT = 64, 0.23
#: Records whose bands are made at a time, and records of one band of them from which one leader stands for the rest.
BATCH_RECORDS, LOCAL_GROUP = 2000, 64
ALONE, LEADS = -1, -2
#: Size of the parts in which a set travels.
PART_BYTES = 16_380
#: Different texts of one band whose pairs are all looked at directly; larger bands are compared by leader, then in blocks.
GROUP = 256


def shingles(title: str | None, content: str, cache: WordHashes) -> np.ndarray:
    """Sorted different hashes of the runs of three words of title, line break and content."""
    return np.unique(runs(cache.array(WORD.findall(f"{title or ''}\n{content}".lower())), RUN))


def set_digest(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two numbers."""
    digest = xxhash.xxh3_128_digest(elements.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def sketches(sets: list[np.ndarray], size: int = SKETCH) -> np.ndarray:
    """Fast similarity sketches of non-empty sets, one row each: (round, value) packed into one number for each bin.

    The sets are thrown together; a set whose bins are all filled takes no part in further rounds.
    """
    most = np.iinfo(np.uint64).max
    out = np.full((len(sets), size), most, dtype=np.uint64)
    flat = out.reshape(-1)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    for i in range(2 * size):
        h = mix(elements + np.uint64((0x9E3779B97F4A7C15 * (i + 1)) & 0xFFFFFFFFFFFFFFFF))
        value = (np.uint64(i) << np.uint64(48)) | (h & np.uint64((1 << 48) - 1))
        bins = (((h >> np.uint64(40)) * np.uint64(size)) >> np.uint64(24)).astype(np.int64) if i < size else np.int64(i - size)
        np.minimum.at(flat, owner * size + bins, value)
        if i % 2 or i >= size:
            unfilled = (out == most).any(axis=1)
            if not unfilled.any():
                break
            rest = unfilled[owner]
            if not rest.all():
                elements, owner = elements[rest], owner[rest]
    return out


def _sketch_batches(batches):
    """(id, title, content) -> (id, set_a, set_b, bands, bits); texts without a run of three words have no row."""
    schema = pa.schema([("id", pa.string()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("bands", pa.binary()), ("bits", pa.binary())])
    cache, factors = WordHashes(), np.array([0x9E3779B97F4A7C15 * (2 * k + 3) & 0xFFFFFFFFFFFFFFFF | 1 for k in range(ROWS)], dtype=np.uint64)
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for at in range(0, batch.num_rows, 64):
            keys, sets = [], []
            for key, title, content in zip(*(c[at : at + 64] for c in columns), strict=True):
                if has_text(content) and len(elements := shingles(title, content, cache)):
                    keys.append(key)
                    sets.append(elements)
            if not sets:
                continue
            coordinates = mix(sketches(sets))
            bands = mix((coordinates.reshape(len(sets), BANDS, ROWS) * factors).sum(axis=2, dtype=np.uint64))
            # 48 bits of a band are enough within the band: a rare chance meeting is thinned out or verified away.
            packed = np.ascontiguousarray(bands.view(np.uint8).reshape(len(sets), BANDS, 8)[:, :, :6])
            bits = (coordinates[:, :: SKETCH // THIN][:, :THIN] & np.uint64(255)).astype(np.uint8)
            digests = np.array([set_digest(x) for x in sets], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array([x.tobytes() for x in packed], pa.binary()), pa.array([x.tobytes() for x in bits], pa.binary())], schema=schema
            )


def _band_batches(local_group: int):
    """(rep, bands) -> (key, rep, leader, band), one row for each band of a record.

    The key is the band's number and hash. Where a batch itself holds many records of one band, its first one, the
    leader, stands for them; the others come with the leader and a key of their own, so no band is a hot key.
    """

    def run(batches):
        schema = pa.schema([("key", pa.int64()), ("rep", pa.int64()), ("leader", pa.int64()), ("band", pa.int64())])
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_RECORDS):
                part = batch.slice(at, BATCH_RECORDS)
                n = part.num_rows
                raw = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint8).reshape(n, BANDS, 6)
                wide = np.zeros((n, BANDS, 8), dtype=np.uint8)
                wide[:, :, :6] = raw
                wide[:, :, 6] = np.arange(BANDS, dtype=np.uint8)
                band = wide.view(np.int64).reshape(-1)
                rep = np.repeat(part.column(0).to_numpy(zero_copy_only=False), BANDS)
                order = np.argsort(band, kind="stable")
                band, rep = band[order], rep[order]
                starts = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
                sizes = np.diff(np.append(starts, len(band)))
                many = np.repeat(sizes > local_group, sizes)
                first = np.repeat(rep[starts], sizes)
                follows = many & (rep != first)
                leader = np.where(follows, first, np.where(many, LEADS, ALONE))
                key = np.where(follows, mix((band ^ (first << 20)).view(np.uint64)).view(np.int64), band)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(rep), pa.array(leader), pa.array(np.where(follows, band, 0))], schema=schema)

    return run


def _pair_batches(group: int):
    """Rows (key, rep, leader, band) in order of key and rep -> pairs (a, b, band) of records that share a band.

    A group of up to `group` records gives all its pairs, with band null. A larger one is streamed through: every
    record is paired with the first one, and the band is told, for the rest of its pairs to be looked at in blocks.
    """

    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("band", pa.int64())])

        def out(a, b, band=None):
            tail = pa.nulls(len(a), pa.int64()) if band is None else pa.array(band)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), tail], schema=schema)

        def groups(key, rep, leads):
            """Pairs of whole groups; a group with a leader of others counts as a large one."""
            if not len(key):
                return
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            sizes = np.diff(np.append(starts, len(key)))
            large = np.repeat((sizes > group) | np.logical_or.reduceat(leads, starts), sizes)
            if large.any():
                yield out(np.repeat(rep[starts], sizes)[large], rep[large], key[large])
                key, rep = key[~large], rep[~large]
            for lag in range(1, min(group, len(key))):
                same = np.flatnonzero(key[lag:] == key[:-lag])
                if not len(same):
                    return
                yield out(rep[same], rep[same + lag])

        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)]
        hot, first = None, 0
        for batch in batches:
            key, rep, leader, band = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            led = leader >= 0
            if led.any():
                yield out(leader[led], rep[led], band[led])
                key, rep, leader = key[~led], rep[~led], leader[~led]
            if hot is not None:
                more = key == hot
                if more.any():
                    yield out(np.full(more.sum(), first), rep[more], np.full(more.sum(), hot))
                    key, rep, leader = key[~more], rep[~more], leader[~more]
                if not len(key):
                    continue
                hot = None
            held = [np.concatenate(x) for x in zip(held, (key, rep, leader == LEADS), strict=True)]
            if not len(held[0]):
                continue
            last = int(np.searchsorted(held[0], held[0][-1]))
            yield from groups(*(x[:last] for x in held))
            held = [x[last:] for x in held]
            if len(held[0]) > group:
                hot, first = held[0][0], held[1][0]
                yield from groups(*held)
                held = [x[:0] for x in held]
        yield from groups(*held)

    return run


def _thin_batches(batches):
    """(a, b, bits_a, bits_b) -> (a, b) where enough of the short coordinates agree."""
    for batch in batches:
        n = batch.num_rows
        if n:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(n, THIN) for i in (2, 3))
            keep = pa.array((left == right).mean(axis=1) >= THIN_LIMIT)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _set_batches(batches):
    """(a, b, row, set_a, set_b, title, content) -> (a, b, row, part, elements): the pair's side with its set, in parts.

    Elements are their upper 40 bits, in order; two different runs of a text of 1,000 share them once in a million texts.
    A text that is not the row's (another one came under the same id) is left out.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("row", pa.int64()), ("part", pa.int32()), ("elements", pa.binary())])
    cache, last, parts, digest = WordHashes(), None, [], None
    for batch in batches:
        out, size = [], 0
        for a, b, row, set_a, set_b, title, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if last is None or last[0] != row or last[1] != title or last[2] != content:
                last, elements = (row, title, content), shingles(title, content, cache)
                digest = set_digest(elements)
                packed = np.ascontiguousarray(elements.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()
                parts = [packed[i : i + PART_BYTES] for i in range(0, len(packed), PART_BYTES)]
            if digest == (set_a, set_b):
                out.extend((a, b, row, i, x) for i, x in enumerate(parts))
                size += sum(map(len, parts))
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(schema.types)], schema=schema)
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(schema.types)], schema=schema)


def _verify_batches(min_similarity):
    """Rows (a, b, row, part, elements) in this order -> (a, b) of the pairs that are similar enough."""

    def elements(parts: dict[int, bytes]) -> np.ndarray:
        raw = np.frombuffer(b"".join(parts[i] for i in sorted(parts)), np.uint8).reshape(-1, 5)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, 3:] = raw
        return wide.view(">u8").reshape(-1)

    def similar(sides: dict[int, dict[int, bytes]]) -> bool:
        if len(sides) < 2:
            return False
        left, right = (elements(x) for x in sides.values())
        both = len(np.intersect1d(left, right, assume_unique=True))
        return both >= min_similarity * (len(left) + len(right) - both)

    def run(batches):
        now, sides = None, {}
        for batch in batches:
            found = []
            column = batch.column(4)
            for k, (a, b, row, part) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)):
                if (a, b) != now:
                    if now is not None and similar(sides):
                        found.append(now)
                    now, sides = (a, b), {}
                sides.setdefault(row, {})[part] = column[k].as_py()
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
        if now is not None and similar(sides):
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in now], names=["a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the connected components of edges (a, b): the label is the smallest node.

    Every round, each node takes the smallest label around it, and then that label's own label. Rounds are cut by
    written tables, so a chain of any length needs few of them and none is repeated.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels, written = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), None
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        # The label's own label, one hop further; the smallest node of a component is its own label.
        jumps = stepped.select(F.col("node").alias("next"), F.col("next").alias("jump"))
        following = cut_lineage(stepped.join(jumps, "next", "left").select("node", "label", F.least("next", F.coalesce("jump", "next")).alias("next")), "labels")
        settled = following.where("next <> label").isEmpty()
        if written is not None:
            release(written)
        written = following
        labels = following.select("node", F.col("next").alias("label"))
        if settled:
            release(both)
            return labels


def _similar(pairs: DataFrame, members: DataFrame, rows: DataFrame, min_similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough: thinned out by short coordinates, then checked exactly."""
    bits = members.select("row", "bits")
    thinned = pairs.join(bits.select(F.col("row").alias("a"), F.col("bits").alias("bits_a")), "a").join(bits.select(F.col("row").alias("b"), F.col("bits").alias("bits_b")), "b")
    candidates = cut_lineage(thinned.select("a", "b", "bits_a", "bits_b").mapInArrow(_thin_batches, "a long, b long"), "candidates")
    sides = candidates.select("a", "b", F.explode(F.array("a", "b")).alias("row")).join(members.select("row", "id", "set_a", "set_b"), "row")
    sides = cut_lineage(sides, "sides")
    # Texts that no candidate needs stay where they are.
    texts = asked_for(rows, sides.select("id"), "id")
    met = sides.join(texts, "id").select("a", "b", "row", "set_a", "set_b", "title", "content").mapInArrow(_set_batches, "a long, b long, row long, part int, elements binary")
    # Both sides of a pair meet under the pair's own key, so a record with many links makes no hot key.
    edges = met.repartition("a", "b").sortWithinPartitions("a", "b", "row", "part").mapInArrow(_verify_batches(min_similarity), "a long, b long")
    edges = cut_lineage(edges, "links")
    release(candidates, sides)
    return edges


def _unconnected_pairs(hot: DataFrame, labels: DataFrame, group: int) -> DataFrame:
    """Pairs of records of one large band that are not yet of one class, by blocks of the band's records.

    `hot` has (band, node). A band's records are spread over blocks, and each two blocks meet in a key of their own,
    so no key holds more than two blocks, whatever the size of the band.
    """
    known = hot.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    mixed = known.groupBy("band").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    blocks = F.ceil(F.col("n") / group).cast("int")
    placed = known.join(mixed.select("band", "n"), "band").select("band", "node", "label", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("i"))
    met = placed.select("band", "node", "label", "i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    met = met.select("band", "node", "label", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"))
    keys = ["band", "x", "y"]
    left, right = met.select(*keys, F.col("node").alias("a"), F.col("label").alias("label_a")), met.select(*keys, F.col("node").alias("b"), F.col("label").alias("label_b"))
    return left.join(right, keys).where("a < b and label_a <> label_b").select("a", "b").distinct()


def near_copy_classes(df: DataFrame, id_col: str = "id", title_col: str = "title", text_col: str = "content", min_similarity: float = MIN_SIMILARITY, group: int = GROUP, local_group: int = LOCAL_GROUP) -> DataFrame:
    """Rows (id, class_id, links): one for each id with text; ids of one class belong together.

    `links` is the number of different texts found similar to the id's text; of a band held by more than `group`
    different texts, or by more than `local_group` of one batch, only the links that are needed to connect its
    classes are looked for. Null ids, texts without content (null, empty, None / nan) and texts of fewer than three
    words have no row. Repeated rows of an id count once, equal texts are one class, extra columns are ignored, an
    empty table gives an empty result. Texts are read whole.
    """
    rows = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(title_col).alias("title"), F.col(text_col).alias("content"))
    sketches = rows.mapInArrow(_sketch_batches, "id string, set_a long, set_b long, bands binary, bits binary")
    members = cut_lineage(sketches.withColumn("row", F.monotonically_increasing_id()), "sketches")
    # One row stands for each set; equal texts meet in the partial aggregation, before the shuffle.
    sets = members.groupBy("set_a", "set_b").agg(F.min(F.struct("row", "bands")).alias("x")).select("x.row", "x.bands")
    bands = sets.mapInArrow(_band_batches(local_group), "key long, rep long, leader long, band long")
    met = cut_lineage(bands.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(_pair_batches(group), "a long, b long, band long"), "met")
    edges = _similar(met.select("a", "b").where("a < b").distinct(), members, rows, min_similarity)
    labels = components(edges)
    hot = met.where("band is not null").select("band", F.explode(F.array("a", "b")).alias("node")).distinct()
    if not hot.isEmpty():
        # A band of many texts: those still apart are compared too, so no link between classes is lost.
        more = _similar(_unconnected_pairs(cut_lineage(hot, "large-bands"), labels, group), members, rows, min_similarity)
        if not more.isEmpty():
            edges = edges.union(more)
            labels = components(edges)
    release(met)

    links = edges.select(F.col("a").alias("node")).union(edges.select("b")).groupBy("node").agg(F.count("*").cast("int").alias("links"))
    known = labels.join(links, "node").select(F.col("node").alias("rep"), "label", "links")
    sets = members.groupBy("set_a", "set_b").agg(F.min("row").alias("rep")).join(known, "rep", "left")
    classes = sets.select("set_a", "set_b", F.coalesce("label", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
    return members.select("id", "set_a", "set_b").dropDuplicates(["id"]).join(classes, ["set_a", "set_b"]).select("id", "class_id", "links")


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form that grows with the input: one row for each id."""
    return near_copy_classes(read_table(spark, sf_dir, "articles"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = cut_lineage(near_copy_classes(read_table(spark, sf_dir, "articles")).select("id", "class_id"), "classes")
    shared = classes.groupBy("class_id").agg(F.count("*").alias("n")).where("n > 1").select("class_id")
    members = classes.join(shared, "class_id", "left_semi")
    left, right = members.select("class_id", F.col("id").alias("id_a")), members.select("class_id", F.col("id").alias("id_b"))
    return left.join(right, "class_id").where("id_a < id_b").select("id_a", "id_b")
