"""Document and line languages (problem 6): averaged hashed subword embeddings with a linear softmax.

The model is trained here by stochastic gradient descent in numpy on a bounded sample of labelled rows, its
confidence is calibrated by temperature scaling on a held-out part of the sample, and lines whose calibrated
confidence stays under a threshold are rejected, that is, taken for lines of the main language. As both layers are
linear, an embedding bucket times the output layer gives a bucket's scores, so a line is scored by table look-ups.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from presswerk.llm.blocks import PAGE, STORY, PublisherNames, has_text, label_lines, publisher_names
from presswerk.session import read_table

LANGUAGES = ("en", "fr", "de", "es", "it", "pt")
#: Training uses at most so many labelled rows of a language, those with the smallest hash of their id.
MAX_ROWS_PER_LANGUAGE = 200
BUCKET_BITS = 15
DIM = 16
MIN_CONFIDENCE = 0.9
#: Lines of fewer words than this are taken for another language only at the higher confidence; none of them trains.
MIN_LINE_WORDS, SHORT_CONFIDENCE = 4, 0.999

# Notations of the six languages beside their two-letter codes and regional forms of these.
NOTATIONS = {
    "en": "en eng english anglais inglés inglese inglês englisch",
    "fr": "fr fra fre french français francais",
    "de": "de deu ger german deutsch allemand",
    "es": "es spa spanish español espanol castellano castilian",
    "it": "it ita italian italiano",
    "pt": "pt por portuguese português portugues",
}
_WORD = re.compile(r"[^\W\d_]+")


def label_code(label: Column) -> Column:
    """The two-letter code a label stands for, NULL for a missing or unknown one."""
    first = F.regexp_extract(F.lower(F.trim(label)), r"^(\p{L}+)", 1)
    names = {word: code for code, words in NOTATIONS.items() for word in words.split()}
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[first]


def buckets(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the byte 3-grams and 4-grams that begin at each position (fewer at the end)."""
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    three = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
    four = three[:-1] | (b[3:] << np.uint32(24))
    shift = np.uint32(32 - BUCKET_BITS)
    return (three * np.uint32(0x9E3779B1)) >> shift, ((four * np.uint32(0x85EBCA6B)) >> shift) + np.uint32(1 << BUCKET_BITS)


def _prepared(line: str) -> bytes:
    return (" " + " ".join(line.lower().split()) + "  ").encode("utf-8", "replace")


class LanguageModel:
    """scores[bucket, language]: embedding times output layer; temperature: from calibration."""

    def __init__(self, scores: np.ndarray, bias: np.ndarray, temperature: float):
        self.scores, self.bias, self.temperature = scores, bias, temperature

    def logits(self, lines: list[str]) -> np.ndarray:
        """Calibrated logits, one row for each line; chunks keep the look-ups in cache."""
        out = np.empty((len(lines), len(LANGUAGES)), dtype=np.float32)
        begin, size, chunk = 0, 0, []
        for i, line in enumerate(lines):
            data = _prepared(line)
            chunk.append(data)
            size += len(data)
            if size > 200_000 or i == len(lines) - 1:
                out[begin : i + 1] = self._chunk(chunk)
                begin, size, chunk = i + 1, 0, []
        return out

    def _chunk(self, chunk: list[bytes]) -> np.ndarray:
        lengths = np.array([len(x) for x in chunk])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        three, four = buckets(b"".join(chunk) + b"\0\0\0")
        total = np.add.reduceat(self.scores[three[: lengths.sum()]] + self.scores[four[: lengths.sum()]], starts, axis=0)
        return (total / (2 * lengths[:, None]) + self.bias)[:, : len(LANGUAGES)] * self.temperature

    def probabilities(self, lines: list[str]) -> np.ndarray:
        return softmax(self.logits(lines))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(lines: list[str], labels: np.ndarray, epochs: int = 5, batch: int = 128, rate: float = 2.0, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent on four fifths of the lines, temperature scaling on the rest.

    Labels may be wrong, so after two epochs the lines on which model and label disagree are set aside; the rest of
    the training and the calibration use the others.
    """
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (2 << BUCKET_BITS, DIM)).astype(np.float32)
    layer = rng.normal(0, 0.1, (DIM, len(LANGUAGES))).astype(np.float32)
    bias = np.zeros(len(LANGUAGES), dtype=np.float32)
    features = []
    for line in lines:
        data = _prepared(line)
        three, four = buckets(data + b"\0\0\0")
        features.append(np.concatenate([three[: len(data)], four[: len(data)]]))
    order = rng.permutation(len(lines))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    for epoch in range(epochs):
        if epoch == 2:
            guess = _finished(table, layer, bias).logits(lines).argmax(axis=1)
            used, held = (rows[guess[rows] == labels[rows]] for rows in (used, held))
        rng.shuffle(used)
        now = rate * (1 - epoch / epochs)
        for at in range(0, len(used), batch):
            rows = used[at : at + batch]
            parts = [features[r] for r in rows]
            lengths = np.array([len(p) for p in parts])
            ids = np.concatenate(parts)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            mean = np.add.reduceat(table[ids], starts, axis=0) / lengths[:, None]
            error = softmax(mean @ layer + bias)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error /= len(rows)
            # Embedding rates are scaled by the mean length, as every n-gram gets only its share of the gradient.
            back = now * float(lengths.mean()) * (error @ layer.T) / lengths[:, None]
            layer -= now * (mean.T @ error)
            bias -= now * error.sum(axis=0)
            row = np.repeat(np.arange(len(rows)), lengths)
            for d in range(DIM):
                table[:, d] -= np.bincount(ids, weights=back[row, d], minlength=len(table))
    model = _finished(table, layer, bias)
    if len(held):
        raw = model.logits([lines[i] for i in held])
        grid = np.geomspace(0.25, 1.5, 25)
        losses = [-np.log(np.clip(softmax(raw * g)[np.arange(len(held)), labels[held]], 1e-6, 1)).mean() for g in grid]
        model.temperature = float(grid[int(np.argmin(losses))])
    return model


def _finished(table: np.ndarray, layer: np.ndarray, bias: np.ndarray) -> LanguageModel:
    scores = np.zeros((table.shape[0], 8), dtype=np.float32)
    scores[:, : len(LANGUAGES)] = table @ layer
    wide = np.zeros(8, dtype=np.float32)
    wide[: len(LANGUAGES)] = bias
    return LanguageModel(scores, wide, 1.0)


def fit_on_labels(df: DataFrame, sources: DataFrame, names: list[str], max_rows: int = MAX_ROWS_PER_LANGUAGE, id_col: str = "id", text_col: str = "content", lang_col: str = "lang", source_col: str = "source") -> LanguageModel | None:
    """Fit on at most `max_rows` rows of a language whose label agrees with their publisher's home language."""
    home = sources.select(F.col("source").alias("__source"), "home_lang").dropDuplicates(["__source"])
    agreed = df.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).withColumn("__code", label_code(F.col(lang_col))).withColumn("__hash", F.xxhash64(F.col(id_col)))
    agreed = agreed.join(home, (F.col(source_col) == F.col("__source")) & (F.col("__code") == F.col("home_lang")), "left_semi")
    ranked = agreed.select("__code", "__hash").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("__code").orderBy("__hash")))
    limits = {r[0]: r[1] for r in ranked.where(F.col("rank") <= max_rows).groupBy("__code").agg(F.max("__hash")).collect()}
    if len(limits) < 2:
        return None
    below = F.lit(False)
    for code, limit in limits.items():
        below = below | ((F.col("__code") == code) & (F.col("__hash") <= limit))
    sample = agreed.where(below).select(id_col, "__code", text_col).dropDuplicates([id_col]).collect()
    finder = PublisherNames(names)
    lines, labels = [], []
    for _, code, text in sorted(sample):
        if has_text(text):
            parts = text.split("\n")
            for line, kind in zip(parts, label_lines(parts, finder), strict=True):
                if kind == STORY and len(_WORD.findall(line)) >= MIN_LINE_WORDS:
                    lines.append(line)
                    labels.append(LANGUAGES.index(code))
    return train(lines, np.array(labels)) if lines else None


def judge(lines: list[str], model: LanguageModel, kinds: list[int], min_confidence: float = MIN_CONFIDENCE) -> tuple[str, float, list[tuple[int, str, float]], bool]:
    """Main language, its confidence, (line number, language, confidence) of the lines in another one, whether no line is sure."""
    story = [i for i, k in enumerate(kinds) if k == STORY] or [i for i, k in enumerate(kinds) if k == PAGE]
    return _judge(lines, story, model.logits([lines[i] for i in story]), min_confidence)


def _judge(lines, story, logits, min_confidence):
    probabilities = softmax(logits)
    words = np.array([len(_WORD.findall(lines[i])) for i in story])
    best, sure = probabilities.argmax(axis=1), probabilities.max(axis=1)
    decided = sure >= np.where(words >= MIN_LINE_WORDS, min_confidence, max(min_confidence, SHORT_CONFIDENCE))
    rejected = not decided.any()
    weight = np.bincount(best[decided], weights=words[decided], minlength=len(LANGUAGES)) if decided.any() else None
    if weight is None or not weight.any():
        weight = (probabilities * np.maximum(words, 1)[:, None]).sum(axis=0)
    main = int(weight.argmax())
    foreign = [(story[k], LANGUAGES[best[k]], float(sure[k])) for k in np.flatnonzero(decided & (best != main))]
    return LANGUAGES[main], float(weight[main] / weight.sum()), foreign, rejected


def _judge_batches(model, names, min_confidence):
    schema = pa.schema([("id", pa.string()), ("main", pa.string()), ("main_confidence", pa.float64()), ("line_nos", pa.list_(pa.int32())), ("langs", pa.list_(pa.string())), ("confidences", pa.list_(pa.float64())), ("rejected", pa.bool_())])

    def run(batches):
        finder = PublisherNames(names)
        for batch in batches:
            rows, texts = [], []
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not has_text(content):
                    continue
                lines = content.split("\n")
                kinds = label_lines(lines, finder)
                story = [i for i, k in enumerate(kinds) if k == STORY] or [i for i, k in enumerate(kinds) if k == PAGE]
                if story:
                    rows.append((key, lines, story))
                    texts.extend(lines[i] for i in story)
            logits, at, out = model.logits(texts), 0, []
            for key, lines, story in rows:
                main, sure, foreign, rejected = _judge(lines, story, logits[at : at + len(story)], min_confidence)
                at += len(story)
                out.append((key, main, sure, [x[0] for x in foreign], [x[1] for x in foreign], [x[2] for x in foreign], rejected))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)] if out else [pa.array([], t) for t in schema.types], schema=schema)

    return run


def language_labels(df: DataFrame, sources: DataFrame, id_col: str = "id", text_col: str = "content", lang_col: str = "lang", source_col: str = "source", max_rows: int = MAX_ROWS_PER_LANGUAGE, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rows (id, line_no, lang, confidence, label, rejected): `line_no` -1 gives the main language, others foreign story lines.

    `rejected` marks a text of which no line reached the confidence asked for: its main language is the likeliest of
    the model's and may be none of them.

    Null ids and null, empty or None / nan texts give no rows. Repeated rows count once, ties go to the first
    language of the list, extra columns are ignored, and without rows in at least two languages to learn from the
    result is empty. Texts are read whole.
    """
    names = publisher_names(sources)
    model = fit_on_labels(df, sources, names, max_rows, id_col, text_col, lang_col, source_col)
    out = "id string, line_no int, lang string, confidence double, label string, rejected boolean"
    if model is None:
        return df.sparkSession.createDataFrame([], out)
    rows = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    # The label rides along as part of the key, so no second pass over the table is needed.
    key = F.concat_ws("\u001f", F.coalesce(label_code(F.col(lang_col)), F.lit("")), F.col(id_col).cast("string"))
    judged = rows.select(key.alias("id"), F.col(text_col).alias("content")).mapInArrow(
        _judge_batches(model, names, min_confidence), "id string, main string, main_confidence double, line_nos array<int>, langs array<string>, confidences array<double>, rejected boolean"
    )
    parts = F.split("id", "\u001f", 2)
    judged = judged.select(parts[1].alias("id"), F.nullif(parts[0], F.lit("")).alias("label"), "main", "main_confidence", "line_nos", "langs", "confidences", "rejected").dropDuplicates(["id"])
    main = F.array(F.struct(F.lit(-1).alias("line_no"), F.col("main").alias("lang"), F.col("main_confidence").alias("confidence")))
    foreign = F.transform(F.arrays_zip("line_nos", "langs", "confidences"), lambda x: F.struct(x["line_nos"].alias("line_no"), x["langs"].alias("lang"), x["confidences"].alias("confidence")))
    return judged.select("id", "label", "rejected", F.explode(F.concat(main, foreign)).alias("x")).select("id", "x.line_no", "x.lang", "x.confidence", "label", "rejected")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_labels(read_table(spark, sf_dir, "articles"), read_table(spark, sf_dir, "sources"))
    return found.where((F.col("line_no") >= 0) | F.col("label").isNull() | (F.col("label") != F.col("lang"))).select("id", "line_no", "lang")
