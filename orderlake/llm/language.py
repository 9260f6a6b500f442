"""Language of a text by a convolutional network over its bytes.

Filters of several widths slide over fixed windows of bytes; the strongest answer of each filter in a window
goes through a softmax layer. As inputs are bytes, a filter is a table: one row per byte and place. Training
needs only the places that were strongest. For prediction two neighbouring places are folded into one table
over byte pairs. Everything is numpy: training on the driver over a bounded sample of windows, prediction in
batches of windows inside tasks, over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm.staging import lean

UNKNOWN = "und"
LENGTH = 256
WIDTHS, FILTERS = (2, 3, 4), 16
#: Bound of the training sample: distinct texts per language, windows of each, and languages.
TEXTS_PER_LANGUAGE, WINDOWS_PER_TEXT, MOST_LANGUAGES = 400, 4, 200
#: Parts a language's texts are ranked in before they are ranked together.
SAMPLE_PARTS = 64
EPOCHS, BATCH, RATE = 6, 64, 0.01
#: Windows predicted together.
WINDOWS_AT_ONCE = 256
HOLD_OUT = 5

# A-Z are read as a-z; the rest of the bytes are told apart.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LETTER = regex.compile(r"\p{L}")


@dataclass
class ByteCnn:
    """Tables ``[width][place]`` of shape (256, filters), and the softmax layer."""

    classes: list[str]
    tables: list[list[np.ndarray]]
    bias: list[np.ndarray]
    weight: np.ndarray
    shift: np.ndarray
    _pairs: list = field(default_factory=list)

    @staticmethod
    def new(classes: list[str], rng: np.random.Generator) -> ByteCnn:
        tables = [[rng.normal(0, 0.1, (256, FILTERS)).astype(np.float32) for _ in range(w)] for w in WIDTHS]
        weight = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        return ByteCnn(classes, tables, bias, weight, np.zeros(len(classes), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [t for own in self.tables for t in own] + self.bias + [self.weight, self.shift]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy over windows ``x`` with classes ``y``."""
        n, pooled, places = len(x), [], []
        for width, tables, bias in zip(WIDTHS, self.tables, self.bias):
            size = LENGTH - width + 1
            answer = sum(table[x[:, k : k + size]] for k, table in enumerate(tables))
            at = answer.argmax(1)
            places.append(at)
            pooled.append(np.take_along_axis(answer, at[:, None], 1)[:, 0] + bias)
        features = np.maximum(np.concatenate(pooled, 1), 0)
        error = _softmax(features @ self.weight + self.shift)
        error[np.arange(n), y] -= 1
        error /= n
        back = (error @ self.weight.T) * (features > 0)
        tables_back, bias_back = [], []
        filters = np.arange(FILTERS)
        for i, (width, at) in enumerate(zip(WIDTHS, places)):
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            bias_back.append(own.sum(0))
            for k in range(width):
                table = np.zeros((256, FILTERS), np.float32)
                np.add.at(table, (np.take_along_axis(x, at + k, 1), filters[None]), own)
                tables_back.append(table)
        return [*tables_back, *bias_back, features.T @ error, error.sum(0)]

    def fold(self) -> None:
        """Tables over byte pairs: two lookups serve filters of width three and four."""
        both = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
        self._pairs = []
        for tables in self.tables:
            paired = [both(tables[k], tables[k + 1]) for k in range(0, len(tables) - 1, 2)]
            self._pairs.append((paired, tables[-1] if len(tables) % 2 else None))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the classes for windows of bytes."""
        if not self._pairs:
            self.fold()
        pairs = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        pooled = []
        for width, (paired, last), bias in zip(WIDTHS, self._pairs, self.bias):
            size = LENGTH - width + 1
            answer = np.take(paired[0], pairs[:, :size], axis=0)
            for k, table in enumerate(paired[1:], 1):
                answer += np.take(table, pairs[:, 2 * k : 2 * k + size], axis=0)
            if last is not None:
                answer += np.take(last, x[:, width - 1 : width - 1 + size], axis=0)
            pooled.append(answer.max(1) + bias)
        return _softmax(np.maximum(np.concatenate(pooled, 1), 0) @ self.weight + self.shift)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def train(windows: list[bytes], labels: list[str], seed: int = 0) -> ByteCnn:
    """Fit by Adam. Each pass over the sample cuts some windows short, as short texts are."""
    rng, classes = np.random.default_rng(seed), sorted(set(labels))
    y = np.searchsorted(classes, labels)
    x = np.full((len(windows), LENGTH), 0x20, np.uint8)
    for row, window in zip(x, windows):
        row[: len(window)] = _LOWER[np.frombuffer(window, np.uint8)]
    model = ByteCnn.new(classes, rng)
    slow = [np.zeros_like(p) for p in model.parameters()]
    fast = [np.zeros_like(p) for p in model.parameters()]
    step = 0
    for _ in range(EPOCHS if len(classes) > 1 else 0):
        order = rng.permutation(len(x))
        for first in range(0, len(x), BATCH):
            chosen = order[first : first + BATCH]
            batch, step = x[chosen].copy(), step + 1
            for row in batch[: len(batch) // 3]:
                row[rng.integers(16, LENGTH) :] = 0x20
            for p, g, s, f in zip(model.parameters(), model.gradients(batch, y[chosen]), slow, fast):
                s += 0.1 * (g - s)
                f += 0.001 * (g * g - f)
                p -= RATE * (s / (1 - 0.9**step)) / (np.sqrt(f / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Documents kept from learning: one in five, by the checksum of the id; none without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HOLD_OUT == 0, F.lit(False))


def sample(docs: DataFrame) -> DataFrame:
    """Windows to learn from: the texts of smallest hash per language, each once, and places in them by hash.
    At most ``TEXTS_PER_LANGUAGE * WINDOWS_PER_TEXT`` windows a language. Columns: doc_id, text, lang."""
    usable = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    usable = usable.withColumn("digest", F.xxhash64("text")).filter(F.octet_length("text") > 0)
    one_each = usable.groupBy("lang", "digest").agg(F.min("doc_id").alias("doc_id"))
    # the smallest of each part of a language first, so that no task ranks all texts of one
    chosen = one_each.withColumn("part", F.pmod("digest", F.lit(SAMPLE_PARTS)))
    for group in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy("digest", "doc_id"))
        chosen = chosen.withColumn("rank", rank).filter(F.col("rank") <= TEXTS_PER_LANGUAGE)
    chosen = chosen.drop("rank", "part")
    texts = usable.join(chosen, ["lang", "digest", "doc_id"]).dropDuplicates(["lang", "digest", "doc_id"])
    number = F.explode(F.sequence(F.lit(1), F.lit(WINDOWS_PER_TEXT)))
    places = F.greatest(F.octet_length("text") - LENGTH + 1, F.lit(1))
    return texts.withColumn("i", number).select(
        "lang",
        F.substring(F.col("text").cast("binary"), F.pmod(F.xxhash64("digest", "i"), places).cast("int") + 1, F.lit(LENGTH)).alias("window"),
    )


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteCnn | None:
    """Train on the sample; None if there is no labelled text."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = sample(plain).orderBy("lang", "window").limit(MOST_LANGUAGES * TEXTS_PER_LANGUAGE * WINDOWS_PER_TEXT + 1).collect()
    if len({row.lang for row in rows}) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return train([bytes(row.window) for row in rows], [row.lang for row in rows]) if rows else None


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts, the bytes each holds, and the text it is of."""
    counts = np.array([-(-len(t) // LENGTH) for t in texts])
    flat = np.full(int(counts.sum()) * LENGTH, 0x20, np.uint8)
    begin = (np.cumsum(counts) - counts) * LENGTH
    for at, text in zip(begin, texts):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    inner = np.arange(len(owner)) - begin[owner] // LENGTH
    held = np.minimum(np.array([len(t) for t in texts])[owner] - inner * LENGTH, LENGTH)
    return _LOWER[flat].reshape(-1, LENGTH), held, owner


def _mean_probabilities(model: ByteCnn, texts: list[bytes]) -> np.ndarray:
    """Per text, each window weighing as much as it holds."""
    x, held, owner = _windows(texts)
    total = np.zeros((len(texts), len(model.classes)))
    for first in range(0, len(x), WINDOWS_AT_ONCE):
        part = slice(first, first + WINDOWS_AT_ONCE)
        np.add.at(total, owner[part], model.predict(x[part]) * held[part, None])
    return total / np.maximum(total.sum(1, keepdims=True), 1e-300)


def _judged(model: ByteCnn | None, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    ok = np.array([bool(t and _LETTER.search(t)) for t in texts], bool)
    names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    if model and ok.any():
        means = _mean_probabilities(model, [t.encode() if good else b"" for t, good in zip(texts, ok)])
        names[ok] = np.array(model.classes, object)[means.argmax(1)[ok]]
        scores[ok] = np.clip(means.max(1)[ok], 0, 1)
    return names, scores


def _pieces(batches: Iterator[pa.RecordBatch], shared, text_col: str) -> Iterator[tuple]:
    classes, *arrays = shared.value
    model = ByteCnn(classes, *arrays) if classes else None
    for whole in batches:
        for first in range(0, whole.num_rows, WINDOWS_AT_ONCE):
            batch = whole.slice(first, WINDOWS_AT_ONCE)
            yield batch, *_judged(model, batch.column(text_col).to_pylist())


def _shared(spark: SparkSession, model: ByteCnn | None):
    parts = (model.classes, model.tables, model.bias, model.weight, model.shift) if model else (None,)
    return spark.sparkContext.broadcast(parts)


def identify(
    docs: DataFrame, model: ByteCnn | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score, the mean probability of the language over the whole
    text. ``und`` with score 0 for a null text, one without a letter, and without a model. Repeated rows are
    separate; other columns are not read.
    """
    shared = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, names, scores in _pieces(batches, shared, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), held_out(id_col).alias("held_out"))
    return plain.mapInArrow(lean(run), "doc_id bigint, held_out boolean, lang_pred string, score double")


def least_score(model: ByteCnn, lift: float) -> float:
    """The score that lies ``lift`` of the way from chance, which depends on the number of languages, to
    certainty. With one language every text with a letter is in it."""
    chance = 1 / len(model.classes)
    return 0.0 if len(model.classes) == 1 else chance + lift * (1 - chance)


def keep_known(docs: DataFrame, model: ByteCnn | None, lift: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in a learned language with at least ``least_score``.
    Rows are judged where they are; nothing is joined. Null texts and texts without a letter are in none and
    go; repeated rows are judged alike. Without a model, as no text is labelled, nothing can be said and all
    rows stay."""
    if model is None:
        return docs
    least = least_score(model, lift)
    shared = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, names, scores in _pieces(batches, shared, text_col):
            yield batch.filter(pa.array((names != UNKNOWN) & (scores >= least)))

    return docs.mapInArrow(lean(run), docs.schema)
