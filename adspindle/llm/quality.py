"""Quality classifier: regularised quadratic discriminant on document statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspindle.llm.text import in_task, shingles_of, slices, words_of
from adspindle.sources.workspace import Workspace

FEATURES = (
    "word_length", "symbols", "exclamations", "capitals", "digits", "points",
    "distinct_words", "stutter", "repeated_runs", "lines",
)
CALM_CHARS, CALM_WORDS, CALM_RUNS = 200, 40, 150
DIM = len(FEATURES)
# Shrinkage of a class covariance: towards the pooled one, and of both towards their diagonal's mean.
TO_POOLED = 0.1
TO_SPHERE = 0.05
FOLDS, HELD_OUT = 3, 1
# Where only labelled documents are measured, about so many of them, chosen by a hash of their ids; fewer are all used.
FIT_DOCS = 200_000

_symbols = np.isin(np.arange(256), list(b"#*$%&|<>@^~=_{}[]\\+/"))
_points = np.isin(np.arange(256), list(b".,;:?"))
_digits = np.isin(np.arange(256), list(b"0123456789"))
_letters = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
_capitals = np.isin(np.arange(256), [*range(65, 91)])


def fold(doc_id: Column) -> Column:
    """The fold of a document, 0 to 2; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def _per_text(hits: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(hits, dtype=np.int64)])
    return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)


def _distinct(numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.array([len(np.unique(numbers[a:b])) for a, b in zip(first[:-1], first[1:])], dtype=float)


def document_statistics(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """[texts, FEATURES]: transformed statistics of whole texts; all zero for an empty one."""
    words = words_of(offsets, data)
    n = np.diff(words.first).astype(float)
    chars = _per_text((data & 0xC0) != 0x80, offsets)
    two_byte = np.zeros(len(data), dtype=bool)
    two_byte[1:] = data[:-1] == 0xC3
    capitals = _capitals[data] | (two_byte & (data >= 0x80) & (data <= 0x9E))
    letters = _letters[data] | two_byte
    same = np.zeros(len(words.number) + 1, dtype=np.int64)
    if len(words.number) > 1:
        same[1:-1] = words.number[1:] == words.number[:-1]
    same[words.first[:-1]] = 0
    same = same[:-1]
    runs, first = shingles_of(words)
    n_runs = np.diff(first)
    in_words = _per_text(np.isin(data, [32, 9, 10, 11, 12, 13], invert=True), offsets)
    distinct = _distinct(words.number, words.first)
    # Shares are taken as if some inconspicuous text followed, or a few words would decide them.
    chars, letters = chars + CALM_CHARS, _per_text(letters, offsets) + CALM_CHARS
    many, n_runs = n + CALM_WORDS, n_runs + CALM_RUNS
    columns = [
        np.log((in_words + 5 * CALM_WORDS) / many) * (n > 0),
        np.sqrt(_per_text(_symbols[data], offsets) / chars),
        np.sqrt(_per_text(data == ord("!"), offsets) / chars),
        np.sqrt(_per_text(capitals, offsets) / letters),
        np.sqrt(_per_text(_digits[data], offsets) / chars),
        np.sqrt(_per_text(_points[data], offsets) / chars),
        np.log((distinct + CALM_WORDS) / many) * (n > 0),
        np.sqrt(_per_text(same, words.first) / many),
        np.sqrt((np.diff(first) - _distinct(runs, first)) / n_runs),
        np.sqrt(_per_text(data == 10, offsets) / many),
    ]
    return np.stack(columns, axis=1)


def _measure(batches: Iterator[pa.RecordBatch], only: Sequence | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if only is not None:
            kind = batch.schema.field("doc_id").type
            batch = batch.filter(pc.is_in(batch.column("doc_id"), value_set=pa.array(only, kind)))
        kept = [batch.column(n) for n in batch.schema.names if n != "__text"]
        names = [n for n in batch.schema.names if n != "__text"]
        found = [document_statistics(o, d) for _, o, d in slices(batch.column("__text"))]
        x = np.concatenate(found) if found else np.zeros((0, DIM))
        vectors = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), DIM).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*kept, vectors], names=[*names, "x"])


@dataclass(frozen=True)
class Discriminant:
    """Per class its mean, the inverse of its covariance's Cholesky factor, and the constant of its log density."""

    means: np.ndarray
    whiten: np.ndarray
    constant: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1: the logistic of the difference of the classes' log densities."""
        logs = [
            self.constant[c] - 0.5 * (((x - self.means[c]) @ self.whiten[c].T) ** 2).sum(axis=1) for c in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit_discriminant(counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant | None:
    """From both classes' counts, sums and sums of products; None unless each class has a row."""
    if (counts < 1).any():
        return None
    means = sums / counts[:, None]
    scatter = products - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(axis=0) / counts.sum()
    spread = np.sqrt(np.diag(pooled) + 1e-6)  # features are put on one scale before the sphere is mixed in
    whiten, constant = [], []
    for c in (0, 1):
        own = (1 - TO_POOLED) * scatter[c] / counts[c] + TO_POOLED * pooled
        own = own / np.outer(spread, spread)
        own = (1 - TO_SPHERE) * own + TO_SPHERE * max(np.trace(own) / DIM, 1e-3) * np.eye(DIM)
        factor = np.linalg.cholesky(own) * spread[:, None]
        whiten.append(np.linalg.inv(factor))
        constant.append(np.log(counts[c] / counts.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.stack(whiten), np.array(constant))


def learn(measured: DataFrame, labels: DataFrame) -> Discriminant | None:
    """Sums over all labelled rows outside the held-out fold; only the two classes' sums reach the driver."""
    usable = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("__id"), "quality").distinct()
    rows = measured.where(fold(F.col("doc_id")) != HELD_OUT).select(F.col("doc_id").alias("__d"), "x")
    joined = rows.join(usable, F.col("__d") == F.col("__id"))
    x = [F.col("x")[i] for i in range(DIM)]
    pairs = [(i, k) for i in range(DIM) for k in range(i + 1)]
    found = joined.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("sums"),
        F.array(*[F.sum(x[i] * x[k]) for i, k in pairs]).alias("products"),
    )
    counts, sums, products = np.zeros(2), np.zeros((2, DIM)), np.zeros((2, DIM, DIM))
    for row in found.collect():
        c = row["quality"]
        counts[c], sums[c] = row["n"], row["sums"]
        for (i, k), value in zip(pairs, row["products"]):
            products[c, i, k] = products[c, k, i] = value
    return fit_discriminant(counts, sums, products)


def _score(batches: Iterator[pa.RecordBatch], model: Discriminant | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIM)
        scores = model.scores(x) if model else np.full(len(x), 0.5)
        kept = [batch.column(n) for n in batch.schema.names if n != "x"]
        names = [n for n in batch.schema.names if n != "x"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], names=[*names, "score"])


def classify_quality(docs: DataFrame, labels: DataFrame, workspace: Workspace) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    One pass measures whole texts and writes the statistics; the model is learnt from those of labelled
    rows outside the held-out fold, and all rows are scored from the written table. Only the text is
    measured: labels, language, source and doc_id are no inputs of a score.

    A null text is empty and scored as such; a null doc_id is in no held-out fold and never labelled.
    Labels other than 0 and 1 are not used; equal rows have equal scores. Without a label of each class
    every score is 0.5. An empty table gives no rows. Only ``doc_id`` and ``text`` are read of ``docs``,
    ``doc_id`` and ``quality`` of ``labels``.
    """
    measured, _ = workspace.save(measure(docs), "statistics")
    model = learn(measured, labels)
    return predictions(measured, model)


def fitting_ids(labels: DataFrame, fit_docs: int = FIT_DOCS) -> list:
    """Ids of documents to learn from: those with a label of 0 or 1 that are in no held-out fold.

    Beyond about ``fit_docs`` of them a share is taken by a hash of the id, so that they can be sent to the texts.
    """
    ids = labels.where("quality IN (0, 1)").where(fold(F.col("doc_id")) != HELD_OUT)
    ids = ids.where("doc_id IS NOT NULL").select("doc_id").distinct()
    share = fit_docs / max(ids.count(), 1)
    if share < 1:
        ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**30)) < int(share * 2**30))
    return [r[0] for r in ids.collect()]


def measure(docs: DataFrame, only: Sequence | None = None) -> DataFrame:
    """``doc_id, x`` of every row, or of rows with one of the ids ``only``: its statistics.

    Those of a null or empty text are all zero. Equal rows have equal statistics; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.col("text").alias("__text"))
    return narrow.mapInArrow(in_task(_measure, only), f"doc_id {kind}, x array<double>")


def predictions(measured: DataFrame, model: Discriminant | None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every measured row; without a model every score is 0.5.

    A null doc_id is in no held-out fold; equal rows have equal scores; an empty table gives no rows.
    """
    kind = measured.schema["doc_id"].dataType.simpleString()
    scored = measured.mapInArrow(in_task(_score, model), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Discriminant | None) -> DataFrame:
    """Rows of ``docs`` whose text the model doesn't reject, unchanged and in one pass.

    A null text is judged like an empty one; of equal rows all or none stay; without a model all do. Columns
    other than ``text`` may have any names.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_statistics(o, d) for _, o, d in slices(batch.column("text"))]
            x = np.concatenate(found) if found else np.zeros((0, DIM))
            good = model.scores(x) >= 0.5 if model else np.ones(len(x), dtype=bool)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(in_task(kept), docs.schema)
