"""Quality scores learned from preference pairs (Bradley-Terry).

A document is a vector of surface features of its whole text. Every training pair holds a
document of label 1 and one of label 0; the chance that the first is preferred is
sigmoid(w . (x1 - x0)), and w maximises the likelihood of all pairs (logistic loss on
feature differences, Newton steps with a ridge). Utilities w . x are thresholded at the
quantile that leaves the training rows' share of label 1 above it; the score is
sigmoid(w . x - threshold) with the threshold moved to `cut`. Far from the threshold (30 either way)
scores are equal.

The weights are fitted on at most `fit_rows` labelled rows (those with the smallest hash of
their id, a documented bound) and at most `fit_pairs` pairs of them. Share and quantile come from
all labelled training rows, the quantile to a rank of 1 in 100,000; every document is scored.

Defined cases: null and empty texts have all features 0 and are scored like any text;
labels that are null or without a document are ignored; a document labelled twice counts
twice; without rows of both labels every score is the share of label 1 (0.5 without any);
a null id is never held out and never learned from; every row gives a row; other columns
are ignored.

Scale: no shuffle of texts. The chosen ids (bounded) are broadcast to find their texts; a pass
over all texts sends ids and utilities to the labels, whose sketches of fixed size are merged;
scoring is one pass more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import Words, mix, pieces

FEATURES = (
    "log words", "mean word bytes", "upper share", "symbol share", "digit share", "non-ASCII share",
    "words ending in a symbol", "words without letters", "long words", "same word twice running",
    "repeated words", "share of the commonest word", "stops per word", "lines per word", "repeated lines",
)


def _byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


UPPER = _byte_set(bytes(range(65, 91)))
LETTER = _byte_set(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
DIGIT = _byte_set(bytes(range(48, 58)))
STOP = _byte_set(b".,;:?'\"()")
#: Marks that prose seldom ends a word with.
SYMBOL = ~(LETTER | DIGIT | STOP | _byte_set(bytes([32, *range(9, 14)])))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeats(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, how many of its keys came before, and how often its commonest one comes."""
    n = len(rows) - 1
    row = np.repeat(np.arange(n), np.diff(rows))
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(k)))
    most = np.zeros(n)
    np.maximum.at(most, r[first], size)
    return np.diff(rows) - np.bincount(r[first], minlength=n), most


def features(column: pa.Array) -> np.ndarray:
    """The feature vectors of a text column."""
    words = Words(column, lower=False)
    n = len(words.rows) - 1
    data, rows = words.data, words.rows
    count = np.diff(rows).astype(np.float64)
    size = words.ends - words.starts
    sizes = _sums(size, rows)
    per_word, per_byte = np.maximum(count, 1), np.maximum(sizes, 1)
    cut = np.concatenate([[0], words.ends])  # every word byte lies before its word's end

    def share(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[data])])
        return _sums(total[words.ends] - total[words.starts], rows) / per_byte

    letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    hashes = words.hashes()
    again, most = _repeats(hashes, rows)
    same = np.zeros(len(words))
    same[1:] = hashes[1:] == hashes[:-1]
    same[rows[:-1][count > 0]] = 0
    # Lines: a word starts a line when a line feed lies between it and the word before.
    feeds = np.concatenate([[0], np.cumsum(data == 10)])
    starts_line = np.ones(len(words), bool)
    starts_line[1:] = feeds[words.starts[1:]] > feeds[cut[1:-1]]
    starts_line[rows[:-1][count > 0]] = True
    at = np.flatnonzero(starts_line)
    line_of = np.searchsorted(at, rows)
    place = np.arange(len(words)) - np.repeat(at, np.diff(np.append(at, len(words))))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(hashes * np.uint64(3)) * (1 + 2 * place).astype(np.uint64), out=total[1:])
    lines = total[np.append(at[1:], len(words))] - total[at] if len(at) else np.zeros(0, np.uint64)
    line_again, _ = _repeats(lines, line_of)
    n_lines = np.maximum(np.diff(line_of), 1)
    last = data[words.ends - 1] if len(words) else np.zeros(0, np.uint8)
    out = np.column_stack(
        [
            np.log1p(count),
            sizes / per_word,
            share(UPPER),
            share(SYMBOL),
            share(DIGIT),
            share(np.arange(256) > 127),
            _sums(SYMBOL[last], rows) / per_word,
            _sums(letters[words.ends] == letters[words.starts], rows) / per_word,
            _sums(size > 30, rows) / per_word,
            _sums(same, rows) / per_word,
            again / per_word,
            most / per_word,
            _sums(STOP[last], rows) / per_word,
            np.diff(line_of) / per_word,
            line_again / n_lines,
        ]
    )
    return out.reshape(n, len(FEATURES))


class PairModel:
    """Weights over standardised features and the threshold of the utilities."""

    def __init__(self, x: np.ndarray, label: np.ndarray, cut: float, pairs: int, ridge: float = 1.0, steps: int = 12, seed: int = 7):
        self.cut, good, bad = cut, np.flatnonzero(label == 1), np.flatnonzero(label == 0)
        self.share = len(good) / len(label) if len(label) else 0.5
        self.weights = None
        if not len(good) or not len(bad):
            return
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = (x - self.mean) / self.scale
        rng = np.random.default_rng(seed)
        d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
        w = np.zeros(x.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            slope = d.T @ p - ridge * w
            curve = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w))
            w = w + np.linalg.solve(curve, slope)
        self.weights = w
        self.threshold = float(np.quantile(self.utilities(x), 1 - self.share))

    def utilities(self, x: np.ndarray) -> np.ndarray:
        """w . x of standardised features; one feature counts for 50 deviations at most."""
        return np.clip((x - self.mean) / self.scale, -50, 50) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.share)
        u = self.utilities(x) - self.threshold
        return 1 / (1 + np.exp(-np.clip(u + np.log(self.cut / (1 - self.cut)), -30, 30)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    cut: float = 0.7,
    fit_rows: int = 6000,
    fit_pairs: int = 30000,
) -> PairModel:
    """A model of the labelled rows for which learn_from (a condition on the id) holds."""
    said = labels.filter(learn_from & F.col(label).isin(0, 1)).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                x = features(part.column("text"))
                yield pa.RecordBatch.from_pydict(
                    {"id": part.column("id"), "label": part.column("label"), "x": pa.array(list(x), pa.list_(pa.float64()))}
                )

    # The weights, from a bounded sample. Rows are chosen by narrow columns; repeated ones are one row.
    chosen = said.orderBy(F.xxhash64("id"), "id", "label").limit(fit_rows).distinct()
    found = texts.withColumn("hash", F.xxhash64("text")).join(F.broadcast(chosen), "id")
    once = found.groupBy("id", "label", "hash").agg(F.first("text").alias("text")).orderBy(F.xxhash64("id"), "id", "label", "hash").limit(fit_rows)
    held = sorted((r["id"], r["label"], r["x"]) for r in once.select("id", "text", "label").mapInArrow(rows, "id long, label int, x array<double>").collect())
    x = np.array([r[2] for r in held]).reshape(-1, len(FEATURES))
    model = PairModel(x, np.array([r[1] for r in held]), cut, fit_pairs)
    if model.weights is None:
        return model

    # Share and quantile, from all labelled rows: each task sends ids and utilities, no texts.
    def utilities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                u = model.utilities(features(part.column("text")))
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "u": pa.array(u)})

    # A row counts once for each label; 100,000 cells keep a quantile's rank to 1 in 100,000.
    n, good = texts.select("id").join(said, "id").agg(F.count("*"), F.sum("label")).first()
    model.share = good / n
    rated = texts.mapInArrow(utilities, "id long, u double").join(said.select("id"), "id")
    # Between the last utility that is to stay below and the first one above.
    ranks = [min(1.0, max(0.0, (n - good + half) / n)) for half in (-0.5, 0.5)]
    model.threshold = sum(rated.agg(F.percentile_approx("u", ranks, 100_000)).first()[0]) / 2
    return model


def scores(docs: DataFrame, model: PairModel, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted (score >= cut) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                score = model.score(features(part.column("text")))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "held_out": part.column("held_out"),
                        "score": pa.array(score),
                        "predicted": pa.array((score >= model.cut).astype(np.int32)),
                    }
                )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: PairModel, text: str = "text") -> DataFrame:
    """The rows of docs that the model accepts, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                yield part.filter(pa.array(model.score(features(part.column(text))) >= model.cut))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
