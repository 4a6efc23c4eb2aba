"""Quality classifier: a regularised quadratic discriminant over document statistics.

A document becomes a vector of transformed statistics of its bytes, words and lines. Each label has
a normal density; its covariance is shrunk towards the pooled one and then towards a multiple of the
identity. The score is the logistic of the difference of the log densities, from Mahalanobis distances by
the Cholesky factors of the two covariances, which are computed once.

Fitting needs only counts, sums and sums of products for each label. They are aggregated over all
labelled rows, so the fit is exact at any size and the driver gets one row per label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import held_out, mapped, read, stored

POOLED = 0.1
IDENTITY = 0.01

_GROUPS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\n", ".,;:", "!?", "$%&*#@^~+=", "|<>[]{}()/\\_", "\"'`-")
_CLASS = np.full(256, len(_GROUPS), dtype=np.intp)
for _k, _chars in enumerate(_GROUPS):
    _CLASS[list(_chars.encode())] = _k
_CLASS[128:] = len(_GROUPS) + 1
N_CLASSES = len(_GROUPS) + 2

STATISTICS = (
    *("upper", "lower", "digit", "space", "newline", "stop", "call", "symbol", "bracket", "quote", "control", "beyond_ascii"),
    *("log_bytes", "entropy", "log_words", "word_mean", "word_spread", "distinct_words", "long_words", "marked_words", "capital_words"),
    *("log_lines", "distinct_lines", "words_in_line", "repeated_bytes", "top_word", "numbers"),
)


def _part(value: float) -> float:
    """A proportion on a scale on which its spread depends little on its size."""
    return math.asin(math.sqrt(min(max(value, 0.0), 1.0)))


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of a whole text; those of an empty one are zero."""
    out = np.zeros(len(STATISTICS))
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return out
    n = len(data)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, weights=counts, minlength=N_CLASSES) / n
    seen = counts[counts > 0] / n
    words = data.split()
    lines = [line for line in data.split(b"\n") if line]
    w, l = max(len(words), 1), max(len(lines), 1)
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    tally: dict[bytes, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    marked = sum(n_ for word, n_ in tally.items() if not (48 <= word[-1] <= 57 or 97 <= word[-1] <= 122 or 65 <= word[-1] <= 90 or word[-1] > 127 or word[-1] in b".,"))
    capital = sum(n_ for word, n_ in tally.items() if word[:1].isupper())
    numbers = sum(n_ for word, n_ in tally.items() if word[:1].isdigit())
    distinct = set(lines)
    values = [_part(kind) for kind in kinds]
    values += [
        math.log1p(n),
        float(-(seen * np.log2(seen)).sum()),
        math.log1p(len(words)),
        math.log1p(sizes.mean()),
        math.log1p(sizes.std()),
        _part(len(tally) / w),
        _part(float((sizes > 12).sum()) / w),
        _part(marked / w),
        _part(capital / w),
        math.log1p(len(lines)),
        _part(len(distinct) / l),
        math.log1p(len(words) / l),
        _part(1 - sum(map(len, distinct)) / max(sum(map(len, lines)), 1)),
        _part(max(tally.values(), default=0) / w),
        _part(numbers / w),
    ]
    out[:] = values
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``x``, the statistics, for every row."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(text.as_py()) for text in batch.column(1)]
            flat = pa.array(np.concatenate(rows) if rows else np.empty(0))
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(rows, measured, "doc_id bigint, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, scales and inverse Cholesky factors for the two labels."""

    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    inverses: np.ndarray
    constants: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of statistics."""
        z = (x - self.center) / self.scale
        logs = []
        for mean, inverse, constant in zip(self.means, self.inverses, self.constants, strict=True):
            logs.append(constant - 0.5 * (((z - mean) @ inverse.T) ** 2).sum(axis=1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def discriminant(counts: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled: float = POOLED, identity: float = IDENTITY) -> Discriminant:
    """The model from counts, sums and sums of products of the labels 0 and 1.

    A label without rows gets the density of the other; without any rows every score is 1/2.
    """
    d = sums.shape[1]
    total = max(counts.sum(), 1.0)
    center = sums.sum(axis=0) / total
    scale = np.sqrt(np.maximum(np.diag(products.sum(axis=0)) / total - center**2, 0))
    scale[scale < 1e-6] = 1.0
    means, covariances = [], []
    for n, s, p in zip(counts, sums, products, strict=True):
        if n == 0:
            n, s, p = total, sums.sum(axis=0), products.sum(axis=0)
        mean = s / n
        means.append((mean - center) / scale)
        covariances.append((p / n - np.outer(mean, mean)) / np.outer(scale, scale))
    weights = np.maximum(counts, 1e-9) / np.maximum(counts, 1e-9).sum()
    within = sum(w * c for w, c in zip(weights, covariances, strict=True))
    inverses, constants = [], []
    for n, covariance in zip(counts, covariances, strict=True):
        shrunk = (1 - pooled) * covariance + pooled * within
        shrunk = (1 - identity) * shrunk + identity * max(np.trace(shrunk) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky((shrunk + shrunk.T) / 2)
        inverses.append(np.linalg.inv(factor))
        constants.append(math.log((n + 1) / (total + 2)) - np.log(np.diag(factor)).sum())
    return Discriminant(center, scale, np.array(means), np.array(inverses), np.array(constants))


def fit(measured: DataFrame, labels: DataFrame, pooled: float = POOLED, identity: float = IDENTITY) -> Discriminant:
    """The model from all rows with a label that are not held out; of several labels of an id the smallest counts."""
    known = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").cast("int").alias("label"))
    rows = measured.filter(~held_out()).join(known, F.col("doc_id") == F.col("__id")).select("label", "x")
    d = len(STATISTICS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for k in np.unique(label):
                own = x[label == k]
                held = found.setdefault(int(k), np.zeros(1 + d + d * d))
                held += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        for k, held in found.items():
            places = pa.array(np.arange(len(held), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), k, dtype=np.int32)), places, pa.array(held)], ["label", "at", "v"])

    parts = mapped(rows, sums, "label int, at int, v double").groupBy("label", "at").agg(F.sum("v").alias("v"))
    table = np.zeros((2, 1 + d + d * d))
    for row in parts.collect():  # as many rows as the model has numbers
        table[row["label"], row["at"]] = row["v"]
    return discriminant(table[:, 0], table[:, 1 : 1 + d], table[:, 1 + d :].reshape(2, d, d), pooled, identity)


def score(measured: DataFrame, model: Discriminant) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of statistics."""
    d = len(STATISTICS)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    rows = mapped(measured, scored, "doc_id bigint, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of every row of ``docs``, learnt from the labelled rows among them.

    The statistics are computed once and written; a missing text is an empty one, a row without an id is
    scored and never learnt from. Repeated rows each get their score. Columns beside ``doc_id`` and
    ``text`` (``doc_id`` and ``quality`` of the labels) are ignored. Without labels every score is 1/2.
    """
    measured = stored(with_statistics(docs), "statistics")
    return score(measured, fit(measured, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose predicted quality is 1, with all their columns; each is decided by its own text, whatever its id."""
    known = labels.filter("quality in (0, 1)").select(F.col("doc_id").alias("__known")).distinct()
    rows = docs.select("doc_id", "text")  # the fit needs the statistics of labelled rows alone
    model = fit(stored(with_statistics(rows.join(known.hint("merge"), rows["doc_id"] == known["__known"], "left_semi")), "statistics"), labels)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([statistics(text.as_py()) for text in batch.column(0)])
                yield pa.RecordBatch.from_arrays(batch.columns[1:], names).filter(pa.array(model.scores(x) >= 0.5))

    names = docs.columns
    return mapped(docs.select(F.col("text").cast("string").alias("__judged"), "*"), good, docs.schema)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
