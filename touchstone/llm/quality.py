"""Quality by regularised quadratic discriminant analysis of document statistics.

One pass over the texts makes a dozen transformed statistics per document, which
are kept as a narrow table.  Labelled rows give class counts, means and second
moments, summed in Spark over all of them; the driver only sees those sums.
Class covariances are shrunk to the pooled one and to a multiple of the
identity, their Cholesky factors are computed once and sent to the tasks, and
the score comes from the difference of the two log densities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchstone.llm.common import slices
from touchstone.llm.tabular import training_labels
from touchstone.session import materialize

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_STOPS = b".,;:'\"-?()"
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in _STOPS)
FEATURES = (
    "log_words", "word_length", "upper", "digits", "marks", "stops", "bangs", "bars", "variety", "stutter", "repeated_lines", "line_length",
)


def _share(part: float, whole: float) -> float:
    """A share on a log scale that tells 0 from little and little from much."""
    return math.log(part / whole + 1e-3) if whole else math.log(1e-3)


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text, in the order of ``FEATURES``."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    lines = data.split(b"\n")
    size, count = len(data), len(words)

    def of(chars: bytes) -> float:
        return _share(size - len(data.translate(None, chars)), size)

    return [
        math.log1p(count),
        math.log1p(sum(map(len, words)) / count if count else 0.0),
        of(_UPPER),
        of(_DIGITS),
        of(_MARKS),
        of(_STOPS),
        _share(data.count(b"!"), size),
        _share(data.count(b"|"), size),
        math.log(len(set(words)) + 1) - 0.9 * math.log(count + 1),
        _share(sum(map(eq, words, words[1:])), count),
        _share(len(lines) - len(set(lines)), len(lines)),
        math.log1p(size / len(lines)),
    ]


def document_statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, stats)`` of every row; no shuffle."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            stats = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(stats, pa.list_(pa.float64()))], names=["id", "stats"])

    return rows.mapInArrow(compute, schema)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log terms of both classes."""

    prior: float
    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray | None = None
    inverse: np.ndarray | None = None
    constant: np.ndarray | None = None

    def log_odds(self, stats: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(stats), self.prior)
        x = (stats - self.center) / self.scale
        parts = []
        for mean, inverse, constant in zip(self.means, self.inverse, self.constant, strict=True):
            parts.append(constant - 0.5 * np.square((x - mean) @ inverse.T).sum(axis=1))
        return self.prior + parts[1] - parts[0]


def moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label: rows, sums and sums of products, over all of ``labelled(_label, stats)``."""
    width = len(FEATURES)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            marks = batch.column("_label").to_numpy(zero_copy_only=False)
            x = np.array(batch.column("stats").flatten().to_numpy(zero_copy_only=False)).reshape(-1, width)
            x = np.hstack([np.ones((len(x), 1)), x])
            for label in (0, 1):
                own = x[marks == label]
                total[label] = total.get(label, 0) + own.T @ own
        for label, products in total.items():
            flat = products.ravel()
            cells = [pa.array([label] * len(flat), pa.int32()), pa.array(range(len(flat)), pa.int32()), pa.array(flat, pa.float64())]
            yield pa.RecordBatch.from_arrays(cells, names=["label", "cell", "value"])

    sums = labelled.select("_label", "stats").mapInArrow(partial, "label int, cell int, value double")
    out = {}
    cells = np.zeros((2, (width + 1) ** 2))
    for row in sums.groupBy("label", "cell").agg(F.sum("value").alias("value")).collect():  # 2 x 169 rows
        cells[row["label"], row["cell"]] = row["value"]
    for label in (0, 1):
        full = cells[label].reshape(width + 1, width + 1)
        out[label] = (full[0, 0], full[0, 1:], full[1:, 1:])
    return out


def fit(labelled: DataFrame, *, pooled: float = 0.1, ridge: float = 0.02) -> Discriminant:
    """Discriminant of ``labelled(_label, stats)``.

    ``pooled`` is how far a class covariance moves to the pooled one, ``ridge``
    how far to the identity, both after scaling to unit variance.  With one class
    or none the score is the smoothed share of label 1.
    """
    sums = moments(labelled)
    n0, n1 = sums[0][0], sums[1][0]
    prior = math.log((n1 + 1.0) / (n0 + 1.0))
    width = len(FEATURES)
    total = n0 + n1
    if n0 < 2 or n1 < 2:
        return Discriminant(prior, np.zeros(width), np.ones(width))
    center = (sums[0][1] + sums[1][1]) / total
    spread = np.diag(sums[0][2] + sums[1][2]) / total - center**2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    means, scatter = [], []
    for label in (0, 1):
        n, s, p = sums[label]
        mean = s / n
        scatter.append((p - n * np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - center) / scale)
    common = (scatter[0] + scatter[1]) / total
    inverse, constant = [], []
    for label, n in ((0, n0), (1, n1)):
        own = (1 - pooled) * scatter[label] / n + pooled * common
        own = (1 - ridge) * own + ridge * max(np.trace(own) / width, 1e-3) * np.eye(width)
        factor = np.linalg.cholesky(own)
        inverse.append(np.linalg.inv(factor))
        constant.append(-np.log(np.diag(factor)).sum())
    return Discriminant(prior, center, scale, np.array(means), np.array(inverse), np.array(constant))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out_fold: int = 0,
    **shrinkage: float,
) -> DataFrame:
    """``(id, score)`` of every row of ``docs``; learned from the labels outside one fold.

    The score is monotone in the log odds of label 1, which it takes on a log
    scale so that far tails stay apart: 0.5 is even odds.

    Defined cases: null and empty texts get the score of their (empty)
    statistics; rows that repeat an id are each scored, and each counts in the
    fit; a null id is scored but never learned from; without labels of both
    classes all scores are the smoothed share of label 1 (0.5 without labels).
    """
    stats = materialize(document_statistics(docs, id_col=id_col, text_col=text_col))
    train = training_labels(labels, label_col, id_col=id_col, held_out_fold=held_out_fold)
    model = fit(stats.join(train, F.col("id") == F.col("_label_id")), **shrinkage)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers
    schema = T.StructType([stats.schema["id"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("stats").flatten().to_numpy(zero_copy_only=False)).reshape(-1, len(FEATURES))
            odds = shared.value.log_odds(x)
            squashed = 1 / (1 + np.exp(-np.sign(odds) * np.log1p(np.abs(odds))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(squashed, pa.float64())], names=["id", "score"])

    return stats.mapInArrow(score, schema)
