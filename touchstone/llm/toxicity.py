"""Toxicity by a factorization machine over hashed terms.

A document is its set of hashed terms: words, and the first letters of longer
words, which catch inflected insults.  Besides a weight each term has a short
vector, and two terms in one document add the product of theirs, so an insult
beside a group's name can weigh more than the two apart.  The machine is fitted
on a bounded sample of labelled rows; scoring reads every whole text once,
without a shuffle, and only needs the terms the model kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchstone.llm.common import slices, words_of
from touchstone.llm.tabular import training_labels

#: Labelled rows the machine learns from at most (those with the smallest id hashes).
SAMPLE_ROWS = 10_000
#: Terms with a weight at most (those that tell the classes apart best).
TERMS = 4096
_SPACE = 1 << 31
_MEMO = 300_000


def terms_of(word: bytes) -> tuple[int, ...]:
    """Hashed terms of one word: itself, and its first four and five characters."""
    text = word.decode("utf-8", "surrogatepass")
    parts = [b"w" + word]
    parts += [b"p%d" % n + text[:n].encode("utf-8", "surrogatepass") for n in (4, 5) if len(text) > n]
    return tuple(xxhash.xxh32_intdigest(p) % _SPACE for p in parts)


@dataclass(frozen=True)
class FactorizationMachine:
    """``bias + sum w_i + sum_{i<j} <v_i, v_j>`` over the terms a document has."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, places: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """Margins of ``rows`` documents; ``owner[k]`` has the term at ``places[k]``."""
        out = np.full(rows, self.bias)
        out += np.bincount(owner, self.weights[places], rows)
        for f in range(self.factors.shape[1]):
            v = self.factors[places, f]
            out += 0.5 * (np.bincount(owner, v, rows) ** 2 - np.bincount(owner, v * v, rows))
        return out


def _select(offsets: np.ndarray, terms: np.ndarray, labels: np.ndarray, limit: int) -> np.ndarray:
    """Terms that tell the classes apart best, by signed root of the chi-square statistic."""
    found, place = np.unique(terms, return_inverse=True)
    owner = np.repeat(np.arange(len(labels)), np.diff(offsets))
    n, ones = len(labels), labels.sum()
    held = np.bincount(place, minlength=len(found)).astype(float)
    toxic = np.bincount(place, labels[owner], len(found))
    expected = held * ones / n
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = np.abs(toxic - expected) / np.sqrt(expected * (1 - ones / n) * (1 - held / n) + 1e-9)
    chi[held < 3] = 0
    best = np.lexsort((found, -chi))[:limit]
    return np.sort(found[best[chi[best] > 1.5]])


def fit(
    offsets: np.ndarray,
    terms: np.ndarray,
    labels: np.ndarray,
    *,
    limit: int = TERMS,
    factors: int = 4,
    epochs: int = 25,
    rate: float = 0.1,
    decay: float = 2e-4,
    seed: int = 7,
) -> FactorizationMachine:
    """Fit by AdaGrad on the logistic loss, in small batches.

    Row i has the distinct terms ``terms[offsets[i]:offsets[i + 1]]``.  One class
    alone, or no row, leaves the smoothed log odds as the bias.
    """
    n, ones = len(labels), float(labels.sum())
    bias = float(np.log((ones + 1) / (n - ones + 1)))
    chosen = _select(offsets, terms, labels, limit) if 0 < ones < n else np.empty(0, np.int64)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(chosen)), rng.normal(0, 0.02, (len(chosen), factors))
    model = FactorizationMachine(bias, chosen, w, v)
    if not len(chosen):
        return model
    spot = np.minimum(np.searchsorted(chosen, terms), len(chosen) - 1)
    known = chosen[spot] == terms
    owner = np.repeat(np.arange(n), np.diff(offsets))[known]
    places = spot[known]
    start = np.searchsorted(owner, np.arange(n + 1))
    gw, gv, gb = np.full(len(chosen), 1e-6), np.full(v.shape, 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(n)
        for batch in np.array_split(order, max(1, n // 128)):
            take = np.concatenate([np.arange(start[i], start[i + 1]) for i in batch])
            at = places[take]
            row = np.repeat(np.arange(len(batch)), start[batch + 1] - start[batch])
            margin = FactorizationMachine(bias, chosen, w, v).margins(at, row, len(batch))
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[batch]) / len(batch)
            step = error.sum()
            gb += step**2
            bias -= rate * step / np.sqrt(gb)
            used, slot = np.unique(at, return_inverse=True)
            slope = np.bincount(slot, error[row], len(used)) + decay * w[used]
            gw[used] += slope**2
            w[used] -= rate * slope / np.sqrt(gw[used])
            for f in range(factors):
                own = v[at, f]
                rest = np.bincount(row, own, len(batch))[row] - own
                slope = np.bincount(slot, error[row] * rest, len(used)) + decay * v[used, f]
                gv[used, f] += slope**2
                v[used, f] -= 0.3 * rate * slope / np.sqrt(gv[used, f])
    return FactorizationMachine(bias, chosen, w, v)


def _distinct(words: Iterable[bytes], memo: dict[bytes, tuple[int, ...]]) -> set[int]:
    out: set[int] = set()
    for word in set(words):
        own = memo.get(word)
        if own is None:
            if len(memo) >= _MEMO:
                memo.clear()
            own = memo[word] = terms_of(word)
        out.update(own)
    return out


def _sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, fold: int, rows: int):
    """Term sets and labels of the sampled rows, on the driver."""
    chosen = training_labels(labels, label_col, id_col=id_col, held_out_fold=fold)
    chosen = chosen.orderBy(F.xxhash64("_label_id"), "_label_id", "_label").limit(rows)
    # At most ``rows`` ids and labels, so this side is small whatever the tables.
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(
        F.broadcast(chosen), F.col("_id") == F.col("_label_id")
    )
    # Rows that repeat an id would make the sample grow: the smallest text counts.
    texts = texts.groupBy("_id", "_label").agg(F.min("text").alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, tuple[int, ...]] = {}
        for batch in slices(batches, "text"):
            sets = [sorted(_distinct(words_of(t), memo)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.array(sets, pa.list_(pa.int32()))], names=["_id", "_label", "terms"]
            )

    schema = T.StructType([texts.schema["_id"], T.StructField("_label", T.IntegerType()), T.StructField("terms", T.ArrayType(T.IntegerType()))])
    table = texts.mapInArrow(extract, schema).toArrow()
    table = table.sort_by([("_id", "ascending"), ("_label", "ascending")])
    sets = table.column("terms").combine_chunks()
    sizes = sets.value_lengths().to_numpy(zero_copy_only=False) if len(table) else np.empty(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    terms = sets.flatten().to_numpy(zero_copy_only=False).astype(np.int64) if len(table) else np.empty(0, np.int64)
    return offsets, terms, table.column("_label").to_numpy().astype(float)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    score_col: str = "score",
    held_out_fold: int = 0,
    sample_rows: int = SAMPLE_ROWS,
    **settings: float,
) -> DataFrame:
    """``docs`` with the probability of label 1 of every whole text in ``score_col``.

    Learns from at most ``sample_rows`` labelled rows outside the held-out fold.

    Defined cases: null and empty texts have no terms and get the bias; a column
    of the score's name is replaced; rows are never merged; of rows that repeat
    an id the smallest text is learned from; a null id is scored but not learned
    from; without labels of both classes every score is the smoothed share of
    label 1 (0.5 without labels).
    """
    model = fit(*_sample(docs, labels, label_col, id_col, text_col, held_out_fold, sample_rows), **settings)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most TERMS terms
    kept = [c for c in docs.columns if c != score_col]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(score_col, T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        place = {int(t): i for i, t in enumerate(machine.terms)}
        memo: dict[bytes, tuple[int, ...]] = {}
        for batch in slices(batches, text_col):
            places: list[int] = []
            sizes = []
            for text in batch.column(text_col).to_pylist():
                own: set[int] = set()
                for word in set(words_of(text)):
                    known = memo.get(word)
                    if known is None:
                        if len(memo) >= _MEMO:
                            memo.clear()
                        known = memo[word] = tuple(place[t] for t in terms_of(word) if t in place)
                    if known:
                        own.update(known)
                places += sorted(own)
                sizes.append(len(own))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            margin = machine.margins(np.array(places, np.int64), owner, len(sizes))
            probability = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(probability, pa.float64())], names=[*kept, score_col]
            )

    return docs.select(*kept).mapInArrow(score, schema)
