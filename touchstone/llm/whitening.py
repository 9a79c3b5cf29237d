"""Embedding whitening from bit-sliced, exact cross-products.

Components become integers, and each dimension is shifted to start at 0.  Its
values are then cut into bit planes, and every plane is packed across rows, 64
rows to a word.  The sum over rows of the product of two dimensions is the sum
over pairs of their planes of 2**(a + b) times the number of ones in the AND of
the two planes, so sums of products come out of AND and popcount alone, exact
whatever the number of rows.  They are centred as integers, n * sum(xy) -
sum(x) * sum(y), and only the covariance that results becomes floating point for
the eigenvectors: nothing cancels, however far the values lie from 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchstone.llm.topk import quantised
from touchstone.session import materialize

BLOCK_ROWS = 16_384
#: Values must lie below this in size; cross-products travel in limbs of 31 bits.
LARGEST = 1 << 44
_LIMB, _LIMBS = 31, 4


def bit_planes(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Words of all planes, dimension by dimension, of non-negative ``values`` (rows by dimensions).

    Dimension i has ``bits[i]`` planes, the lowest bit first; rows are padded
    with zeros to whole words.
    """
    rows, width = values.shape
    first = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)
    padded = np.zeros((-(-rows // 64) * 64, width), np.int64)
    padded[:rows] = values
    planes = np.empty((int(first[-1]), len(padded) // 64), np.uint64)
    for bit in range(int(bits.max(initial=0))):
        own = np.flatnonzero(bits > bit)
        ones = (padded[:, own] >> bit & 1).astype(np.uint8)
        packed = np.packbits(ones, axis=0, bitorder="little")
        planes[first[own] + bit] = np.ascontiguousarray(packed.T).view("<u8")
    return planes


def cross_products(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """sum over rows of ``values[:, i] * values[:, j]`` for i <= j, exact, as integers."""
    rows, width = values.shape
    planes = bit_planes(values, bits)
    first = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)
    small = 2 * int(bits.max(initial=0)) + rows.bit_length() < 63
    kind = np.int64 if small else object
    weights = np.zeros((int(first[-1]), width), kind)
    for i in range(width):
        for bit in range(int(bits[i])):
            weights[first[i] + bit, i] = 1 << bit
    total = np.zeros((width, width), kind)
    for i in range(width):
        rest, weight = planes[first[i] :], weights[first[i] :, i:]
        for bit in range(int(bits[i])):
            ones = np.bitwise_count(planes[first[i] + bit] & rest).sum(axis=1, dtype=np.int64)
            total[i, i:] += (ones.astype(kind) @ weight) * (1 << bit)
    return total


def _by_width(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """(width, vectors, rows) of blocks of rows whose vectors have one length."""
    for batch in batches:
        widths = batch.column("width").to_numpy()
        for width in np.unique(widths):
            own = batch.filter(pa.array(widths == width))
            for start in range(0, own.num_rows, block_rows):
                block = own.slice(start, block_rows)
                values = block.column("v").flatten().to_numpy(zero_copy_only=False).reshape(block.num_rows, width)
                yield int(width), values, block


def _ranges(rows: DataFrame) -> DataFrame:
    """Rows, sum, smallest and largest value of each dimension; added up in the tasks first."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for width, values, _ in _by_width(batches, BLOCK_ROWS):
            if np.abs(values).max() >= LARGEST:
                raise OverflowError(f"a scaled component is not below {LARGEST}")
            own = held.setdefault(width, [0, np.zeros(width, np.int64), np.full(width, LARGEST), np.full(width, -LARGEST)])
            own[0] += len(values)
            own[1] += values.sum(axis=0)
            own[2] = np.minimum(own[2], values.min(axis=0))
            own[3] = np.maximum(own[3], values.max(axis=0))
        for width, (n, total, low, high) in held.items():
            columns = [np.full(width, width), np.arange(width), np.full(width, n), total, low, high]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["width", "dim", "n", "total", "low", "high"])

    parts = rows.mapInArrow(measure, "width long, dim long, n long, total long, low long, high long")
    wide = F.sum(F.col("total").cast("decimal(38,0)"))
    return parts.groupBy("width", "dim").agg(F.sum("n").alias("n"), wide.alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))


def _scatter(rows: DataFrame, lows: dict[int, np.ndarray], bits: dict[int, np.ndarray], block_rows: int) -> DataFrame:
    """Limbs of the cross-products of shifted values, added up in the tasks first."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for width, values, _ in _by_width(batches, block_rows):
            products = cross_products(values - lows[width], bits[width])
            own = held.setdefault(width, np.zeros((_LIMBS, width, width), np.int64))
            for limb in range(_LIMBS - 1):
                own[limb] += (products & ((1 << _LIMB) - 1)).astype(np.int64)
                products = products >> _LIMB
            own[-1] += products.astype(np.int64)
        for width, own in held.items():
            i, j = np.triu_indices(width)
            columns = [np.full(len(i), width), i, j, *(own[limb][i, j] for limb in range(_LIMBS))]
            names = ["width", "i", "j", *(f"limb{limb}" for limb in range(_LIMBS))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    limbs = [f"limb{limb}" for limb in range(_LIMBS)]
    parts = rows.mapInArrow(measure, "width long, i long, j long, " + ", ".join(f"{x} long" for x in limbs))
    return parts.groupBy("width", "i", "j").agg(*[F.sum(x).alias(x) for x in limbs])


@dataclass
class Whitener:
    """What whitens vectors of one length."""

    n: int
    low: np.ndarray
    #: Sums of the shifted values; n * (x - low) - total is n times the centred value.
    total: list[int]
    bits: int
    #: Columns are unit eigenvectors over the square roots of their eigenvalues.
    axes: np.ndarray
    explained: list[float]

    def centred(self, values: np.ndarray) -> np.ndarray:
        """n * x - sum(x), exact: in longs where they fit."""
        fits = self.n.bit_length() + self.bits < 62
        kind = np.int64 if fits else object
        return (values - self.low).astype(kind) * self.n - np.array(self.total, kind)

    def deviations(self, centred: np.ndarray) -> list[int]:
        """Exact sums of squares of the rows."""
        largest = max(1, int(abs(centred).max(initial=0)))
        if largest * largest * max(1, centred.shape[1]) < 1 << 63:
            return (centred * centred).sum(axis=1).tolist()
        big = centred.astype(object)
        return (big * big).sum(axis=1).tolist()

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.axes


def covariance(n: int, totals: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariance (divisor n) from exact sums, centred as integers before the only rounding."""
    width = len(totals)
    out = np.empty((width, width))
    for (i, j), total in products.items():
        out[i, j] = out[j, i] = (n * total - totals[i] * totals[j]) / (n * n)
    return out


def fit(rows: DataFrame, components: int, block_rows: int = BLOCK_ROWS) -> dict[int, Whitener]:
    """A whitener for each vector length of ``rows(v array<long>, width)``.

    The driver holds, per length, as many numbers as its square.
    """
    ranges = _ranges(rows).collect()
    widths = sorted({r["width"] for r in ranges})
    stats = {w: sorted((r["dim"], r["n"], int(r["total"]), r["low"], r["high"]) for r in ranges if r["width"] == w) for w in widths}
    lows = {w: np.array([s[3] for s in own], np.int64) for w, own in stats.items()}
    bits = {w: np.array([(s[4] - s[3]).bit_length() for s in own]) for w, own in stats.items()}
    products: dict[int, dict[tuple[int, int], int]] = {w: {} for w in widths}
    for r in _scatter(rows, lows, bits, block_rows).collect():
        products[r["width"]][r["i"], r["j"]] = sum(r[f"limb{limb}"] << _LIMB * limb for limb in range(_LIMBS))
    out = {}
    for width in widths:
        n = stats[width][0][1]
        totals = [s[2] - n * s[3] for s in stats[width]]
        spread = covariance(n, totals, products[width])
        values, vectors = np.linalg.eigh(spread)
        values, vectors = values[::-1], vectors[:, ::-1]
        # Below this double precision can't tell a variance from 0 to four digits.
        least = max(values[0], 0) * width * np.finfo(float).eps * 1e4
        kept = int((values[:components] > least).sum())
        values, vectors = values[:kept], vectors[:, :kept]
        # One of the two signs, for good: the largest entry is positive.
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)] < 0, -1.0, 1.0)
        trace = float(np.trace(spread))
        out[width] = Whitener(n, lows[width], totals, int(bits[width].max()), vectors / np.sqrt(values), [float(v) / trace for v in values])
    return out


def whiten(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    offset: int = 0,
    components: int = 8,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(<id>, component, n, deviation, whitened, explained, identity_error)`` per row and component.

    A component c of a vector counts as the integer x = floor(``scale`` * c) +
    ``offset``.  ``deviation`` is the exact sum over dimensions of (n * x -
    sum(x))**2; ``identity_error`` is measured on the whitened rows.

    Defined cases: vectors that are null or empty, or hold null or non-finite
    components, take no part; rows with a null id and rows that repeat an id
    stay, each for itself; each vector length is whitened for itself, with an n
    of its own; directions without variance (all of them if there is one row, or
    all rows are equal) are left out; a scaled component of 2**44 and more is an
    error; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    values = F.transform(quantised(F.col(vector_col), scale), lambda x: x + F.lit(offset).cast("long"))
    rows = (
        vectors.select(F.col(id_col).alias("id"), values.alias("v"))
        .where("v is not null and size(v) > 0")
        .withColumn("width", F.size("v").cast("long"))
    )
    models = fit(rows.select("v", "width"), components, block_rows)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for width, own, block in _by_width(batches, block_rows):
            model = models[width]
            centred = model.centred(own)
            columns = [block.column("id"), block.column("width"), pa.array(model.deviations(centred), pa.decimal128(38, 0)), pa.array(list(model.whitened(centred)), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "width", "deviation", "w"])

    kind = rows.schema["id"].dataType.simpleString()
    projected = materialize(rows.mapInArrow(project, f"id {kind}, width long, deviation decimal(38,0), w array<double>"))
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    wanted = [F.covar_pop(F.get("w", F.lit(a)), F.get("w", F.lit(b))).alias(f"c{a}_{b}") for a, b in pairs]
    found = []
    for row in projected.groupBy("width").agg(*wanted).collect():
        model = models[row["width"]]
        own = [abs(row[f"c{a}_{b}"] - (a == b)) for a, b in pairs if b < len(model.explained)]
        found.append((row["width"], model.n, model.explained, max(own, default=0.0)))
    # One row per vector length.
    told = F.broadcast(spark.createDataFrame(found, "width long, n long, explained array<double>, identity_error double"))
    return (
        projected.join(told, "width")
        .select("id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("w", "explained")).alias("at", "own"))
        .select(
            F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
            F.col("own.w").alias("whitened"), F.col("own.explained").alias("explained"), "identity_error",
        )
    )
