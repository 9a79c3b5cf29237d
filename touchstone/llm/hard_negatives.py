"""Hard negatives by vertical scans with branch and bound over dimensions.

Candidates are dealt into shards that lie in a task dimension by dimension.  An
anchor reads its dimensions in the order of their size in its own vector.  After
every few dimensions, the least and most that the unread ones can still add
(from the smallest and largest value of each) bound every candidate's score, and
candidates that can no longer matter leave the bitmap, so later dimensions are
read for fewer and fewer rows.

Two scans: the first finds each anchor's best rows of its own label; the second
finds, for each of those positives, the best rows of other labels whose score
lies in the window that the positive's score spans.  What is in the bitmap at
the end has its exact score, in integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchstone.llm.topk import quantised
from touchstone.session import materialize

SHARD_ROWS, BLOCK_ANCHORS = 32_768, 8_192
STEP = 8
#: Label buckets keep one label's rows together; no more of them than this.
MAX_BUCKETS = 4_096

Prune = Callable[[np.ndarray, np.ndarray], np.ndarray]


class Shard:
    """Candidates of one width, stored by dimension."""

    def __init__(self, values: np.ndarray, ids: np.ndarray, labels: np.ndarray, reach: int) -> None:
        """``reach`` is the largest size of a component of any anchor."""
        width = values.shape[1]
        largest = max(1, reach) * max(1, int(np.abs(values).max(initial=0))) * max(1, width)
        if largest >= 1 << 62:
            raise OverflowError("an inner product may not fit in a long")
        self.kind = np.float64 if largest < 1 << 53 else np.int64  # exact in either
        self.columns = np.ascontiguousarray(values.T.astype(self.kind))
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.ids, self.labels = ids, labels

    def scan(self, anchor: np.ndarray, rows: np.ndarray, prune: Prune, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of those of ``rows`` that ``prune`` never rules out.

        ``prune(least, most)`` says which candidates stay, given bounds on their scores.
        """
        anchor = anchor.astype(self.kind)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])[:, order]
        rest = np.zeros((2, len(order) + 1), self.kind)
        rest[0, :-1] = np.cumsum(ends.min(axis=0)[::-1])[::-1]
        rest[1, :-1] = np.cumsum(ends.max(axis=0)[::-1])[::-1]
        score = np.zeros(len(rows), self.kind)
        for start in range(0, len(order) + step, step):
            if start:
                own = order[start - step : start]
                score = score + anchor[own] @ self.columns[own[:, None], rows[None, :]]
            read = min(start, len(order))
            stays = prune(score + rest[0, read], score + rest[1, read])
            if not stays.all():
                rows, score = rows[stays], score[stays]
            if not len(rows):
                break
        return rows, score.astype(np.int64)

    def best(self, rows: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Places in ``rows`` of the k best, ties to the smaller id."""
        if len(rows) > 4 * k:
            some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        else:
            some = np.arange(len(rows))
        return some[np.lexsort((self.ids[rows[some]], -score[some]))[:k]]


def top_bound(k: int) -> Prune:
    """Keep what may still be among the k best: no k others are surely better."""

    def prune(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        if len(least) <= k:
            return np.ones(len(least), bool)
        return most >= np.partition(least, len(least) - k)[len(least) - k]

    return prune


def window_bound(windows: list[tuple[int, int]], k: int) -> Prune:
    """Keep what may still be among the k best inside one of the windows."""

    def prune(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(least), bool)
        for low, high in windows:
            may = (most >= low) & (least <= high)
            sure = least[(least >= low) & (most <= high)]
            if len(sure) > k:
                may &= most >= np.partition(sure, len(sure) - k)[len(sure) - k]
            stays |= may
        return stays

    return prune


def score_window(score: int, low_percent: int, high_percent: int) -> tuple[int, int]:
    """Whole scores s with low_percent * score <= 100 * s <= high_percent * score."""
    return -(-low_percent * score // 100), high_percent * score // 100


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _group(points: pa.Table, anchors: pa.Table) -> tuple[Shard, np.ndarray, np.ndarray, np.ndarray] | None:
    """A shard, and the vectors, ids and labels of the anchors that ask in it."""
    if not len(points) or not len(anchors):
        return None
    width = points.column("width")[0].as_py()
    asked = _matrix(anchors.column("a_v"), width)
    both = pa.chunked_array([*points.column("label").chunks, *anchors.column("a_label").chunks])
    labels = both.combine_chunks().dictionary_encode().indices.to_numpy()
    shard = Shard(_matrix(points.column("v"), width), points.column("id").to_numpy(), labels[: len(points)], int(np.abs(asked).max(initial=0)))
    return shard, asked, anchors.column("a_id").to_numpy(), labels[len(points) :]


_BEST = pa.schema([("row", pa.int64()), ("anchor", pa.int64()), ("positive", pa.int64()), ("positive_score", pa.int64())])
_MINED = pa.schema([("row", pa.int64()), ("anchor", pa.int64()), ("place", pa.int32()), ("positive", pa.int64()), ("positive_score", pa.int64()), ("negative", pa.int64()), ("negative_score", pa.int64())])


def _table(parts: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*parts, strict=True), schema, strict=True)], schema=schema) if parts else schema.empty_table()


def _positives(points: pa.Table, anchors: pa.Table, k: int) -> pa.Table:
    group, out = _group(points, anchors), []
    if group:
        shard, asked, ids, labels = group
        prune = top_bound(k)
        for at, row in enumerate(anchors.column("row").to_pylist()):
            mine = np.flatnonzero((shard.labels == labels[at]) & (shard.ids != ids[at]))
            rows, score = shard.scan(asked[at], mine, prune)
            for place in shard.best(rows, score, k):
                out.append((row, int(ids[at]), int(shard.ids[rows[place]]), int(score[place])))
    return _table(out, _BEST)


def _negatives(points: pa.Table, anchors: pa.Table, k: int, low: int, high: int) -> pa.Table:
    group, out = _group(points, anchors), []
    if group:
        shard, asked, ids, labels = group
        found = zip(*(anchors.column(c).to_pylist() for c in ("row", "positives")), strict=True)
        for at, (row, positives) in enumerate(found):
            spans = [score_window(p["positive_score"], low, high) for p in positives]
            windows = sorted({s for s in spans if s[0] <= s[1]})
            if not windows:
                continue
            others = np.flatnonzero((shard.labels != labels[at]) & (shard.ids != ids[at]))
            rows, score = shard.scan(asked[at], others, window_bound(windows, k))
            for place, (positive, (least, most)) in enumerate(zip(positives, spans, strict=True)):
                inside = np.flatnonzero((score >= least) & (score <= most))
                for spot in inside[shard.best(rows[inside], score[inside], k)]:
                    out.append((row, int(ids[at]), place, positive["positive"], positive["positive_score"], int(shard.ids[rows[spot]]), int(score[spot])))
    return _table(out, _MINED)


def _meet(points: DataFrame, anchors: DataFrame, scan: Callable[[pa.Table, pa.Table], pa.Table], schema: pa.Schema) -> DataFrame:
    """Run ``scan`` on every group of a shard and the anchors of a block that ask in it."""
    keys = ["width", "bucket", "piece", "block"]
    anchors = anchors.select(*[F.col(c).alias(f"a_{c}") if c in ("id", "v", "label", *keys) else F.col(c) for c in anchors.columns])
    kinds = ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'long'}" for f in schema)
    grouped = points.groupBy(*keys).cogroup(anchors.groupBy(*[f"a_{c}" for c in keys]))
    return grouped.applyInArrow(lambda left, right: scan(left, right), kinds)


def mine_hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    *,
    id_col: str = "vec_id",
    label: Column | None = None,
    vector_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    shard_rows: int = SHARD_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Vectors count as integers, floor(``scale`` * x); a score is an inner product.
    For each of an anchor's ``positives`` best rows of its own ``label`` (a
    column, ``label`` if not given), the ``negatives`` best rows of other labels
    with ``low_percent`` * positive score <= 100 * score <= ``high_percent`` *
    positive score.  Ties go to the smaller id.  ``anchors`` says which rows ask.

    Defined cases: rows with a null id, a null label or a null vector, or with
    null or non-finite components, take no part; vectors meet only vectors of
    their own length; rows that agree in id, label and vector count once, other
    rows that repeat an id are rows of their own, and never positives or
    negatives of their own id; an anchor with fewer rows gets all there are, one
    without positives none; a positive with a negative score has an empty
    window; an empty table gives no rows.
    """
    label = F.col("label") if label is None else label
    spark = vectors.sparkSession
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), quantised(F.col(vector_col), scale).alias("v"), anchors.alias("asks"))
        .where("id is not null and label is not null and v is not null and size(v) > 0")
        .groupBy("id", "label", "v").agg(F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
        .withColumns({"width": F.size("v"), "row": F.xxhash64("id", "label", "v")})
    )
    rows = materialize(rows)
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("asks"))
    size = sizes.agg(F.sum("rows").alias("rows"), F.sum("asks").alias("asks"), F.max("rows").alias("most")).first()
    total, asking, most = (size[c] or 0 for c in ("rows", "asks", "most"))
    # A label lies in one bucket, cut into as many pieces as the largest label needs.
    pieces = max(1, -(-most // shard_rows))
    buckets = min(MAX_BUCKETS, max(1, -(-total // (shard_rows * pieces))))
    blocks = max(1, -(-asking // block_anchors), -(-2 * int(spark.conf.get("spark.sql.shuffle.partitions")) // (pieces * buckets)))
    place = {
        "bucket": F.pmod(F.xxhash64("label"), F.lit(buckets)).cast("int"),
        "piece": F.pmod("row", F.lit(pieces)).cast("int"),
    }
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    points = rows.select("id", "label", "v", "width", *[c.alias(n) for n, c in place.items()], every_block.alias("block"))
    asked = rows.where("asks").select("id", "label", "v", "width", "row", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))

    # An anchor's own label lies in one bucket; the others may lie in any.
    every_piece = F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))
    own = asked.select("*", place["bucket"].alias("bucket"), every_piece.alias("piece"))
    best = _meet(points, own, lambda left, right: _positives(left, right, positives), _BEST)
    order = Window.partitionBy("row", "anchor").orderBy(F.desc("positive_score"), "positive")
    best = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    # Few per anchor, in their order.
    listed = best.groupBy(F.col("row").alias("of_row"), F.col("anchor").alias("of")).agg(
        F.array_sort(F.collect_list(F.struct("place", "positive", "positive_score"))).alias("positives")
    )
    known = asked.join(listed, (F.col("row") == F.col("of_row")) & (F.col("id") == F.col("of"))).drop("of_row", "of")
    shards = F.explode(F.sequence(F.lit(0), F.lit(pieces * buckets - 1)))
    known = known.select("*", shards.alias("shard"))
    known = known.select(*[c for c in known.columns if c != "shard"], F.expr(f"shard div {pieces}").cast("int").alias("bucket"), (F.col("shard") % pieces).cast("int").alias("piece"))
    mined = _meet(points, known, lambda left, right: _negatives(left, right, negatives, low_percent, high_percent), _MINED)
    order = Window.partitionBy("row", "anchor", "place").orderBy(F.desc("negative_score"), "negative")
    return (
        mined.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select(
            F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"),
            "positive_score", "negative_score",
        )
    )
