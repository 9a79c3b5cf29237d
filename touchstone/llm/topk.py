"""Exact top-k inner-product search with ball trees and branch and bound.

Candidates are dealt into shards of a bounded number of vectors, queries into
blocks; a pair of a shard and a block is one group.  A group builds a ball tree
over its shard and walks it best bound first: a node's bound for a query is the
inner product with its centre plus the length of the query times its radius.
Queries walk in batches of neighbours and share what they have: each carries its
k-th score so far, and a node is opened only for the queries whose k-th score
its bound still reaches.  A first round over one shard per query gives all later
groups a k-th score to start from.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS, BLOCK_QUERIES = 16_384, 16_384
LEAF, BATCH = 256, 64
_NONE = -(1 << 63)


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null or not finite."""
    usable = vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


@dataclass
class Node:
    low: int
    high: int
    center: np.ndarray
    radius: float
    children: tuple[Node, Node] | None = None


def build(points: np.ndarray, order: np.ndarray, low: int, high: int, leaf: int) -> Node:
    """Ball tree over ``points[order[low:high]]``; ``order`` is rearranged in place."""
    own = points[order[low:high]]
    center = own.mean(axis=0)
    radius = math.sqrt(float(np.square(own - center).sum(axis=1).max()))
    node = Node(low, high, center, radius)
    if high - low > leaf and radius > 0:
        # Split between two far points, half and half, so equal points can't unbalance it.
        far = own[np.square(own - center).sum(axis=1).argmax()]
        other = own[np.square(own - far).sum(axis=1).argmax()]
        along = own @ (other - far)
        half = (high - low) // 2
        order[low:high] = order[low:high][np.argpartition(along, half)]
        node.children = (build(points, order, low, low + half, leaf), build(points, order, low + half, high, leaf))
    return node


def _best(query: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best per query, ties to the smaller id."""
    order = np.lexsort((ident, -score, query))
    query, score, ident = query[order], score[order], ident[order]
    start = np.searchsorted(query, query)
    keep = np.arange(len(query)) - start < k
    return query[keep], score[keep], ident[keep]


def search(
    points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int, *, leaf: int = LEAF, batch: int = BATCH
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query place, score, id) of the k best per query with a score of at least ``floor``.

    All vectors are integers, so scores are exact: in doubles where no sum can
    pass 2**53, else in 64-bit integers.
    """
    largest = max(1, int(np.abs(points).max(initial=0))) * max(1, int(np.abs(queries).max(initial=0))) * max(1, points.shape[1])
    if largest >= 1 << 63:
        raise OverflowError("an inner product may not fit in a long")
    exact = np.float64 if largest < 1 << 53 else np.int64
    order = np.arange(len(points))
    spread = points.astype(np.float64)
    root = build(spread, order, 0, len(points), leaf)
    sorted_points, sorted_ids = points[order].astype(exact), ids[order]
    about = queries.astype(np.float64)
    lengths = np.sqrt(np.square(about).sum(axis=1))
    turn = np.arange(len(queries))
    if len(queries) > batch:
        build(about, turn, 0, len(queries), batch)  # neighbours walk together
    slack = 1e-9
    for start in range(0, len(turn), batch):
        own = turn[start : start + batch]
        kth = floor[own].copy()
        found = (np.empty(0, np.int64), np.empty(0, exact), np.empty(0, np.int64))

        def bound(node: Node, at: np.ndarray) -> np.ndarray:
            top = about[at] @ node.center + lengths[at] * node.radius
            return top + slack * (np.abs(top) + lengths[at]) + 1e-6

        heap = [(-float("inf"), 0, root, np.arange(len(own)), np.full(len(own), np.inf))]
        pushed = 0
        while heap:
            _, _, node, at, tops = heapq.heappop(heap)
            at = at[tops >= kth[at]]
            if not len(at):
                continue
            if node.children:
                for child in node.children:
                    tops = bound(child, own[at])
                    reach = tops >= kth[at]
                    if reach.any():
                        pushed += 1
                        heapq.heappush(heap, (-float(tops[reach].max()), pushed, child, at[reach], tops[reach]))
                continue
            block_ids = sorted_ids[node.low : node.high]
            scores = queries[own[at]].astype(exact) @ sorted_points[node.low : node.high].T
            good = (scores >= kth[at][:, None]) & (block_ids[None, :] != query_ids[own[at]][:, None])
            row, column = np.nonzero(good)
            if not len(row):
                continue
            merged = [np.concatenate(x) for x in zip(found, (at[row], scores[row, column], block_ids[column]), strict=True)]
            found = _best(*merged, k)
            full = np.bincount(found[0], minlength=len(own)) >= k
            last = np.searchsorted(found[0], np.arange(len(own)), side="right") - 1
            kth[full] = np.maximum(kth[full], found[1][last[full]])
        yield own[found[0]], found[1].astype(np.int64), found[2]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


_FOUND = pa.schema([("query", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def _group(key: tuple, points: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    if not len(points) or not len(queries):
        return _FOUND.empty_table()
    width = key[0].as_py()
    ids, query_ids, rows = points.column("id").to_numpy(), queries.column("q_id").to_numpy(), queries.column("row").to_numpy()
    floor = queries.column("floor").to_numpy().astype(np.float64)
    parts = list(search(_matrix(points.column("v"), width), ids, _matrix(queries.column("q_v"), width), query_ids, floor, k))
    place, score, ident = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.table([query_ids[place], rows[place], ident, score], schema=_FOUND)


def _meet(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Groups of one shard and one block of queries of the same width."""
    keys = ["width", "shard", "block"]
    # Both sides come from one table: new names keep their columns apart.
    queries = queries.select(*[F.col(c).alias(c if c in ("row", "floor") else f"q_{c}") for c in queries.columns])
    grouped = points.groupBy(*keys).cogroup(queries.groupBy(*[f"q_{c}" for c in keys]))
    return grouped.applyInArrow(
        lambda key, left, right: _group(key, left, right, k), "query long, row long, id long, score long"
    )


def top_inner_products(
    vectors: DataFrame,
    queries: Column,
    k: int,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``(query_id, rank, <id>, score)``: the k rows of largest inner product per query.

    ``queries`` says which rows ask; they ask among all rows but those of their
    own id.  Vectors are compared as integers, floor(``scale`` * x).  Ties go to
    the smaller id.

    Defined cases: vectors that are null or hold null or non-finite components,
    and rows with a null id, take no part; vectors meet only vectors of their own
    length; rows that repeat an id and a vector count once, other rows that
    repeat an id are candidates of their own (each asks on its own, and a query
    id then has ranks for each of its vectors); a query with fewer than k
    candidates gets all there are; an empty table gives no rows.
    """
    # Repeats go before anything is compared; counted in the tasks first.
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"), queries.alias("asks"))
        .where("id is not null and v is not null")
        .groupBy("id", "v").agg(F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
        .withColumns({"width": F.size("v"), "row": F.xxhash64("id", "v")})
    )
    spark = vectors.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = vectors.count()
    # Never fewer shards than tasks, so that a small table is spread as well.
    shards = max(-(-total // shard_rows), min(2 * partitions, -(-total // LEAF)), 1)
    blocks = max(1, -(-vectors.where(queries).count() // block_queries))
    shard = F.pmod("row", F.lit(shards)).cast("int")
    asked = rows.where("asks").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    points = rows.select("id", "v", "width", shard.alias("shard"))

    # Round one: a query meets one shard and learns how good its k-th score is at least.
    home = asked.withColumns({"shard": shard, "floor": F.lit(_NONE).cast("long")})
    first = _meet(
        points.withColumn("block", F.lit(0)), home.withColumn("block", F.lit(0)).select("id", "v", "row", "width", "shard", "block", "floor"), k
    )
    first = first.groupBy(F.col("query").alias("of"), F.col("row").alias("of_row")).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth")
    )
    known = asked.join(first, (F.col("id") == F.col("of")) & (F.col("row") == F.col("of_row")), "left")
    everywhere = known.select(
        "id", "v", "row", "width", "block", F.coalesce("kth", F.lit(_NONE)).alias("floor"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    spread = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = _meet(spread, everywhere, k)
    place = Window.partitionBy("query", "row").orderBy(F.desc("score"), "id")
    return (
        met.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), "rank", F.col("id").alias(id_col), "score")
    )
