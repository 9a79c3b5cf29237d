"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchstone.session import ensure_checkpoint_dir, materialize

#: ASCII white space, as a character class and as the characters themselves.
NON_SPACE = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes outside [0-9A-Za-z] and below 0x80 become spaces, A-Z become a-z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids fall in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path inside the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def fresh_name(columns: list[str], base: str) -> str:
    """A column name like ``base`` that is not among ``columns`` (in any case)."""
    taken, name = {c.lower() for c in columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of one piece hold about ``limit`` bytes, one row at least."""
    for batch in batches:
        total = batch.column(column).nbytes
        if total <= limit or batch.num_rows <= 1:
            yield batch
            continue
        sizes = [len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(column).cast(pa.binary())]
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def connected(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a long, b long)`` as ``(node, component)``.

    ``component`` is the smallest node of the component; nodes without an edge to
    another node are not listed.  Each round hooks every group of equal labels to
    the smallest label seen around it and follows hooks to their ends by pointer
    doubling, so a component's groups at least halve each round whatever its
    diameter.
    Tables are keyed by node or label and checkpointed every round.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = materialize(both.union(edges.select("b", "a")).where("node <> other").distinct())
    labels = materialize(
        both.groupBy("node")
        .agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("label"))
    )
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("label").alias("seen"))
        around = both.join(seen, "other").groupBy("node").agg(F.min("seen").alias("seen"))
        hooks = (
            labels.join(around, "node")
            .groupBy("label")
            .agg(F.min("seen").alias("low"))
            .where("low < label")
        )
        hooks = materialize(hooks)
        if hooks.isEmpty():
            return labels.withColumnRenamed("label", "component")
        while True:  # follow hooks to their ends, twice as far each time
            further = hooks.select(F.col("label").alias("low"), F.col("low").alias("lower"))
            jumped = materialize(hooks.join(further, "low", "left").select("label", "low", "lower"))
            hooks = jumped.select("label", F.coalesce("lower", "low").alias("low"))
            if jumped.where("lower is not null").isEmpty():
                break
        labels = materialize(
            labels.join(hooks, "label", "left").select("node", F.coalesce("low", "label").alias("label"))
        )
