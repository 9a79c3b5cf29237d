"""Line-level deduplication across documents, in DataFrame functions only.

Two narrow passes and one wide join.  Pass one turns every text into an array of
128-bit line keys and counts, per key, the distinct documents that hold it and
the largest of them.  Pass two brings the losing keys back to their documents as
positions.  The texts themselves move once, to meet the positions; a document is
put together again from the lines that stay, in their order, without ever being
taken apart into rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchstone.llm.common import LOWER, SPACES, UPPER

MIN_CHARS, MIN_DOCUMENTS = 40, 5


def lines_of(text: Column) -> Column:
    """Lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z in lower case, other letters as they are."""
    stripped = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(stripped) == F.char_length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, UPPER, LOWER))


def _long_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, text hash, position, h1, h2) of every line whose key is long enough."""
    text = F.col(text_col)
    return (
        docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text"), F.posexplode(lines_of(text)).alias("pos", "line"))
        .where(F.char_length("line") >= min_chars)
        .withColumn("key", line_key(F.col("line")))
        .where(F.char_length("key") >= min_chars)
        .select("_id", "_text", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )


def dropped_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``(_id, _text, _dropped)``: per document the positions (from 0) of the lines it loses.

    A line is lost if its key has at least ``min_chars`` code points and stands
    in at least ``min_documents`` documents, of which this is not the one with
    the largest id.  Documents that lose nothing are not listed.  ``_text`` is a
    hash of the text, which tells rows apart that repeat an id.
    """
    lines = _long_lines(docs, id_col, text_col, min_chars)
    # Once per document first, so that repeats inside one text count once and a
    # line that stands everywhere is spread by document before it is counted.
    held = lines.where(F.col("_id").isNotNull()).groupBy("h1", "h2", "_id").agg(F.lit(1).alias("one"))
    common = (
        held.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("documents"), F.max("_id").alias("_keeper"))
        .where(F.col("documents") >= min_documents)
        .select(F.col("h1").alias("_k1"), F.col("h2").alias("_k2"), F.hash("h1").alias("_k3"), "_keeper")
    )
    # The extra hash makes the join shuffle both sides anew, which lets adaptive
    # execution split the rows of a very common line.
    hit = lines.withColumn("h3", F.hash("h1")).join(
        common,
        (F.col("h1") == F.col("_k1")) & (F.col("h2") == F.col("_k2")) & (F.col("h3") == F.col("_k3")) & (F.col("_id") != F.col("_keeper")),
    )
    return hit.groupBy("_id", "_text").agg(F.sort_array(F.collect_set("pos")).alias("_dropped"))


def dedup_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    counts: Sequence[str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """Documents without the lines that many documents share.

    Every row and column of ``docs`` stays; ``text_col`` holds the lines that
    are left, joined by a line feed, and the two columns named in ``counts``
    (replacing columns of those names) the lines before and the lines dropped.

    Defined cases: a null or empty text is one empty line and comes back empty;
    rows that repeat an id are one document (a key counts once for the id, each
    row loses its own lines); a null id is no document, so its row counts for no
    line and keeps all of its own; an empty table gives an empty table.
    """
    total, lost = counts
    drops = dropped_lines(
        docs, id_col=id_col, text_col=text_col, min_chars=min_chars, min_documents=min_documents
    )
    drops = drops.select("_id", "_text", F.hash("_id").alias("_spread"), "_dropped")
    text = F.col(text_col)
    split = docs.select(
        *[F.col(c).alias(f"c_{c}") for c in docs.columns if c not in (text_col, total, lost)],
        F.col(id_col).alias("_row_id"),
        F.xxhash64(text).alias("_row_text"),
        F.hash(id_col).alias("_row_spread"),
        lines_of(text).alias("_lines"),
    )
    same = (
        (F.col("_row_id") == F.col("_id"))
        & (F.col("_row_text") == F.col("_text"))
        & (F.col("_row_spread") == F.col("_spread"))
    )
    joined = split.join(drops, same, "left").withColumn("_gone", F.coalesce("_dropped", F.array().cast("array<int>")))
    last = F.size("_lines") - 1
    stay = F.array_except(F.sequence(F.lit(0), last), F.col("_gone"))
    kept = F.when(F.size("_gone") == 0, F.array_join("_lines", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n")
    )
    made = {text_col: kept, total: F.size("_lines").cast("long"), lost: F.size("_gone").cast("long")}
    order = [*docs.columns, *[c for c in counts if c not in docs.columns]]
    return joined.select(*[made[c].alias(c) if c in made else F.col(f"c_{c}").alias(c) for c in order])
