"""Near-duplicate join on word n-grams: MinHash banding, then verification on full sets.

1. One pass turns each text into a 128-bit hash of its words and one key per
   band of MinHash values.  Equal word sequences collapse to one representative.
2. Representatives shuffle on their band keys; those that share a key are joined
   in a star, never in pairs, and the components of these stars hold every pair
   that banding proposes.
3. The texts of representatives that share a component meet once.  Components
   are cut into blocks of bounded documents and bytes, and each pair of blocks
   is one group: the exact sizes of all intersections come from one product of
   document-by-shingle matrices, so a large group of near copies costs no row
   per pair.  A group returns per document its number of links, and a spanning
   forest of the links.
4. The components of the forests are the classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchstone.llm.common import connected, slices, words_of
from touchstone.session import materialize

SHINGLE, THRESHOLD = 5, 0.8
RECALL, MOST_HASHES = 0.999, 256
BLOCK_DOCUMENTS, BLOCK_BYTES = 512, 16 << 20
_MEMO = 300_000
_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band that still find ``recall`` of the pairs at the threshold.

    A pair of similarity s shares a band with probability ``1 - (1 - s**rows)**bands``;
    more rows let fewer dissimilar pairs through.
    """
    best = None
    for rows in range(1, most_hashes + 1):
        for bands in range(1, most_hashes // rows + 1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                best = (bands, rows)
                break
    if best is None:
        raise ValueError("too few hashes for this recall")
    return best


class Shingler:
    """64-bit hashes of word n-grams; texts with fewer words are one n-gram."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.memo: dict[bytes, int] = {}
        self.weights = [pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j in range(size)]

    def words(self, text: str | None) -> list[bytes]:
        return words_of(text)

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """Distinct n-gram hashes, sorted."""
        memo, hashes = self.memo, []
        for word in words:
            known = memo.get(word)
            if known is None:
                if len(memo) >= _MEMO:
                    memo.clear()
                known = memo[word] = xxhash.xxh64_intdigest(word)
            hashes.append(known)
        ids = np.array(hashes, np.uint64)
        size = min(self.size, len(ids))
        if not size:
            return ids
        total = np.zeros(len(ids) - size + 1, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(size):
                total += ids[j : j + len(total)] * np.uint64(self.weights[j])
                total ^= total >> np.uint64(31)
            total *= np.uint64(0xBF58476D1CE4E5B9)
            total ^= total >> np.uint64(29)
        return np.unique(total)


def _permutations(count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 31, count, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, count, np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty shingle set, in pieces of bounded size."""
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    best = np.full(len(a), 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for start in range(0, len(low), 2048):
            part = low[start : start + 2048]
            mixed = part[None, :] * a[:, None]
            mixed ^= mixed >> np.uint32(15)
            mixed += b[:, None]
            mixed *= np.uint32(0x85EBCA6B)
            np.minimum(best, mixed.min(axis=1), out=best)
    return best


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """``(id, bytes, raw, same, bands)`` of every row with an id and at least one word.

    ``raw`` hashes the text as it is, ``same`` its words, ``bands`` has one key per band.
    """
    text = F.col(text_col)
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("raw"))
    a, b = _permutations(bands * rows)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in slices(batches, "text"):
            ids, raws, same, keys, sizes = [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("id", "text", "raw"))
            for doc, text, raw in zip(*columns, strict=True):
                words = words_of(text)
                if not words:
                    continue
                values = signature(shingler.shingles(words), a, b).reshape(bands, rows)
                ids.append(doc)
                raws.append(raw)
                sizes.append(len(text.encode("utf-8", "surrogatepass")))
                same.append(hashlib.blake2b(b" ".join(words), digest_size=16).hexdigest())
                keys.append([_signed(xxhash.xxh64_intdigest(v.tobytes(), seed=i)) for i, v in enumerate(values)])
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(x, pa.int64()) for x in (ids, sizes, raws)],
                    pa.array(same, pa.string()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["id", "bytes", "raw", "same", "bands"],
            )

    return chosen.where("id is not null and text is not null").mapInArrow(sign, "id long, bytes long, raw long, same string, bands array<long>")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, a few thousand n-grams at a time."""
    count, width = len(sets), 4096
    everything = np.concatenate(sets)
    owner = np.repeat(np.arange(count), [len(s) for s in sets])
    order = np.argsort(everything, kind="stable")
    everything, owner = everything[order], owner[order]
    column = np.cumsum(np.concatenate([[True], everything[1:] != everything[:-1]])) - 1
    often = np.bincount(column) > 1  # an n-gram of one document meets nothing
    keep = often[column]
    column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
    shared = np.zeros((count, count), np.int64)
    edges = np.searchsorted(column, np.arange(0, int(often.sum()) + width, width))
    for k, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        matrix = np.zeros((count, width), np.float32)
        matrix[owner[low:high], column[low:high] - k * width] = 1
        shared += (matrix @ matrix.T).astype(np.int64)
    return shared


def _links(table: pa.Table, size: int, limit: Fraction) -> pa.Table:
    """Links between the documents of one pair of blocks (or inside one block).

    Returns per document ``links``, the rows of other representatives linked to
    it here, and ``root``, the smallest document it is connected with here.
    """
    table = table.sort_by([("node", "ascending"), ("same", "ascending")])
    shingler = Shingler(size)
    node = table.column("node").to_numpy()
    rows = table.column("rows").to_numpy().astype(np.int64)
    sets = [shingler.shingles(words_of(t)) for t in table.column("text").to_pylist()]
    sizes = np.array([len(s) for s in sets], np.int64)
    shared = _intersections(sets)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared * limit.denominator >= union * limit.numerator
    np.fill_diagonal(linked, False)
    block, first = table.column("block").to_numpy(), table.column("i")[0].as_py()
    if first != table.column("j")[0].as_py():  # pairs inside a block belong to the block's own group
        linked &= (block[:, None] == first) != (block[None, :] == first)
    links = np.where(linked, rows[None, :], 0).sum(axis=1)
    label = np.arange(len(sets))
    while True:
        lower = np.minimum(label, np.where(linked, label[None, :], len(sets)).min(axis=1))
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    return pa.table({"same": table.column("same"), "node": node, "links": links, "root": node[label]})


def _verify(
    texts: DataFrame, items: DataFrame, shingle: int, limit: Fraction, block_documents: int, block_bytes: int
) -> DataFrame:
    """``(same, node, links, root)`` from every pair of blocks of every component.

    ``items`` are the representatives: same, node, id, raw, rows, bytes, component.
    """
    cut = items.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block_documents), F.ceil(F.sum("bytes") / block_bytes), F.lit(1)).cast("int").alias("cut")
    )
    cut = cut.select(F.col("component").alias("of"), F.hash("component").alias("spread"), "cut")
    other = F.explode(F.sequence(F.lit(0), F.col("cut") - 1))
    dealt = (
        items.join(cut, (F.col("component") == F.col("of")) & (F.hash("component") == F.col("spread")))
        .withColumn("block", F.pmod(F.xxhash64("same"), F.col("cut")).cast("int"))
        .drop("of", "spread", "bytes")
    )
    met = (
        texts.withColumnRenamed("id", "text_id").join(dealt, (F.col("text_id") == F.col("id")) & (F.col("text_hash") == F.col("raw")))
        .withColumn("other", other)
        .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "same", "node", "rows", "text")
    )
    return met.groupBy("component", "i", "j").applyInArrow(
        lambda table: _links(table, shingle, limit), "same string, node long, links long, root long"
    )


def _classes(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, threshold: float, recall: float, most_hashes: int, block_documents: int, block_bytes: int
) -> DataFrame:
    """``(id, raw, class_id, keeper, n_links)`` of every row with an id and words.

    ``keeper`` is the smallest (id, text hash) of the class.  Classes are made of
    word sequences, which links alone connect; ids play no part in it.
    """
    bands, rows = choose_bands(threshold, recall, most_hashes)
    signed = materialize(signatures(docs, id_col, text_col, shingle, bands, rows))
    # Copies first: one representative per word sequence, whatever the number of copies.
    copies = (
        signed.groupBy("same")
        .agg(F.min(F.struct("id", "raw")).alias("first"), F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes"))
        .select("same", F.col("first.id").alias("id"), F.col("first.raw").alias("raw"), "rows", "bytes", F.monotonically_increasing_id().alias("node"))
    )
    copies = materialize(copies)  # numbers a sequence for good: one id may stand on many
    named = copies.select(F.col("same").alias("of"), "node", F.struct("id", "raw").alias("first"), "rows")
    members = signed.join(named, F.col("same") == F.col("of")).drop("of", "bytes")
    keyed = members.where(F.struct("id", "raw") == F.col("first"))
    keyed = keyed.select("node", F.explode("bands").alias("key"))
    stars = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top")
    stars = stars.select("key", "hub", F.hash("key").alias("spread"))
    edges = keyed.withColumn("spread", F.hash("key")).join(stars, ["key", "spread"])
    candidates = connected(edges.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    items = materialize(copies.join(candidates, "node"))
    text = F.col(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    # A representative whose very row stands more than once must meet others once.
    again = signed.groupBy("id", "raw").count().where("count > 1").select("id", F.col("raw").alias("text_hash"))
    again = materialize(again.join(items.select("id", F.col("raw").alias("text_hash")), ["id", "text_hash"], "left_semi"))
    if not again.isEmpty():
        keys = ["id", "text_hash"]
        once = texts.join(again, keys).groupBy(*keys).agg(F.min("text").alias("text")).select("id", "text", "text_hash")
        texts = texts.join(again, keys, "left_anti").unionByName(once)
    verified = materialize(_verify(texts, items, shingle, Fraction(str(threshold)), block_documents, block_bytes))
    members = materialize(members.select("id", "raw", "same", "node", "first", "rows"))
    linked = verified.groupBy("same").agg(F.sum("links").alias("links"))
    classes = connected(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    found = copies.select("node", F.struct("id", "raw").alias("own")).join(classes, "node")
    least = found.groupBy(F.col("component").alias("of")).agg(F.min("own").alias("keeper"))
    named = found.join(least, F.col("component") == F.col("of")).select(F.col("node").alias("of"), "keeper")
    return (
        members.withColumn("spread", F.hash("same")).join(linked.withColumn("spread", F.hash("same")), ["same", "spread"], "left")
        .join(named, F.col("node") == F.col("of"), "left")
        .withColumn("keeper", F.coalesce("keeper", "first"))
        .select("id", "raw", F.col("keeper.id").alias("class_id"), "keeper", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"))
    )


_OPTIONS = {
    "text_col": "text", "shingle": SHINGLE, "threshold": THRESHOLD, "recall": RECALL, "most_hashes": MOST_HASHES,
    "block_documents": BLOCK_DOCUMENTS, "block_bytes": BLOCK_BYTES,
}


def _settings(given: dict[str, object]) -> dict[str, object]:
    if unknown := set(given) - set(_OPTIONS):
        raise TypeError(f"no such option: {', '.join(sorted(unknown))}")
    return _OPTIONS | given


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **options: object) -> DataFrame:
    """``(doc_id, class_id, n_links)``, one row per row of ``docs`` that has an id and words.

    Two rows are linked if the sets of their word n-grams (``shingle`` words)
    have a Jaccard similarity of at least ``threshold`` (exactly checked); a class
    is what links connect, and ``class_id`` its smallest id.  ``n_links`` counts
    the other rows linked to this one, copies included.  Words are lower-cased
    runs of ASCII letters, digits and non-ASCII characters; a text of fewer words
    than an n-gram has one n-gram.  Other options: ``text_col``, ``recall``,
    ``most_hashes``, ``block_documents``, ``block_bytes``.

    Defined cases: texts without words (null and empty ones too) and rows with a
    null id link to nothing; ``near_duplicate_rows`` lists them as their own
    class (null for a null id).  An id that stands on unlike texts belongs to
    several classes, a row of it to one each; an empty table gives no rows.
    """
    found = _classes(docs, id_col, **_settings(options))
    return found.select(F.col("id").alias(id_col), "class_id", "n_links")


def near_duplicate_rows(docs: DataFrame, *, id_col: str = "doc_id", **options: object) -> DataFrame:
    """``(doc_id, class_id, n_links)`` of every row of ``docs``, linked or not."""
    text_col = str(options.get("text_col", "text"))
    found = near_duplicates(docs, id_col=id_col, **options)
    # Rows without words or id are in no join; all others come back from it.
    rest = docs.where(F.col(id_col).isNull() | ~F.coalesce(F.col(text_col).rlike(_ANY_WORD), F.lit(False)))
    alone = rest.select(F.col(id_col).cast("long").alias(id_col), F.col(id_col).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(alone)


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", **options: object) -> DataFrame:
    """``docs`` with one row of every near-duplicate class, one of its smallest id.

    Rows that link to nothing stay as they are, those with a null id too.  What
    stays is decided by row: of an id that stands on unlike texts, each text
    keeps a row, unless it is a near copy of what stays elsewhere.
    """
    settings = _settings(options)
    found = materialize(_classes(docs, id_col, **settings).select("id", "raw", "keeper"))
    own = F.struct("id", "raw")
    lost = found.where(own != F.col("keeper")).select(F.col("id").alias("_id"), F.col("raw").alias("_raw")).distinct()
    lost = lost.withColumn("_spread", F.hash("_id", "_raw"))
    twice = found.where(own == F.col("keeper")).groupBy(F.col("id").alias("_id"), F.col("raw").alias("_raw")).count().where("count > 1").drop("count")

    doc_id, raw = docs[id_col].cast("long"), F.xxhash64(docs[str(settings["text_col"])])
    same = (doc_id == F.col("_id")) & (raw == F.col("_raw"))
    kept = docs.join(lost, same & (F.hash(doc_id, raw) == F.col("_spread")), "left_anti")
    once, several = kept.join(twice, same, "left_anti"), kept.join(twice, same, "left_semi")
    least = several.groupBy(doc_id, raw).agg(F.min(F.struct(*several.columns)).alias("row")).select("row.*")
    return once.unionByName(least)
