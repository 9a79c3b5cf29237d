"""Benchmark decontamination by a broadcast hash set of n-gram windows.

Benchmark items are cut into windows of n words, which are hashed; tasks hash
every window of the documents' words in whole batches, look the hashes up, and
verify each hit word by word.  The windows are broadcast in blocks of a fixed
number of words, so what is broadcast never grows with the benchmark: each
further block is one more pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchstone.llm.common import slices, words_of
from touchstone.session import materialize

WINDOW = 10
BLOCK_WORDS = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = regex.compile(rb"[0-9A-Za-z\x80-\xff]+")


class WindowSet:
    """Windows of one block of benchmark items, by length and hash."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int) -> None:
        self.words: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        self.windows: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for place, (_, words) in enumerate(items):
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in words]
            size = min(window, len(ids))
            known = self.windows.setdefault(size, {})
            for start in range(len(ids) - size + 1):
                owners = known.setdefault(tuple(ids[start : start + size]), [])
                if not owners or owners[-1] != place:
                    owners.append(place)
        self.windows.pop(0, None)
        self.hashes = {
            size: np.unique(_rolled(np.array(list(known), np.uint64).reshape(-1), size)[::size])
            for size, known in self.windows.items()
        }

    def hits(self, words: list[bytes], limits: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """(start, length, item places) of verified windows.

        ``words`` are the words of several documents, ``limits`` where each
        document ends; a window never crosses a limit.
        """
        get = self.words.get
        ids = np.array([get(w, 0) for w in words], np.uint64)
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for size, hashes in self.hashes.items():
            if len(ids) < size:
                continue
            starts = np.nonzero(unknown[size:] == unknown[:-size])[0]
            if not len(starts):
                continue
            ends = limits[np.searchsorted(limits, starts, side="right")]
            starts = starts[starts + size <= ends]
            rolled = _rolled(ids, size)[starts]
            spot = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
            known = self.windows[size]
            for start in starts[hashes[spot] == rolled].tolist():
                owners = known.get(tuple(ids[start : start + size].tolist()))
                if owners is not None:
                    yield start, size, owners


def _rolled(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` ids."""
    count = len(ids) - size + 1
    total = np.zeros(max(count, 0), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            total = total * _BASE + ids[j : j + count] * np.uint64(0xD6E8FEB86659FD93)
            total ^= total >> np.uint64(29)
    return total


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[DataFrame]:
    """Benchmark items dealt into blocks of about ``block_words`` words."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    words = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    blocks = max(1, -(-words // block_words))
    for block in range(blocks):
        yield items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)


def match_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with ``_n_words``, ``_spans`` and ``_items``.

    ``_spans`` are the ``[from, to)`` word ranges that windows of benchmark items
    cover, merged and in order; ``_items`` the sorted ids (as text) of the items
    with a window in the document.  A window is ``window`` consecutive words of
    an item, or the whole item where it has fewer; an item without words has none.
    Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters.

    Defined cases: null and empty texts have no words; a null item id is never
    named among the items, though its windows do cover words; items that repeat
    an id or a text count once; an empty benchmark or document table gives no hit.
    """
    added = [
        T.StructField("_n_words", T.LongType()),
        T.StructField("_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("_items", T.ArrayType(T.StringType())),
    ]
    kept = [c for c in docs.columns if c not in {f.name for f in added}]
    schema = T.StructType([docs.schema[c] for c in kept] + added)
    context = docs.sparkSession.sparkContext
    found = docs.select(*kept)
    for number, block in enumerate(_blocks(benchmark, item_col, item_text_col, block_words)):
        if number:
            found = materialize(found)  # one block at a time in a worker
        rows = block.distinct().collect()
        shared = context.broadcast([(row["item"], words_of(row["text"])) for row in rows])
        found = found.mapInArrow(_matcher(shared, kept, text_col, window), schema)
    return found


def _matcher(shared, kept: list[str], text_col: str, window: int):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WindowSet(shared.value, window)
        for batch in slices(batches, text_col, 4 << 20):
            words: list[bytes] = []
            ends = []
            for text in batch.column(text_col).to_pylist():
                words += words_of(text)
                ends.append(len(words))
            limits = np.array(ends, np.int64)
            spans: dict[int, list[list[int]]] = {}
            items: dict[int, set[str]] = {}
            for start, size, owners in sorted(known.hits(words, limits)):
                row = int(np.searchsorted(limits, start, side="right"))
                offset = start - (ends[row - 1] if row else 0)
                own = spans.setdefault(row, [])
                if own and own[-1][1] >= offset:
                    own[-1][1] = max(own[-1][1], offset + size)
                else:
                    own.append([offset, offset + size])
                items.setdefault(row, set()).update(n for o in owners if (n := known.names[o]) is not None)
            n_words = np.diff(limits, prepend=0)
            new_spans = [spans.get(i, []) for i in range(batch.num_rows)]
            new_items = [items.get(i, set()) for i in range(batch.num_rows)]
            if "_spans" in batch.schema.names:  # an earlier block's
                for i, (s, o) in enumerate(zip(batch.column("_spans").to_pylist(), batch.column("_items").to_pylist(), strict=True)):
                    new_spans[i] = _merged(s + new_spans[i])
                    new_items[i] |= set(o)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array(n_words, pa.int64()),
                    pa.array(new_spans, pa.list_(pa.list_(pa.int32()))),
                    pa.array([sorted(x) for x in new_items], pa.list_(pa.string())),
                ],
                names=[*kept, "_n_words", "_spans", "_items"],
            )

    return match


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def cut_words(text: str, spans: list[list[int]]) -> str:
    """``text`` without the words of the given ranges; what is around them stays.

    Of the characters between two removed words nothing stays.
    """
    data = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(data)]
    kept, at = [], 0
    for start, end in spans:
        kept.append(data[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    action: str = "documents",
    text_col: str = "text",
    **options: object,
) -> DataFrame:
    """Documents freed of benchmark passages; columns as in ``docs``.

    ``action="documents"`` drops every document with a hit, ``"spans"`` keeps all
    documents and cuts the hit words out of ``text_col``.
    """
    if action not in ("documents", "spans"):
        raise ValueError(f"unknown action {action!r}")
    # Numbered names keep columns of any name apart from the ones that are added.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema, text_at = numbered.schema, f"c{docs.columns.index(text_col)}"
    found = match_benchmark(numbered, benchmark, text_col=text_at, **options)
    if action == "documents":
        return found.where(F.size("_spans") == 0).select(*numbered.columns).toDF(*docs.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_at):
            texts = batch.column(text_at).to_pylist()
            spans = batch.column("_spans").to_pylist()
            clean = [cut_words(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            columns = [pa.array(clean, pa.string()) if c == text_at else batch.column(c) for c in schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return found.mapInArrow(cut, schema).toDF(*docs.columns)
