"""Token ids on disk: frequency-ranked, byte-aligned, control bytes apart from data.

A first pass tokenises every text, once, and keeps the ids as Parquet in the
shared folder.  Ids are then numbered by falling count, so the frequent ones get
small ranks, and a rank takes one to four bytes.  How many is said by two bits
in a control byte of its own, four ranks to a control byte, so decoding looks up
the lengths of four ranks at once and never branches on data.

A second pass codes each document where its ids lie, and moves only the codes:
documents go to parts by ascending id, whose bounds and first positions are
settled before, from the numbers of ids alone, and each part is cut into files
of about ``FILE_IDS`` ids.  Every file says at which position of the whole
stream it starts, so files are read in any order and on their own.

A file is a header (``_HEADER``), then per document its id (8 bytes), whether it
has one (1 byte) and its number of ids (8 bytes), then all control bytes, then
all data bytes, little-endian, and a closing line feed.  A document's control
bytes start afresh, so a document can be cut out of a file as it is.
"""

from __future__ import annotations

import json
import os
import struct
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchstone.llm.common import shared_folder, slices

FILE_IDS = 1 << 22
MAX_PARTS = 20_000
_CACHE_PIECES = 600_000
_TEXT_BYTES, _OUT_BYTES, _STEP = 4 << 20, 8 << 20, 1 << 18

#: The word pattern of vocabularies that drop white space.
_DROPS_SPACE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_MAGIC = b"TRC1"
#: Mark, documents, ids, first position, control bytes, data bytes.
_HEADER = struct.Struct("<4sIQQQQ")

#: Bytes of each of the four ranks of a control byte, and the mask for a length.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


#: Letters, and marks that never join them in a word.  Not among the marks:
#: apostrophes, which bind to letters.
_LETTERS = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}"
_MARKS = r"!-&(-/:;=?@\[-`{}~"
_WORDS_AT_ONCE = 100


class Encoder:
    """Ids of whole texts as the tokenizers library gives them, without added specials.

    Where the vocabulary drops white space and case, Arrow cuts texts into
    pieces, the library sees each distinct piece once, and ids are gathered
    piece by piece.  Pieces of letters alone go to it many to a text.  Other
    vocabularies, and texts with the string of an added token, go whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one thread
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_piece = _space_separates(spec)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t["content"].lower() for t in spec["added_tokens"]]
        if self.by_piece:
            vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
            self.closes = np.zeros(max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1, bool)
            self.closes[[i for token, i in vocab.items() if token.endswith(end)]] = True
        self._forget()

    def _forget(self) -> None:
        self.pieces = pa.array([], pa.string())
        self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.uint32)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(found.ids, np.uint32) for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: pa.Array) -> None:
        """Add the ids of pieces without spaces to what is known."""
        letters = pc.match_substring_regex(pieces, f"^[{_LETTERS}]+$")
        words, other = pieces.filter(letters), pieces.filter(pc.invert(letters))
        bounds = np.append(np.arange(0, len(words), _WORDS_AT_ONCE), len(words)).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(bounds, words), " ").to_pylist()
        ids = np.concatenate([np.empty(0, np.uint32), *self._library(texts)])
        # A word of letters ends where a token closes a word.
        sizes = np.diff(np.flatnonzero(self.closes[ids]), prepend=-1)
        if len(sizes) != len(words):
            raise ValueError("the vocabulary does not close each word")
        alone = self._library(other.to_pylist())
        self.pieces = pa.concat_arrays([self.pieces, words, other])
        self.sizes = np.concatenate([self.sizes, sizes, np.array([len(a) for a in alone], np.int64)])
        self.ids = np.concatenate([self.ids, ids, *alone])

    def _by_piece(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
        for pattern in (f"([{_LETTERS}])([{_MARKS}])", f"([{_MARKS}])([{_LETTERS}])"):
            cut = pc.replace_substring_regex(cut, pattern, r"\1 \2")
        cut = pc.split_pattern(cut, " ")
        coded = cut.flatten().dictionary_encode()
        found = pc.index_in(coded.dictionary, self.pieces)
        if found.null_count:
            missing = coded.dictionary.filter(found.is_null())
            if len(self.pieces) + len(missing) > _CACHE_PIECES:
                self._forget()
                missing = coded.dictionary
            self._learn(missing)
            found = pc.index_in(coded.dictionary, self.pieces)
        places = found.to_numpy(zero_copy_only=False)[coded.indices.to_numpy(zero_copy_only=False)]
        each, starts = self.sizes[places], np.cumsum(self.sizes) - self.sizes
        ends = np.concatenate([[0], np.cumsum(each)])
        # Where each id of the output lies among the known ones: piece after piece.
        at = np.repeat(starts[places] - ends[:-1], each) + np.arange(int(ends[-1]))
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))])
        return self.ids[at], np.diff(ends[bounds])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in a row, and the number of ids of each; a null has none."""
        texts = pc.fill_null(texts, "")
        whole = np.full(len(texts), not self.by_piece)
        if self.by_piece:
            for content in self.added:
                whole |= pc.match_substring(pc.ascii_lower(texts), content).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_piece(texts)
        alone = self._library(texts.filter(pa.array(whole)).to_pylist())
        ids, sizes = self._by_piece(texts.filter(pa.array(~whole))) if not whole.all() else (np.empty(0, np.uint32), np.empty(0, np.int64))
        pieces, ends = iter(alone), iter(np.cumsum(sizes))
        parts, at = [], 0
        for own in whole:
            if own:
                parts.append(next(pieces))
            else:
                end = next(ends)
                parts.append(ids[at:end])
                at = end
        return np.concatenate([np.empty(0, np.uint32), *parts]), np.array([len(part) for part in parts], np.int64)


def _space_separates(spec: dict) -> bool:
    """Whether text may be cut at spaces, line feeds and marks, and lower-cased, without changing any id."""
    normal = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = normal["normalizers"] if normal["type"] == "Sequence" else [normal]
    plain = all(
        s["type"] in ("NFC", "Lowercase") or (s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " ")
        for s in steps
    )
    cutter = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    drops = (
        cutter.get("type") == "Split" and cutter["pattern"] == {"Regex": _DROPS_SPACE}
        and cutter["behavior"] == "Removed" and cutter["invert"]
    )
    alone = all(
        not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not any(c.isspace() for c in t["content"]) for t in spec["added_tokens"]
    )
    ends = bool(spec["model"].get("end_of_word_suffix")) and not spec["model"].get("dropout")
    return plain and {"type": "Lowercase"} in steps and drops and alone and ends


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def code(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of a row of ranks below 2**32."""
    controls, data = [], []
    for start in range(0, len(ranks), 4 * _STEP):
        own = ranks[start : start + 4 * _STEP].astype("<u4")
        extra = (own > 0xFF).astype(np.uint8) + (own > 0xFFFF) + (own > 0xFFFFFF)
        quads = np.zeros(-(-len(own) // 4) * 4, np.uint8)
        quads[: len(own)] = extra
        quads = quads.reshape(-1, 4)
        controls.append((quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6).astype(np.uint8).tobytes())
        data.append(own.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]].tobytes())
    return b"".join(controls), b"".join(data)


def decode(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """The ranks that ``code`` has written, by looking control bytes up in a table."""
    out, at = np.empty(count, np.uint32), 0
    for start in range(0, count, 4 * _STEP):
        stop = min(count, start + 4 * _STEP)
        sizes = LENGTHS[control[start // 4 : -(-stop // 4)]].ravel()[: stop - start]
        ends = np.cumsum(sizes, dtype=np.int64)
        own = np.concatenate([data[at : at + int(ends[-1])], np.zeros(3, np.uint8)])
        # Four bytes from wherever a rank starts, less those of the next ones.
        words = np.lib.stride_tricks.sliding_window_view(own, 4).view("<u4")[:, 0]
        out[start:stop] = words[ends - sizes] & MASKS[sizes]
        at += int(ends[-1])
    if at != len(data):
        raise ValueError(f"{len(data) - at} bytes too many for {count} ranks")
    return out


def pack_file(start: int, docs: Sequence[tuple[int | None, int, bytes, bytes]]) -> bytes:
    """The bytes of a file from (document id, ids, control, data) in stream order."""
    control, data = b"".join(d[2] for d in docs), b"".join(d[3] for d in docs)
    total = sum(d[1] for d in docs)
    return b"".join([
        _HEADER.pack(_MAGIC, len(docs), total, start, len(control), len(data)),
        np.array([d[0] or 0 for d in docs], "<i8").tobytes(), np.array([d[0] is not None for d in docs], np.uint8).tobytes(),
        np.array([d[1] for d in docs], "<i8").tobytes(), control, data,
    ])


def unpack_file(content: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(document id, position of its first id, ranks) of each document of a file."""
    if not content:
        return  # a task without rows leaves an empty file
    mark, n_docs, total, start, n_control, n_data = _HEADER.unpack_from(content)
    at = _HEADER.size
    if mark != _MAGIC or len(content) != at + 17 * n_docs + n_control + n_data + 1:
        raise ValueError("not a whole file of token ids")
    ids = np.frombuffer(content, "<i8", n_docs, at)
    has_id = np.frombuffer(content, np.uint8, n_docs, at + 8 * n_docs)
    counts = np.frombuffer(content, "<i8", n_docs, at + 9 * n_docs)
    if int(counts.sum()) != total:
        raise ValueError("documents and ids of a file of token ids don't agree")
    control = np.frombuffer(content, np.uint8, n_control, at + 17 * n_docs)
    data = np.frombuffer(content, np.uint8, n_data, at + 17 * n_docs + n_control)
    # Padding in a document's last control byte stands for no data.
    quads = -(-counts // 4)
    sizes = LENGTHS[control].sum(axis=1, dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(quads)])
    bytes_to = np.concatenate([[0], np.cumsum(sizes)])
    used = bytes_to[first[1:]] - bytes_to[first[:-1]] - (4 * quads - counts)
    begin = np.concatenate([[0], np.cumsum(used)])
    for k in range(n_docs):
        ranks = decode(control[first[k] : first[k + 1]], data[begin[k] : begin[k + 1]], int(counts[k]))
        yield (int(ids[k]) if has_id[k] else None), start, ranks
        start += int(counts[k])


_ORDER = ["has_id", "id", "tie", "place"]
_KEYS = "has_id boolean, id long, tie long, place long, n long"


def _tokenised(docs: DataFrame, path: str, end_id: int | None) -> DataFrame:
    """A row per document with its ids as little-endian integers of 4 bytes."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in slices(batches, "text", _TEXT_BYTES):
            ids, sizes = tokens.encode(batch.column("text"))
            ends = np.cumsum(sizes)
            ids = np.insert(ids, np.repeat(ends, len(tail)), np.tile(tail, len(sizes))).astype("<u4")
            sizes = sizes + len(tail)
            bounds = np.concatenate([[0], np.cumsum(4 * sizes)])
            column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)])
            keys = [batch.column(c) for c in _ORDER]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(sizes, pa.int64()), column.cast(pa.binary())], names=[*_ORDER, "n", "ids"])

    return docs.mapInArrow(tokenise, f"{_KEYS}, ids binary")


def _counts(tokens: DataFrame) -> DataFrame:
    """How often each id occurs; added up in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for batch in slices(batches, "ids", _OUT_BYTES):
            own = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u4"), minlength=len(seen))
            own[: len(seen)] += seen
            seen = own
        where = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(seen[where], pa.int64())], names=["token", "seen"])

    return tokens.select("ids").mapInArrow(count, "token int, seen long").groupBy("token").agg(F.sum("seen").alias("seen"))


def write_token_ids(
    docs: DataFrame,
    vocabulary: str,
    folder: str,
    *,
    end_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_ids: int = FILE_IDS,
) -> None:
    """Write the ids of every whole text below ``folder``, in ascending document id.

    ``vocabulary`` is the path of a file of the tokenizers library that every
    worker can open; ``end_id`` is appended to each document.  ``folder/ids``
    holds the files, ``folder/ranks`` the ids by rank with their counts; both
    must not exist.  The driver holds one row per id of the vocabulary and one
    per part, at most ``MAX_PARTS``.

    Defined cases: null texts are empty; rows with a null id come first; rows
    that share an id follow each other in the order of a hash of their text; a
    document is never cut, so a very long one makes a file of its own; an empty
    table gives an empty stream.
    """
    spark = docs.sparkSession
    # Rows alike in all still differ in place, so even they can go to several parts.
    keyed = docs.select(
        F.col(id_col).isNotNull().alias("has_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text_col).alias("tie"), F.monotonically_increasing_id().alias("place"), F.col(text_col).alias("text"),
    )
    scratch = shared_folder(spark, "tokens")
    _tokenised(keyed, vocabulary, end_id).write.option("compression", "zstd").parquet(scratch)
    tokens = spark.read.parquet(scratch)

    ranked = _counts(tokens).orderBy(F.desc("seen"), "token").collect()  # no more than the vocabulary has
    table = [(rank, r["token"], r["seen"]) for rank, r in enumerate(ranked)]
    spark.createDataFrame(table, "rank int, token int, seen long").coalesce(1).write.parquet(f"{folder.rstrip('/')}/ranks")
    total = sum(r["seen"] for r in ranked)
    rank_of = np.zeros(max((r["token"] for r in ranked), default=0) + 1, np.uint32)
    rank_of[[r["token"] for r in ranked]] = np.arange(len(ranked))

    # One job settles the parts: where each begins, in documents and in ids.
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (8 * file_ids)))
    parts = (
        tokens.select(*_ORDER, "n")
        .repartitionByRange(min(wanted, MAX_PARTS), *_ORDER)
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min(F.struct(*_ORDER)).alias("first"), F.sum("n").alias("n"))
        .collect()
    )
    parts = sorted((tuple(p["first"]), p["n"]) for p in parts)
    bounds = [p[0] for p in parts]
    starts = [0]
    for _, n in parts:
        starts.append(starts[-1] + n)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", _OUT_BYTES):
            keys = [batch.column(c).to_pylist() for c in _ORDER]
            dealt = [bisect_right(bounds, key) - 1 for key in zip(*keys, strict=True)]
            coded = [code(rank_of[np.frombuffer(ids, "<u4")]) for ids in batch.column("ids").to_pylist()]
            columns = [pa.array([c[k] for c in coded], pa.binary()) for k in range(2)]
            kept = [batch.column(c) for c in (*_ORDER, "n")]
            yield pa.RecordBatch.from_arrays([pa.array(dealt, pa.int32()), *kept, *columns], names=["part", *_ORDER, "n", "control", "data"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, int, bytes, bytes]] = []
        part, at, kept = -1, 0, 0

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack_file(at - kept, held)], pa.binary())], names=["value"])

        for batch in slices(batches, "data", _OUT_BYTES):
            for own, has_id, ident, n, control, data in zip(*(batch.column(c).to_pylist() for c in ("part", "has_id", "id", "n", "control", "data")), strict=True):
                if held and (own != part or kept + n > file_ids):
                    yield file()
                    held, kept = [], 0
                if own != part:
                    if part >= 0 and at != starts[part + 1]:
                        raise ValueError("a part does not hold the ids that were counted for it")
                    part, at = own, starts[own]
                held.append((ident if has_id else None, n, control, data))
                at, kept = at + n, kept + n
        if held:
            yield file()
        if part >= 0 and at != starts[part + 1]:
            raise ValueError("a part does not hold the ids that were counted for it")

    codes = tokens.mapInArrow(encode, f"part int, {_KEYS}, control binary, data binary")
    dealt = codes.repartitionById(max(1, len(parts)), F.col("part")).sortWithinPartitions("part", *_ORDER)
    files = dealt.mapInArrow(cut, "value binary").select(F.col("value").cast("string"))
    # The text writer puts bytes wherever Spark can write, and commits whole files only.
    files.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(f"{folder.rstrip('/')}/ids")


def read_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the files below ``folder``.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian
    unsigned 32-bit integers.  A file that is cut short is an error.
    """
    ranked = spark.read.parquet(f"{folder.rstrip('/')}/ranks").select("rank", "token").collect()
    token_of = np.zeros(len(ranked), np.uint32)
    token_of[[r["rank"] for r in ranked]] = [r["token"] for r in ranked]
    files = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/ids").where(F.col("path").rlike(r"/part-[^/]*$"))

    def rows(held: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array(list(c), t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for ident, start, ranks in unpack_file(content.as_buffer().to_pybytes()):
                    held.append((ident, start, len(ranks), token_of[ranks].astype("<u4").tobytes()))
                    size += 4 * len(ranks)
                    if size > _OUT_BYTES:
                        yield rows(held)
                        held, size = [], 0
                if held:
                    yield rows(held)

    return files.select("content").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def stored_token_ids(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write ``docs`` to a fresh shared folder and read the files back."""
    folder = shared_folder(docs.sparkSession, "token-ids")
    write_token_ids(docs, vocabulary, folder, **options)
    return read_token_ids(docs.sparkSession, folder)
