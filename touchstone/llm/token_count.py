"""Token counts by byte-pair merging, without making a token.

The number of tokens of a piece of text is its number of bytes less the merges
that byte-pair encoding applies to it.  ``merge_count`` runs the merges on a
linked list of symbols with a heap of adjacent pairs, lowest rank first, so a
piece of n bytes costs n log n however long it is.  Texts are cut where the
tokenizer's own pattern always cuts; the count of each distinct piece is kept in
a bounded table per task.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from touchstone.llm.common import slices

#: The word pattern of byte-level byte-pair tokenizers.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: A space inside or at the end of a run of white space is no safe place to cut.
_RUN = regex.compile(r"\p{White_Space} (?:\p{White_Space}|\Z)")
_CACHE_PIECES = 400_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in own}
    for i, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + i)
    return [table[b] for b in range(256)]


class MergeTable:
    """Merge ranks of a byte-level byte-pair vocabulary, and counts of pieces.

    ``counts[piece]`` is the number of tokens of a text piece that lies between
    two safe cuts.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._check(spec)
        vocab = spec["model"]["vocab"]
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.first = [vocab[c] for c in byte_alphabet()]
        self.pairs = {
            (vocab[a] << 32) | vocab[b]: (rank << 32) | vocab[a + b] for rank, (a, b) in enumerate(merges)
        }
        added = [t["content"] for t in spec["added_tokens"]]
        self.added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.pattern = regex.compile(PATTERN)
        self.counts: dict[str, int] = {}

    @staticmethod
    def _check(spec: dict) -> None:
        pre = spec.get("pre_tokenizer") or {}
        plain = not any(
            t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in spec["added_tokens"]
        )
        if (
            spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer")
            or pre.get("add_prefix_space") or not pre.get("use_regex", True) or not plain
            or spec["model"].get("ignore_merges") or spec["model"].get("dropout")
        ):
            raise ValueError("only plain byte-level byte-pair vocabularies are supported")

    def merge_count(self, word: bytes) -> int:
        """Merges that the vocabulary applies to one word."""
        size = len(word)
        if size < 2:
            return 0
        pairs, symbols = self.pairs, [self.first[b] for b in word]
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []
        for at in range(size - 1):
            found = pairs.get((symbols[at] << 32) | symbols[at + 1])
            if found is not None:
                heap.append((found >> 32, at, symbols[at], symbols[at + 1], found & 0xFFFFFFFF))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, at, left, right, made = heapq.heappop(heap)
            follow = after[at]
            # Stale entries: one of the two symbols has been merged away since.
            if symbols[at] != left or follow >= size or symbols[follow] != right:
                continue
            merges += 1
            symbols[at], symbols[follow] = made, -1
            after[at] = beyond = after[follow]
            if beyond < size:
                before[beyond] = at
                found = pairs.get((made << 32) | symbols[beyond])
                if found is not None:
                    heapq.heappush(heap, (found >> 32, at, made, symbols[beyond], found & 0xFFFFFFFF))
            ahead = before[at]
            if ahead >= 0:
                found = pairs.get((symbols[ahead] << 32) | made)
                if found is not None:
                    heapq.heappush(heap, (found >> 32, ahead, symbols[ahead], made, found & 0xFFFFFFFF))
        return merges

    def _piece(self, piece: str) -> int:
        total = 0
        for word in self.pattern.findall(piece):
            data = word.encode("utf-8", "surrogatepass")
            total += len(data) - self.merge_count(data)
        return total

    def _plain(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        if _RUN.search(text):
            return self._piece(text)
        counts, total = self.counts, 0
        first, *rest = text.split(" ")
        for piece in ([first] if first else []) + [" " + p for p in rest]:
            known = counts.get(piece)
            if known is None:
                known = self._piece(piece)
                if len(piece) <= 64:
                    if len(counts) >= _CACHE_PIECES:
                        counts.clear()
                    counts[piece] = known
            total += known
        return total

    def tokens(self, text: str) -> int:
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        between = self.added.split(text)
        return len(between) - 1 + sum(self._plain(part) for part in between if part)


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def count_tokens(
    docs: DataFrame, vocabulary: str, *, text_col: str = "text", tokens_col: str = "n_tokens", bytes_col: str = "n_bytes"
) -> DataFrame:
    """``docs`` with the bytes and tokens of every whole text; no shuffle.

    ``vocabulary`` is the path of a byte-level vocabulary file that every worker
    can open.  Strings of added tokens count as one token each, as the
    vocabulary's own library has it; nothing is added at the ends.

    Defined cases: a null or empty text has 0 bytes and 0 tokens; a very long
    text is counted whole; columns named like the two results are replaced; rows
    are never merged, so repeats repeat.
    """
    kept = [c for c in docs.columns if c not in (tokens_col, bytes_col)]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(bytes_col, T.LongType()), T.StructField(tokens_col, T.LongType())])
    if text_col not in kept:
        raise ValueError(f"{text_col} can't be replaced by a count")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(vocabulary)
        for batch in slices(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            sizes = pa.array([len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts], pa.int64())
            tokens = pa.array([table.tokens(t) if t else 0 for t in texts], pa.int64())
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, sizes, tokens], names=[*kept, bytes_col, tokens_col])

    return docs.select(*kept).mapInArrow(count, schema)
