import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import AWKWARD, LONG, SCHEMA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchstone.llm import token_ids
from touchstone.llm.queries import op11_token_ids, vocabulary_path
from touchstone.llm.token_ids import Encoder, code, decode, pack_file, stored_token_ids, unpack_file, write_token_ids

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary_path("word_bpe_49k.json")
LIBRARY, OWN = tokenizers.Tokenizer.from_file(PATH), Encoder(PATH)


def library(text, end=2):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, end]


def expected(rows):
    """[(id, text)] in stream order -> [(id, start, n, crc)]"""
    out, start = [], 0
    for doc, text in rows:
        ids = library(text)
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def encoded(own, text):
    ids, sizes = own.encode(pa.array([text], pa.string()))
    assert list(sizes) == [len(ids)]
    return list(ids)


def digests(frame):
    rows = frame.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


PIECES = st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "the", "The", "ing", "(Word", "wörd),", "ÀÉ...", "a-b", "<", "|>", "_",  "'s", "'LL", "12", "é", "ß", "€", " ", " ", "\x1c", "\x85", "\U0001f600", "!!", "###", "<|endoftext|>", "<|EndOfText|>", "<|end", "中文", "a", "́", "ͅ", "Σ", "ΑΣ"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=30).map("".join))
def test_ids_are_the_librarys(text):
    assert encoded(OWN, text) == library(text)[:-1]


def test_several_texts_at_once():
    texts = ["One two, two!", None, "", "  ", "(Three)\nfour's <|endoftext|>one", "é" * 50, "<|ENDOFTEXT|>", "Two"]
    ids, sizes = OWN.encode(pa.array(texts))
    ends = np.cumsum(sizes)
    assert [list(ids[e - n : e]) for e, n in zip(ends, sizes, strict=True)] == [library(t)[:-1] for t in texts]


def test_words_are_forgotten_in_time(monkeypatch):
    monkeypatch.setattr(token_ids, "_CACHE_PIECES", 4)
    small = Encoder(PATH)
    texts = [f"word{i} and {'long' * 40}{i}" for i in range(20)]
    for text in texts:
        assert encoded(small, text) == library(text)[:-1]
        assert len(small.pieces) == len(small.sizes) <= 5


def test_other_vocabularies_get_whole_texts():
    path = vocabulary_path("byte_bpe_50k.json")
    other = Encoder(path)
    assert not other.by_piece
    text = "Two  spaces\n\nand <|endoftext|> here "
    want = tokenizers.Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert encoded(other, text) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(60_000, 70_000), st.integers(0, 2**32 - 1)), max_size=40))
def test_round_trip(ranks):
    control, data = code(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert len(data) == sum(max(1, (r.bit_length() + 7) // 8) for r in ranks)
    assert list(decode(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(ranks))) == ranks


def test_round_trip_over_steps(monkeypatch):
    monkeypatch.setattr(token_ids, "_STEP", 4)
    ranks = np.random.default_rng(1).integers(0, 2**32, 101) >> np.random.default_rng(2).integers(0, 32, 101)
    control, data = code(ranks)
    assert (decode(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), 101) == ranks).all()
    with pytest.raises(ValueError):
        decode(np.frombuffer(control, np.uint8), np.frombuffer(data + b"x", np.uint8), 101)


def test_files_say_where_they_start_and_notice_damage():
    docs = [(7, np.arange(5)), (None, np.array([], int)), (9, np.array([70_000, 1, 2**31]))]
    content = pack_file(100, [(i, len(r), *code(r)) for i, r in docs]) + b"\n"
    got = list(unpack_file(content))
    assert [(i, start, list(r)) for i, start, r in got] == [(7, 100, [0, 1, 2, 3, 4]), (None, 105, []), (9, 105, [70_000, 1, 2**31])]
    for broken in (content[:-1], b"x" + content[1:], content + b"y"):
        with pytest.raises(ValueError):
            list(unpack_file(broken))
    assert list(unpack_file(b"")) == []


@pytest.mark.parametrize("file_ids", [1, 50, 1 << 22])
def test_awkward_documents(spark, file_ids):
    frame = spark.createDataFrame(AWKWARD, SCHEMA).repartition(4).withColumns({"n": F.lit("x"), "part": F.lit(1), "start": F.lit(2)})
    got = digests(stored_token_ids(frame, PATH, end_id=2, file_ids=file_ids))
    order = sorted(((r[0], r[1]) for r in AWKWARD), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == expected(order)


def test_files_are_bounded_and_in_order(spark, tmp_path):
    rows = [(i, f"document number {i} says {'more ' * (i % 7)}", "en", "a", 0) for i in range(400)] + [(1000, LONG, "en", "a", 0)]
    folder = str(tmp_path / "ids")
    write_token_ids(spark.createDataFrame(rows, SCHEMA).repartition(5), PATH, folder, file_ids=100, end_id=2)
    found = []
    for name in sorted((tmp_path / "ids" / "ids").glob("part-*")):
        found.append([(i, start, len(r)) for i, start, r in unpack_file(name.read_bytes())])
    assert all(sum(n for *_, n in own) <= 100 or len(own) == 1 for own in found) and len(found) > 20
    flat = [x for own in found for x in own]
    assert [x[0] for x in flat] == sorted(r[0] for r in rows)
    assert [x[1] for x in flat] == [sum(y[2] for y in flat[:k]) for k in range(len(flat))]
    # Frequent ids have small ranks.
    seen = [r["seen"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    assert seen == sorted(seen, reverse=True) and sum(seen) == sum(x[2] for x in flat)


def test_one_id_and_text_on_very_many_rows(spark):
    rows = [(5, "the same again", "en", "a", 0)] * 300 + [(i, f"text {i}", "en", "a", 0) for i in range(20)]
    got = digests(stored_token_ids(spark.createDataFrame(rows, SCHEMA).repartition(6), PATH, end_id=2, file_ids=64))
    # Id 5 has two texts; which comes first is settled by a hash.
    plain = expected(sorted((r[0], r[1]) for r in rows))
    assert sorted((d, n, c) for d, _, n, c in got) == sorted((d, n, c) for d, _, n, c in plain)
    assert [g[1] for g in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))]
    assert [g[0] for g in got] == sorted(g[0] for g in got)


def test_empty_table_and_no_end_id(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert digests(stored_token_ids(none, PATH, end_id=2)) == []
    one = spark.createDataFrame([(3, "Hello there", "en", "a", 0), (4, "", "en", "a", 0)], SCHEMA)
    got = stored_token_ids(one, PATH).collect()
    assert {r["doc_id"]: list(np.frombuffer(r["ids"], "<u4")) for r in got} == {3: library("Hello there")[:-1], 4: []}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    got = [tuple(r) for r in op11_token_ids(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert sorted(got) == expected([tuple(r) for r in rows])
