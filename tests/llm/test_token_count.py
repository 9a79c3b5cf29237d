import pytest
from helpers import AWKWARD, LONG, SCHEMA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchstone.llm.queries import vocabulary_path
from touchstone.llm.token_count import MergeTable, count_tokens

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary_path()
TABLE, LIBRARY = MergeTable(PATH), tokenizers.Tokenizer.from_file(PATH)


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


PIECES = st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "the", "The", "ing", "'s", "'ll", "12", "é", "ß", "€", " ", " ", "\x1c", "\x85", "\U0001f600", "!!", "###", "<|endoftext|>", "<|end", "中文", "a", "́"])


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(PIECES, max_size=25).map("".join), st.text(max_size=60)))
def test_counts_as_the_library(text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    assert TABLE.tokens(text) == library(text)


def test_long_words(spark):
    for text in ("a" * 30_000, "ab" * 20_000, "é" * 10_000, " " * 5_000 + "x", "x" + " " * 5_000, LONG, "1" * 9_999):
        assert TABLE.tokens(text) == library(text)


def test_operator(spark):
    docs = spark.createDataFrame(AWKWARD, SCHEMA).withColumn("n_tokens", F.lit("old"))
    found = count_tokens(docs, PATH)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_bytes", "n_tokens"]
    for row in found.collect():
        text = row["text"] or ""
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), library(text))
    assert count_tokens(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for row in count_tokens(docs, PATH).collect():
        assert row["n_tokens"] == library(row["text"] or "")


def test_unsupported_vocabulary():
    with pytest.raises(ValueError):
        MergeTable(vocabulary_path("word_bpe_49k.json"))
