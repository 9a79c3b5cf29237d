"""The training-data queries: one per operator, over whole tables, and the pipeline."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchstone.llm.class_lm import class_scores
from touchstone.llm.common import crc_fold
from touchstone.llm.decontaminate import match_benchmark
from touchstone.llm.hard_negatives import mine_hard_negatives
from touchstone.llm.jaccard_join import near_duplicate_rows
from touchstone.llm.line_dedup import dedup_lines
from touchstone.llm.mixing import mix_decisions
from touchstone.llm.quality import quality_scores
from touchstone.llm.token_count import count_tokens
from touchstone.llm.token_ids import stored_token_ids
from touchstone.llm.topk import top_inner_products
from touchstone.llm.toxicity import toxicity_scores
from touchstone.llm.warc import archive_pages
from touchstone.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary file lies: in ``$TOKENIZER_DIR``, or with the installed files."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return top_inner_products(vectors, F.col("vec_id") % 50 == 0, 5)


@_query
def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    decided = mix_decisions(_table(spark, folder, "documents"))
    every_row = decided.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return every_row.select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@_query
def op3_class_ngram_score(spark: SparkSession, folder: str) -> DataFrame:
    return class_scores(_table(spark, folder, "documents"))


@_query
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(_table(spark, folder, "documents").select("doc_id", "text"), vocabulary_path())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@_query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = match_benchmark(_table(spark, folder, "documents").select("doc_id", "text"), _table(spark, folder, "benchmark"))
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda total, span: total + span[1] - span[0])
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), (F.size("_spans") > 0).alias("contaminated"),
    )


@_query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return scored.select(
        F.col("id").alias("doc_id"), F.coalesce(crc_fold(F.col("id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@_query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_pages(_table(spark, folder, "pages")).drop("run")


@_query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity_scores(docs, _table(spark, folder, "labels"))
    return scored.select(
        "doc_id", F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_query
def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_rows(_table(spark, folder, "documents"))


@_query
def op11_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    stored = stored_token_ids(docs, vocabulary_path("word_bpe_49k.json"), end_id=2)
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whiten(_table(spark, folder, "embeddings"), scale=1024, offset=100_000, components=8)
    # Exact as a decimal; where it passes a long it is null.
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@_query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


ORACLES["op1_exact_topk"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES["op4_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), common AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.*, c.key IS NOT NULL AND l.doc_id <> c.keeper AS gone FROM lines l LEFT JOIN common c ON l.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op6_decontamination"] = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size,
         array_to_string(list_slice(words, spot, spot + least(10, len(words)) - 1), ' ') AS gram
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS spot FROM item_words WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, spot, size, array_to_string(list_slice(words, spot, spot + size - 1), ' ') AS gram
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS spot FROM doc_words, sizes WHERE len(words) >= size)
), hits AS (
  SELECT d.doc_id, d.spot, d.size, w.item_id FROM doc_windows d JOIN item_windows w ON d.size = w.size AND d.gram = w.gram
), hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(spot, spot + size)) AS place FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
"""

ORACLES["op13_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id <> c.vec_id AND a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
  ) WHERE place <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""

ORACLES["op10_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, spot, spot + least(5, len(words)) - 1), ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - least(5, len(words)) + 2)) AS spot FROM words WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 5 * common >= 4 * (a.n + b.n - common)
), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other
), counted AS (SELECT x AS doc_id, count(*) AS n_links FROM edges GROUP BY x)
SELECT r.doc_id, min(r.other) AS class_id, coalesce(any_value(c.n_links), 0) AS n_links
FROM reach r LEFT JOIN counted c ON c.doc_id = r.doc_id GROUP BY r.doc_id
"""
