import random

import numpy as np
import pytest
from helpers import AWKWARD, SCHEMA
from pyspark.sql import functions as F

from touchstone.llm import toxicity
from touchstone.llm.quality import FEATURES, quality_scores, statistics
from touchstone.llm.toxicity import toxicity_scores

LABELS = "doc_id long, quality int, toxic int"


def area(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(order))
    ranks[order] = np.arange(1, len(order) + 1)
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


@pytest.mark.parametrize("scorer, label", [(quality_scores, "quality"), (toxicity_scores, "toxic")])
def test_held_out_accuracy(spark, scorer, label):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = scorer(docs, labels)
    key = "id" if "id" in found.columns else "doc_id"
    held = found.join(labels.withColumnRenamed("doc_id", "of"), F.col(key) == F.col("of")).where(F.crc32(F.col("of").cast("string").cast("binary")) % 5 == 0).select("score", label).toPandas()
    truth = held[label].to_numpy()
    assert area(held["score"].to_numpy(), truth) > 0.9
    threshold = 0.3 if label == "quality" else 0.5
    assert ((held["score"] >= threshold) == truth).mean() > 0.93


@pytest.mark.parametrize("scorer", [quality_scores, toxicity_scores])
def test_awkward_rows(spark, scorer):
    docs = spark.createDataFrame(AWKWARD, SCHEMA).withColumns({"_label": F.lit("x"), "stats": F.lit(1), "score": F.lit("old")})
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (4, 1, 0), (5, 0, 1), (5, 0, 1), (5, 1, 1), (None, 1, 1), (6, 7, 7), (77, 1, 1)], LABELS)
    for own in (labels, labels.limit(0), labels.where("quality = 1 and toxic = 0")):
        found = scorer(docs, own)
        scores = [r["score"] for r in found.collect()]
        assert len(scores) == len(AWKWARD) and all(0 <= s <= 1 for s in scores)
        if own.isEmpty():
            assert scores == pytest.approx([0.5] * len(scores))
        assert scorer(docs.limit(0), own).count() == 0


def test_inputs_stay_out_of_the_score(spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(100)], LABELS)
    texts = [("fine words here " * (3 + i % 7) if i % 2 else "BAD!! idiot ### " * (2 + i % 5)) for i in range(100)]
    plain = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    other = plain.withColumns({"lang": F.col("doc_id").cast("string"), "source": F.lit(None).cast("string"), "n_chars": -F.col("doc_id")})
    for scorer, key in ((quality_scores, "id"), (toxicity_scores, "doc_id")):
        one, two = ({r[key]: r["score"] for r in scorer(d, labels).collect()} for d in (plain, other))
        assert one == pytest.approx(two)


def test_statistics_are_finite():
    for text in (None, "", " ", "\n\n", "!" * 9, "É", "a " * 5_000):
        values = statistics(text)
        assert len(values) == len(FEATURES) and np.isfinite(values).all()


def test_interactions_are_learned():
    """Toxic only where an insult meets a group: no sum of weights can tell."""
    rng = random.Random(1)
    rows, labels = [], []
    for _ in range(1_500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        rows.append(sorted({10} | {rng.randrange(100, 140) for _ in range(5)} | ({1} if insult else {3}) | ({2} if group else {4})))
        labels.append(float(insult == group))
    offsets = np.cumsum([0] + [len(r) for r in rows])
    terms = np.array([t for r in rows for t in r], np.int64)
    # The marginals tell nothing, so all terms are offered by a plain selection.
    chosen = np.unique(terms)
    original = toxicity._select
    toxicity._select = lambda *a: chosen
    try:
        model = toxicity.fit(offsets, terms, np.array(labels), epochs=60, rate=0.3, decay=0.0)
    finally:
        toxicity._select = original
    margins = model.margins(np.searchsorted(chosen, terms), np.repeat(np.arange(len(rows)), np.diff(offsets)), len(rows))
    assert ((margins > 0) == (np.array(labels) == 1)).mean() > 0.95


def test_margins_are_the_pairwise_sum():
    rng = np.random.default_rng(0)
    model = toxicity.FactorizationMachine(0.3, np.arange(6), rng.normal(size=6), rng.normal(size=(6, 3)))
    own = [0, 2, 5]
    want = 0.3 + model.weights[own].sum() + sum(model.factors[a] @ model.factors[b] for i, a in enumerate(own) for b in own[i + 1 :])
    assert model.margins(np.array(own), np.zeros(3, np.int64), 1)[0] == pytest.approx(want)


def test_reruns_agree(spark):
    docs = spark.createDataFrame([(i, "idiot you " * (i % 3) + f"w{i}", "en", "s", 1) for i in range(60)], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 3 > 0)) for i in range(60)], LABELS)
    one, two = ({r["doc_id"]: r["score"] for r in toxicity_scores(d, labels).collect()} for d in (docs, docs.repartition(7)))
    assert one == two
