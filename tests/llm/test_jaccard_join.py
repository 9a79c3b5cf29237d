import random

import pytest
from helpers import AWKWARD, LONG, SCHEMA, near
from pyspark.sql import functions as F

from touchstone.llm.common import connected
from touchstone.llm.jaccard_join import choose_bands, keep_one, near_duplicate_rows


def documents(seed=9):
    rng = random.Random(seed)
    rows, doc = [], 100

    def text(n):
        return [f"v{rng.randrange(5000)}" for _ in range(n)]

    def add(words):
        nonlocal doc
        rows.append((doc, " ".join(words), "en", "s", 1))
        doc += 1

    for _ in range(40):
        add(text(rng.randrange(1, 120)))
    for size, edits in ((2, 1), (3, 2), (60, 3), (30, 8)):
        base = text(150)
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(edits + 1)):
                own[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
            add(own)
    common = text(60)  # a shared passage is no near copy
    for _ in range(20):
        add(common + text(rng.randrange(40, 90)))
    for _ in range(5):
        add(["Two", "words!"])
    return rows


def brute(rows):
    return {i: v for i, v in near([(r[0], r[1]) for r in rows]).items()}


@pytest.mark.parametrize("options", [{}, {"block_documents": 9, "block_bytes": 9_000}])
def test_matches_brute_force(spark, options):
    rows = documents() + [(7, LONG, "en", "b", 1), (8, LONG + " more", "en", "b", 1), (9, "", "en", "b", 1), (10, None, "en", "b", 1), (11, "...", "en", "b", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"node": F.lit("x"), "id": F.lit(1), "bands": F.lit(2)})
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicate_rows(docs, **options).collect()}
    assert found == brute(rows)


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame(AWKWARD + [(5, "another text of the same id", "en", "s", 1), (70, "ANOTHER text, of the same id!", "en", "s", 1)], SCHEMA)
    found = sorted(map(tuple, near_duplicate_rows(docs).collect()), key=repr)
    assert len(found) == docs.count()
    assert [f for f in found if f[0] == 5] == [(5, 5, 1)] * 3 and (70, 5, 1) in found and (None, None, 0) in found
    assert (7, 7, 0) in found and (1, 1, 0) in found
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([-8, 1, 2, 3, 4, 5, 5, 6, 7, None], key=repr)
    assert near_duplicate_rows(docs.limit(0)).count() == 0


def test_no_text_is_lost_with_its_id(spark):
    x, y = ("alpha beta gamma delta epsilon " * 3 + str(i) for i in "xy")
    x = x.replace("alpha", "other")
    rows = [(5, x, "en", "s", 1), (5, y, "en", "s", 1), (70, y + " more", "en", "s", 1), (70, x, "en", "s", 2)]
    kept = keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(5, x), (5, y)])


@pytest.mark.parametrize("seed", range(2))
def test_ids_on_unlike_texts(spark, seed):
    # Ids 0 to 4 stand on all rows: each class must keep one row, whatever its id.
    rng = random.Random(seed)
    rows = [(rng.randrange(5), text, *rest) for _, text, *rest in documents(seed)]
    plain = near([(i, text) for i, (_, text, *_) in enumerate(rows)])
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = [(r["doc_id"], r["text"]) for r in keep_one(docs).collect()]
    groups = {}
    for i, (root, _) in plain.items():
        groups.setdefault(root, []).append(i)
    assert len(kept) == len(groups)
    for group in groups.values():
        texts = {rows[i][1] for i in group}
        own = [k for k in kept if k[1] in texts]
        assert len(own) == 1 and own[0][0] == min(rows[i][0] for i in group)
    assert sorted(r["n_links"] for r in near_duplicate_rows(docs).collect()) == sorted(n for _, n in plain.values())


def test_one_of_each_class_stays(spark):
    rows = documents(4)[40:80]
    classes = brute(rows)
    kept = keep_one(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _ in classes.values()})


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = choose_bands(threshold, 0.99)
        assert bands * rows <= 256 and 1 - (1 - threshold**rows) ** bands >= 0.99
    with pytest.raises(ValueError):
        choose_bands(0.1, 0.999, 4)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 300)] + [(1_000 - i, 999 - i) for i in range(200)] + [(5_000, 5_000), (7_000, 7_002), (7_002, 7_001)]
    random.Random(3).shuffle(chain)
    found = {r[0]: r[1] for r in connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {i: 0 for i in range(301)} | {i: 800 for i in range(800, 1_001)} | {i: 7_000 for i in (7_000, 7_001, 7_002)}
    assert found == want
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
