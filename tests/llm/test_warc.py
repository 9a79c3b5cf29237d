import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchstone.llm.warc import LoserTree, archive_pages, merge_runs, read_archives, records_of, write_archives

SCHEMA = "page_id long, url string, html string"
BIG = "<p>é\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n</p>" * 40
PAGES = [
    (1, "http://www.b.example.com/x?y=1#top", BIG), (2, "https://a.example.com", BIG), (9, None, BIG), (4, "http://a.example.com/", "small"),
    (5, "http://a.example.com/", "small"), (6, "http://evil.example.com/\r\nWARC-Type: revisit", None), (7, "ftp://user@host:21/p", ""),
    (8, "x", "y" * 999), (10, "x", "y" * 999), (11, "x", "z" * 1000), (12, "x", "z" * 1000), (12, "x", "z" * 1000), (None, "n", "z" * 1000),
    (13, "http://b.example.com/x", "\r\n" * 700), (14, "http://b.example.com/\U0001f600", "\n" * 700), (-3, "u", "\n" * 700),
]


def brute(pages):
    keepers = defaultdict(list)
    for page, _, html in pages:
        if page is not None and len((html or "").encode()) >= 1000:
            keepers[html].append(page)
    out = []
    for page, _, html in pages:
        data = (html or "").encode()
        copies = [p for p, _, h in pages if (h or "") == (html or "")]
        keeper = max(keepers[html]) if len(data) >= 1000 and keepers.get(html) and len(copies) > 1 else page
        kind = "response" if keeper == page else "revisit"
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), kind, None if kind == "response" else keeper))
    return sorted(out, key=repr)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("options", [{}, {"part_bytes": 500}])
def test_round_trip(spark, tmp_path, options):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumns({"digest": F.lit("x"), "keeper": F.lit(1)})
    found = archive_pages(pages, f"file://{tmp_path}/warc", **options)
    assert sorted(map(tuple, found.select(*COLUMNS).collect()), key=repr) == brute(PAGES)
    rows = sorted(found.collect(), key=lambda r: (r["history_part"], r["history_place"]))
    keys = [(r["url_key"].encode(), r["captured"]) for r in rows]
    assert keys == sorted(keys)
    assert {r["url_key"] for r in rows if r["page_id"] in (1, 2, 7)} == {"com,example,b)/x?y=1", "com,example,a)/", "host):21/p"}


def test_a_revisit_stores_no_payload(spark, tmp_path):
    folder = f"file://{tmp_path}/warc"
    write_archives(spark.createDataFrame([(i, "http://a/", BIG * 20) for i in range(30)], SCHEMA), folder)
    assert sum(p.stat().st_size for p in (tmp_path / "warc").glob("part-*")) < 20_000
    kinds = read_archives(spark, folder).groupBy("record_type").count().collect()
    assert {r[0]: r[1] for r in kinds} == {"response": 1, "revisit": 29}


def test_payload_comes_back(spark, tmp_path):
    import gzip

    write_archives(spark.createDataFrame(PAGES, SCHEMA), f"file://{tmp_path}/warc", part_bytes=2_000)
    stored = {}
    for part in (tmp_path / "warc").glob("part-*.gz"):
        for fields, _, content in records_of(gzip.decompress(part.read_bytes())):
            if fields["WARC-Type"] == "response":
                stored.setdefault(fields["WARC-Record-ID"], content)
    for page, _, kind in ((r[0], r[1], r[3]) for r in brute(PAGES)):
        if kind == "response" and page is not None:
            html = next(h for p, _, h in PAGES if p == page)
            assert stored[f"<urn:page:{page}>"] == (html or "").encode()


def test_damage_is_found(spark):
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [c for _, _, c in records_of(record * 2)] == [b"abc"] * 2
    with pytest.raises(ValueError):
        list(records_of(record.replace(b": 3", b": 2")))
    with pytest.raises(ValueError):
        list(records_of(b"x" + record))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-5, 5), max_size=8), max_size=9))
def test_loser_tree_merges(runs):
    values = [v for run in runs for v in sorted(run)]
    places, start = [], 0
    for run in runs:
        places.append(list(range(start, start + len(run))))
        start += len(run)
    merged = list(LoserTree(places, lambda i: values[i]))
    assert [values[i] for i in merged] == sorted(values)
    assert merged == sorted(range(len(values)), key=lambda i: (values[i], i))


def test_hot_url_is_spread_and_empty_table(spark, tmp_path):
    index = spark.range(2_000).selectExpr(
        "concat('run', id % 7) run", "id place", "id page_id", "'http://hot/' url", "cast(2000 + id as string) captured", "'d' digest",
        "1L payload_bytes", "'response' record_type", "cast(null as long) refers_to",
    )
    merged = merge_runs(index, range_rows=100)
    parts = merged.groupBy("history_part").count().collect()
    assert len(parts) >= 8 and max(r["count"] for r in parts) < 500
    rows = sorted(merged.collect(), key=lambda r: (r["history_part"], r["history_place"]))
    assert [r["page_id"] for r in rows] == list(range(2_000))
    empty = spark.createDataFrame([], SCHEMA)
    assert archive_pages(empty, f"file://{tmp_path}/none").count() == 0
