"""WARC archives with revisits, and their capture index merged from sorted runs.

Writing: payloads are digested, payloads that repeat are found by a narrow
aggregate, and every page becomes one record of a WARC part file, which Spark's
text writer puts wherever Spark can write: a record's text ends so that the line
feed the writer adds completes the record's closing CRLF CRLF.

Reading: each part file is parsed record by record, by content length, so a
payload may hold anything; a part is one sorted run of the capture index.

Merging: runs are dealt by ranges of (URL key, timestamp, page) and each range
is merged from its runs by a loser tree, which yields the capture histories of
all URLs in global order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchstone.llm.common import shared_folder
from touchstone.session import materialize

MIN_REVISIT_BYTES = 1000
PART_BYTES = 16 << 20
#: First capture time; pages carry no time of their own.
EPOCH = 1_577_836_800
_HEAD = "WARC/1.0\r\n"
_REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then path and query, without scheme, ``www`` and fragment."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@]*@)?(?:www\d*\.)?|#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?:]*)", 1))
    rest = F.regexp_replace(bare, r"^[^/?:]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest))


def capture_time(page: Column) -> Column:
    """Capture time of a page: one second per id after ``EPOCH``, within a century."""
    return F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.pmod(page, F.lit(3_153_600_000)), F.lit(0)))


def with_decisions(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages with digest, size, record type and the page a revisit refers to."""
    payload = F.coalesce("html", F.lit(""))
    made = pages.select("page_id", "url", payload.alias("html")).withColumns(
        {"digest": F.sha1("html"), "size": F.octet_length("html").cast("long")}
    )
    keepers = (
        made.where(F.col("size") >= min_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("captures"))
        .where("captures > 1")
        .select(F.col("digest").alias("_digest"), F.col("size").alias("_size"), F.hash("digest").alias("_spread"), "keeper")
    )
    # The hash makes both sides shuffle anew, so a payload with very many captures is split.
    joined = made.withColumn("spread", F.hash("digest")).join(
        keepers,
        (F.col("digest") == F.col("_digest")) & (F.col("size") == F.col("_size")) & (F.col("spread") == F.col("_spread")),
        "left",
    )
    revisits = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return joined.select("page_id", "url", "html", "digest", "size", F.when(revisits, F.col("keeper")).alias("refers_to"))


def _record(moment: Column) -> Column:
    """A whole record as text, short of its last line feed."""

    def uri(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit("\r\n"))

    target = F.coalesce("url", F.lit(""))
    for raw, escaped in (("\r", "%0D"), ("\n", "%0A")):  # a header is one line
        target = F.replace(target, F.lit(raw), F.lit(escaped))
    revisit = F.col("refers_to").isNotNull()
    return F.concat(
        F.lit(_HEAD),
        F.when(revisit, F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        line("WARC-Record-ID", uri(F.col("page_id"))),
        line("WARC-Date", F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("size").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_REVISIT)), line("WARC-Refers-To", uri(F.col("refers_to"))))).otherwise(F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"),
        F.when(revisit, F.lit("")).otherwise(F.col("html")),
        F.lit("\r\n\r"),
    )


def write_archives(pages: DataFrame, folder: str, *, min_bytes: int = MIN_REVISIT_BYTES, part_bytes: int = PART_BYTES) -> None:
    """Write a record per page into gzip-compressed WARC parts below ``folder``.

    A part ends after as many records as hold ``part_bytes`` of payload on
    average.  A payload of at least ``min_bytes`` that repeats is stored once,
    with its largest page id; the other captures are revisits.
    """
    row = pages.agg(F.sum(F.octet_length("html").cast("long")).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    most = max(1, part_bytes * row["rows"] // max(1, row["bytes"] or 0))
    moment = F.to_utc_timestamp(capture_time(F.col("page_id")), F.current_timezone())
    # Payloads move once, to meet the decisions; parts are cut while writing.
    records = with_decisions(pages, min_bytes).select(_record(moment).alias("value"))
    records.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", most).text(folder)


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """(headers, offset, content) of the records of one uncompressed archive part."""
    at = 0
    head = _HEAD.encode()
    while at < len(data):
        if data[at : at + len(head)] != head:
            raise ValueError(f"no record at byte {at}")
        blank = data.index(b"\r\n\r\n", at)
        lines = data[at + len(head) : blank].decode("utf-8", "surrogatepass").split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        start = blank + 4
        stop = start + int(fields["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where it says")
        yield fields, at, data[start:stop]
        at = stop + 4


_INDEX = "run string, place long, page_id long, url string, captured string, digest string, payload_bytes long, record_type string, refers_to long"
_PAGE = regex.compile(r"<urn:page:(none|-?\d+)>")


def _page(uri: str) -> int | None:
    found = _PAGE.fullmatch(uri)
    return int(found[1]) if found and found[1] != "none" else None


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One index entry per record of the archives, checked against its payload.

    A response's digest and size are computed from its stored payload and must
    agree with its headers; a revisit has those of the payload it refers to.
    """
    files = spark.read.format("binaryFile").load(folder).where(F.col("path").rlike(r"/part-[^/]*$")).select("path", "content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                data = pa.CompressedInputStream(pa.BufferReader(content.as_buffer()), "gzip").read() if len(content.as_buffer()) else b""
                entries = []
                for fields, offset, payload in records_of(data):
                    kind = fields["WARC-Type"]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(fields["X-Payload-Length"])):
                        raise ValueError(f"payload at byte {offset} of {path} is damaged")
                    entries.append(
                        (offset, _page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Date"], digest,
                         int(fields["X-Payload-Length"]), kind, _page(fields.get("WARC-Refers-To", "")))
                    )
                for start in range(0, len(entries), 4096):
                    some = entries[start : start + 4096]
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*some, strict=True), kinds, strict=True)]
                    runs = pa.array([path.as_py()] * len(some), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [runs, *columns], names=["run", "place", "page_id", "url", "captured", "digest", "payload_bytes", "record_type", "refers_to"]
                    )

    return files.mapInArrow(parse, _INDEX)


class LoserTree:
    """k-way merge of sorted runs: each inner node keeps the loser of its match.

    Taking the next entry replays one path from a leaf to the root, about
    log2(k) comparisons.  Equal keys come in the order of their runs.
    """

    def __init__(self, runs: Sequence[Sequence[int]], key: Callable[[int], object]) -> None:
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.heads: list[object] = [key(r[0]) if len(r) else None for r in runs]
        self.losers = [-1] * max(1, len(runs))
        self.winner = -1
        for run in range(len(runs)):
            self._seat(run)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and x is not None or (x is None and y is None and a < b)
        return x < y or (x == y and a < b)

    def _seat(self, run: int) -> None:
        """First match of a run: wait at the first empty node on the way up."""
        node = (run + len(self.runs)) // 2
        while node:
            if self.losers[node] < 0:
                self.losers[node] = run
                return
            if self._before(self.losers[node], run):
                self.losers[node], run = run, self.losers[node]
            node //= 2
        self.winner = run

    def __iter__(self) -> Iterator[int]:
        while self.winner >= 0 and self.heads[self.winner] is not None:
            run = self.winner
            own = self.runs[run]
            yield own[self.at[run]]
            self.at[run] += 1
            self.heads[run] = self.key(own[self.at[run]]) if self.at[run] < len(own) else None
            node = (run + len(self.runs)) // 2
            while node:
                if self._before(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def merge_runs(index: DataFrame, *, range_rows: int = 100_000) -> DataFrame:
    """Index entries in global order of URL key, time, page: partition by partition, row by row.

    ``index`` has ``run`` and the columns of ``read_archives``.  Runs are dealt
    by ranges of the whole order, so one URL with very many captures is spread
    over ranges, and a range is bounded by rows.  ``history_part`` numbers the
    ranges, ``history_place`` the rows of a range.
    """
    keyed = index.withColumn("url_key", url_key(F.col("url")))
    order = ["url_key", "captured", "page_id", "run", "place"]
    parts = max(int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-keyed.count() // range_rows))
    # Each run arrives sorted by itself; the merge of the runs is the tree's.
    dealt = keyed.repartitionByRange(parts, *order).sortWithinPartitions("run", *order[:3], "place")
    dealt = dealt.withColumn("history_part", F.spark_partition_id())
    schema = dealt.withColumn("history_place", F.lit(0).cast("long")).schema

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        keys = [table.column(c).to_pylist() for c in order]
        runs: dict[str, list[int]] = {}
        for row, run in enumerate(keys[3]):
            runs.setdefault(run, []).append(row)

        def key(row: int) -> tuple:
            page = keys[2][row]
            return (keys[0][row].encode("utf-8", "surrogatepass"), keys[1][row], page is not None, page or 0, keys[3][row], keys[4][row])

        merged = list(LoserTree(list(runs.values()), key))
        moved = table.take(pa.array(merged, pa.int64())).append_column("history_place", pa.array(range(len(merged)), pa.int64()))
        yield from moved.to_batches(max_chunksize=10_000)

    return dealt.mapInArrow(merge, schema)


def archive_pages(pages: DataFrame, folder: str | None = None, **options: int) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC parts, read them back, and merge their index.

    Returns one row per record, in order of URL key and capture time:
    ``page_id, url, url_key, captured, payload_bytes, payload_digest,
    record_type, refers_to, run, place, history_part, history_place``.

    Defined cases: a null html is an empty payload; a null url is an empty one,
    and line breaks in a url are escaped; of equal payloads the rows that hold the
    largest page id are responses (more than one if rows repeat), a row with a
    null page id refers to it like any other, and payloads whose rows all have a
    null id are all responses; an empty table writes no record and gives no rows.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    write_archives(pages, folder, **options)
    index = materialize(read_archives(spark, folder))
    merged = merge_runs(index)
    return merged.select(
        "page_id", "url", "url_key", "captured", "payload_bytes", F.col("digest").alias("payload_digest"),
        "record_type", "refers_to", "run", "place", "history_part", "history_place",
    )
