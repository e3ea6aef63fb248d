"""WARC archives of pages, and their capture index by external merge.

*Write.*  Every page becomes a record.  Of records with equal payloads of at
least ``REVISIT_BYTES`` bytes the one with the smallest page_id is a response and
the others are revisits of it; smaller ones are all responses.  Pages are dealt
to archives of about ``ARCHIVE_BYTES`` of payload (larger ones beyond ``ARCHIVES``
archives, up to ``MOST_BYTES``), sorted by URL key and time, and written by Spark's
text sink as gzip files, each a locally sorted capture run.

*Read.*  Archives are read as binary files and parsed as streams by
Content-Length, one record in memory; the payload digests are taken from the
bytes read.  A revisit names the page it refers to and the digest of its payload;
its length and digest are those of the response with that page and digest, so
pages that share a page_id and differ in their html stay apart.

*Merge.*  The captures are dealt to ranges of (URL key, time, page_id); in each
range a loser tree merges the runs' sorted slices, so (index_part, index_row) is
the global order of the capture histories.  A range holds a bounded number of
captures, and captures of one URL may spread over several ranges.

The URL key is the host with its labels reversed, a parenthesis, and the path
and query in lower case.  Pages have no capture time; a page's is the epoch
below plus page_id seconds.  A null html is an empty payload, a null url an
empty one; a null page_id sorts first and never refers to another page.
Repeated rows of a page are equal records.  An empty table gives an empty table;
further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.spark_io import scratch, written
from cardwatch.session import ship_package

REVISIT_BYTES = 100
ARCHIVE_BYTES, MOST_BYTES, ARCHIVES = 32 << 20, 512 << 20, 10_000
#: Captures in a range of the merged index.
RANGE_ROWS = 25_000
EPOCH = "2024-01-01 00:00:00"

CAPTURE = "run string, row int, page_id long, url string, url_key string, captured string, record_type string, refers_to long, stored_bytes long, stored_digest string, named_digest string"
INDEXED = CAPTURE + ", index_part int, index_row int"


def url_key(url):
    """Sort-friendly form of a URL column."""
    low = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_replace(F.regexp_extract(low, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), r"^www\.", "")
    rest = F.regexp_replace(F.regexp_replace(low, r"^[a-z][a-z0-9+.-]*://[^/?#]*", ""), "#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def records(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest, record type and the page referred to."""
    base = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        # line ends would break a header
        F.regexp_replace(F.coalesce(pages["url"].cast("string"), F.lit("")), "[\\r\\n]", "").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("payload"),
    )
    base = base.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    copies = written(
        base.filter((F.col("bytes") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .filter("first != last"),
        "copies",
    )
    refers = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    seconds = F.coalesce(F.pmod("page_id", F.lit(1_000_000_000)), F.lit(0))
    captured = F.expr(f"timestamp_ntz'{EPOCH}'") + F.make_dt_interval(secs=seconds)
    return (
        base.join(copies.select("digest", "first"), "digest", "left")
        .withColumn("refers_to", refers)
        .withColumn("url_key", url_key(F.col("url")))
        .withColumn("captured", F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )


def _text_of_record():
    eol, revisit = F.lit("\r\n"), F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, eol)
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", page(F.col("page_id"))),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.col("captured")),
        line("X-Url-Key", F.col("url_key")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", page(F.col("refers_to"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        eol,
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )


def write_archives(pages: DataFrame, path: str) -> int:
    """Write the archives; returns how many runs were asked for."""
    size = pages.agg(F.sum(F.octet_length("html").cast("long") + 512)).first()[0] or 0
    runs = max(1, -(-size // min(max(ARCHIVE_BYTES, size // ARCHIVES), max(ARCHIVE_BYTES, MOST_BYTES))))
    (
        records(pages)
        .repartition(runs, "page_id", "url")
        .sortWithinPartitions("url_key", "captured", "page_id")
        .select(_text_of_record().alias("value"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .text(path)
    )
    return runs


def parse(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of the records of an uncompressed archive, read as a stream."""
    while version := archive.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError("not the start of a record")
        headers = {}
        while (line := archive.readline().decode().rstrip("\r\n")):
            name, _, value = line.partition(": ")
            headers[name] = value
        payload = archive.read(int(headers["Content-Length"]))
        if archive.read(4) != b"\r\n\r\n":
            raise ValueError("a record must end with two line ends")
        yield headers, payload


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _captures(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
            rows = []
            for k, (h, payload) in enumerate(parse(gzip.open(pa.BufferReader(content.as_buffer())))):
                refers = _page(h.get("WARC-Refers-To"))
                rows.append((
                    path, k, _page(h["WARC-Record-ID"]), h["WARC-Target-URI"], h["X-Url-Key"], h["WARC-Date"], h["WARC-Type"],
                    refers, len(payload), hashlib.sha256(payload).hexdigest(), h["WARC-Payload-Digest"].removeprefix("sha256:"),
                ))
                if len(rows) == 10_000:
                    yield _batch(rows, _CAPTURE)
                    rows = []
            yield _batch(rows, _CAPTURE)


_CAPTURE = pa.schema([
    ("run", pa.string()), ("row", pa.int32()), ("page_id", pa.int64()), ("url", pa.string()), ("url_key", pa.string()), ("captured", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("stored_bytes", pa.int64()), ("stored_digest", pa.string()), ("named_digest", pa.string()),
])
_INDEXED = _CAPTURE.append(pa.field("index_part", pa.int32())).append(pa.field("index_row", pa.int32()))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, with the length and digest of the bytes stored."""
    ship_package(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_captures, CAPTURE)


class LoserTree:
    """k-way merge of sorted runs: inner nodes keep the loser of each match, so a step replays one path."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.k = len(runs)
        self.tree = [-1] * max(1, self.k)
        for r in range(self.k):
            self._play(r)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's head comes before run b's; an ended run comes last."""
        if self.at[a] >= len(self.runs[a]):
            return False
        if self.at[b] >= len(self.runs[b]):
            return True
        x, y = self.runs[a][self.at[a]][0], self.runs[b][self.at[b]][0]
        return x < y or (x == y and a < b)

    def _play(self, r: int) -> None:
        node = (r + self.k) // 2
        while node > 0:
            rival = self.tree[node] if node < self.k else -1
            if rival < 0:
                self.tree[node] = r
                return  # waits here for its rival
            if self._less(rival, r):
                self.tree[node], r = r, rival
            node //= 2
        self.tree[0] = r

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            r = self.tree[0]
            if self.at[r] >= len(self.runs[r]):
                return
            yield self.runs[r][self.at[r]]
            self.at[r] += 1
            self._play(r)


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list[tuple]] = {}
    part = None
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            *row, part = row
            runs.setdefault(row[0], []).append(((row[4], row[5], row[2] is not None, row[2] or 0), row))
    for r in runs.values():
        r.sort(key=lambda x: x[1][1])  # the shuffle may have moved rows of a run
    out = []
    for k, (_, row) in enumerate(LoserTree([runs[r] for r in sorted(runs)])):
        out.append((*row, part, k))
        if len(out) == 10_000:
            yield _batch(out, _INDEXED)
            out = []
    if out:
        yield _batch(out, _INDEXED)


def merged_index(captures: DataFrame) -> DataFrame:
    """The captures in ranges of (URL key, time, page_id), with their place in the global order."""
    captures = written(captures, "captures")
    ranges = max(1, -(-captures.count() // RANGE_ROWS))
    return (
        captures.repartitionByRange(ranges, "url_key", "captured", "page_id")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(_merge, INDEXED)
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back, merge their index: one row per page."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(pages, path)
    index = written(merged_index(read_archives(spark, path)), "index")
    response = index.filter("record_type = 'response' AND page_id IS NOT NULL").select(
        F.col("page_id").alias("refers_to"), F.col("stored_digest").alias("named_digest"), F.col("stored_bytes").alias("full_bytes")
    )
    # written, so that a page that many others refer to can be split
    response = written(response.dropDuplicates(["refers_to", "named_digest"]), "responses").withColumn("full_digest", F.col("named_digest"))
    alone = index.filter("refers_to IS NULL").withColumns({"full_bytes": F.lit(None).cast("long"), "full_digest": F.lit(None).cast("string")})
    revisits = index.filter("refers_to IS NOT NULL").join(response, ["refers_to", "named_digest"], "left")
    return revisits.unionByName(alone).select(
        "page_id",
        F.coalesce("full_bytes", "stored_bytes").alias("payload_bytes"),
        F.coalesce("full_digest", "stored_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        "url_key",
        "captured",
        "index_part",
        "index_row",
    )
