"""Web archives: pages to WARC records and back, one nested row per capture.

A page is written as three records: its response (or a revisit of an equal
payload), the request, and metadata that name the page. The last two point to
the first by WARC-Concurrent-To. Spark's text writer makes the files: a record is
one value and the two line ends that close it are the separator, so each part is
a valid archive. Reading goes by Content-Length alone, whatever a payload holds.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import small, small_batches
from ebbline.session import shared_folder, store

# Payloads below this are never revisits.
LEAST_REVISIT = 1000
# Pages of one file, so that a reader's task holds a bounded number of them.
PAGES_PER_FILE = 3000
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ANCHORS = ("response", "revisit", "resource")


def plan(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, payload, payload_digest, copy, record_id, record_type, refers_to of every row.

    Of pages with equal payloads (equal SHA-1) of at least `least` bytes the largest
    page_id is the response. A null html is an empty payload. Equal rows are told apart
    by the number `copy`, so each is a capture of its own.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"), F.sha1(payload.cast("binary")).alias("payload_digest"))
    rows = _numbered(rows).withColumn("record_id", _record_id("response"))
    heavy = F.octet_length("payload") >= least
    groups = (
        rows.filter(heavy)
        .groupBy("payload_digest")
        .agg(F.max(F.struct("page_id", "record_id")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("payload_digest", F.col("first.page_id").alias("first_page"), F.col("first.record_id").alias("first_record"))
    )
    # Copies of one payload may be a third of all pages: without a broadcast, adaptive
    # execution splits their side of the join.
    marked = rows.join(small(groups), "payload_digest", "left")
    again = heavy & F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return marked.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("first_record")))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with `copy`, their number among equal ones, from 1.

    Equal rows are counted without their payloads; those that repeat become one row,
    which is written as often as it was counted.
    """
    same = ["page_id", "url", "payload_digest"]
    many = rows.groupBy(*same).agg(F.count("*").alias("many")).filter("many > 1").withColumnsRenamed({c: f"same_{c}" for c in same})
    equal = F.lit(True)
    for c in same:
        equal = equal & F.col(c).eqNullSafe(F.col(f"same_{c}"))
    counted = rows.join(small(many), equal, "left").select(*rows.columns, "many")
    once = counted.filter("many IS NULL").withColumn("copy", F.lit(1)).drop("many")
    again = counted.filter("many IS NOT NULL").dropDuplicates(same)
    return once.unionByName(again.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("many").cast("int")))).drop("many"))


def _record_id(kind: str) -> Column:
    """A urn made from what the page is, so that a task that runs again writes the same one."""
    name = F.md5(F.to_json(F.struct(F.lit(kind), F.col("page_id"), F.col("url"), F.col("payload_digest"), F.col("copy"))))
    part = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *part), F.lit(">"))


def _record(kind: Column | str, identity: Column, block: Column, mime: str, *headers: Column) -> Column:
    """One record without the two line ends behind it; null headers are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = F.concat_ws(
        END,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), identity),
        *headers,
        F.lit(f"Content-Type: {mime}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(lines, F.lit(END * 2), block)


def write(planned: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", pages_per_file: int = PAGES_PER_FILE) -> None:
    """Write the planned pages as compressed archives into a new folder."""
    url = F.regexp_replace("url", r"[\r\n]+", " ")
    target = F.when(url != "", F.concat(F.lit("WARC-Target-URI: "), url))
    when = F.lit(f"WARC-Date: {date}")
    joined = F.concat(F.lit("WARC-Concurrent-To: "), F.col("record_id"))
    again = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(END * 2))
    response = _record(
        F.col("record_type"), F.col("record_id"), F.when(again, http).otherwise(F.concat(http, F.col("payload"))), "application/http; msgtype=response", when, target,
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Refers-To: "), F.col("refers_to")),
        F.when(again, F.lit(f"WARC-Profile: {PROFILE}")),
    )
    asked = F.concat(F.lit("GET "), F.coalesce(F.nullif(F.regexp_extract(url, r"^\w+://[^/]*(/\S*)", 1), F.lit("")), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), F.regexp_extract(url, r"^\w+://([^/\s]*)", 1), F.lit(END * 2))
    request = _record("request", _record_id("request"), asked, "application/http; msgtype=request", when, target, joined)
    fields = F.concat(F.concat_ws(END, F.concat(F.lit("pageId: "), F.col("page_id").cast("string"))), F.lit(END))
    metadata = _record("metadata", _record_id("metadata"), fields, "application/warc-fields", when, target, joined)
    rows = planned.select(F.explode(F.array(response, request, metadata)).alias("value"))
    rows.write.option("lineSep", END * 2).option("compression", "gzip").option("maxRecordsPerFile", 3 * pages_per_file).text(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives: its headers and its payload, without the HTTP head.

    payload_bytes and payload_digest are taken from the payload as read. A record cut
    off by the end of its file, or one without a valid length, raises a ValueError.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                buffer = content.as_buffer()
                rows, held = [], 0
                for row in _records(path, buffer):
                    rows.append(row)
                    held += len(row["payload"]) + 1000
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    names = ("record_id", "type", "target", "date", "refers_to")
    schema = pa.schema(
        [(n, pa.string()) for n in names]
        + [("concurrent_to", pa.list_(pa.string())), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    )
    small_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    return files.mapInArrow(
        parse,
        ", ".join(f"{n} string" for n in names) + ", concurrent_to array<string>, payload binary, payload_bytes bigint, payload_digest string",
    )


def _records(path: str, content: pa.Buffer) -> Iterator[dict]:
    raw = io.BufferedReader(_Inflated(content)) if path.endswith(".gz") else io.BytesIO(content)
    while True:
        line = raw.readline()
        if not line:
            return
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin in {path}")
        head: dict[str, list[str]] = {}
        for name, value in _fields(raw):
            head.setdefault(name, []).append(value)
        size = head.get("content-length", [""])[0]
        block = raw.read(int(size)) if size.isdigit() else b""
        if not size.isdigit() or len(block) < int(size):
            raise ValueError(f"a record of {path} is cut off or has no length")
        if head.get("content-type", [""])[0].startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        one = lambda name: head.get(name, [None])[0]
        yield {
            "record_id": one("warc-record-id"), "type": one("warc-type"), "target": one("warc-target-uri"), "date": one("warc-date"), "refers_to": one("warc-refers-to"),
            "concurrent_to": head.get("warc-concurrent-to", []), "payload": block, "payload_bytes": len(block), "payload_digest": hashlib.sha1(block).hexdigest(),
        }


def _fields(raw: io.BufferedIOBase) -> Iterator[tuple[str, str]]:
    while (line := raw.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        yield name.strip().lower(), value.strip()


class _Inflated(io.RawIOBase):
    """The plain bytes of a gzip file of any number of members, a piece at a time."""

    def __init__(self, content: pa.Buffer):
        self.rest, self.at, self.zip = memoryview(content), 0, zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while True:
            if self.zip.eof:
                left = self.zip.unused_data
                self.at -= len(left)
                self.zip = zlib.decompressobj(31)
            given = self.zip.unconsumed_tail or self.rest[self.at : self.at + 65536]
            if not self.zip.unconsumed_tail:
                self.at += len(given)
            if not len(given):
                return 0
            got = self.zip.decompress(given, len(out))
            if got:
                out[: len(got)] = got
                return len(got)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture id, its response, its requests and its metadata records.

    A capture is a response, revisit or resource. Another record belongs to the one
    that it names in WARC-Concurrent-To or that names it, or, failing that, to the one
    its neighbour belongs to; of several, to the smallest id. A record that reaches
    none is in no capture; a capture may lack requests or metadata. Records that
    repeat an id count once.
    """
    links = records.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    anchors = records.filter(F.col("type").isin(*ANCHORS)).dropDuplicates(["record_id"])
    direct = links.join(anchors.select(F.col("record_id").alias("b")), "b").groupBy("a").agg(F.min("b").alias("capture"))
    next_to = links.join(direct.select(F.col("a").alias("b"), "capture"), "b").groupBy("a").agg(F.min("capture").alias("capture"))
    of = direct.unionByName(next_to.join(direct, "a", "left_anti")).withColumnRenamed("a", "record_id")
    others = records.filter(~F.col("type").isin(*ANCHORS)).select("record_id", "type", "target", "date", "payload").dropDuplicates(["record_id"])
    held = F.struct("record_id", "target", "date", "payload")
    beside = (
        others.join(of, "record_id")
        .groupBy("capture")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("type") == "request", held))).alias("requests"),
            F.array_sort(F.collect_list(F.when(F.col("type") == "metadata", held))).alias("metadata"),
        )
    )
    response = F.struct("record_id", "type", "target", "date", "refers_to", "payload", "payload_bytes", "payload_digest").alias("response")
    return anchors.select(F.col("record_id").alias("capture"), response).join(beside, "capture", "left")


def round_trip(pages: DataFrame, bodies: bool = True) -> DataFrame:
    """Write the pages as archives into the shared folder, read them back and assemble the captures.

    Without `bodies` the payloads of responses are read and digested but not carried
    further, and the archives are parsed once instead of once for each side of the joins.
    """
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write(plan(pages), folder)
    records = read(spark, folder)
    if not bodies:
        records = store(records.withColumn("payload", F.when(~F.col("type").isin(*ANCHORS), F.col("payload"))))
    return assemble(records)


def page_ids(captures: DataFrame) -> DataFrame:
    """Captures with the page_id that their metadata name, and the response that a revisit refers to.

    payload_bytes and payload_digest of a revisit are those of the payload it refers to.
    """
    named = F.regexp_extract(F.col("metadata")[0]["payload"].cast("string"), r"pageId: (-?\d+)", 1)
    rows = captures.withColumn("page_id", F.nullif(named, F.lit("")).cast("bigint"))
    # Many revisits may refer to one response: only responses that are referred to take part.
    named = rows.select(F.col("response.refers_to").alias("capture")).filter("capture IS NOT NULL").distinct()
    first = rows.filter("response.type = 'response'").join(named, "capture", "left_semi").select(
        F.col("capture").alias("refers_to_record"), F.col("page_id").alias("refers_to"),
        F.col("response.payload_bytes").alias("first_bytes"), F.col("response.payload_digest").alias("first_digest"),
    )
    joined = rows.withColumn("refers_to_record", F.col("response.refers_to")).join(small(first), "refers_to_record", "left")
    return joined.select(
        "capture", "page_id", F.coalesce("first_bytes", "response.payload_bytes").alias("payload_bytes"),
        F.coalesce("first_digest", "response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"), "refers_to",
    )
