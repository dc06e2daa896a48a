"""WARC archives: writing captures, reading records back, assembling transactions.

``write_archives`` stores each page as a request, a response (or, for a payload
already stored, an identical-payload-digest revisit) and a metadata record, request
and metadata naming the response record in WARC-Concurrent-To. Archives are gzip
files written by Spark's text sink with the record terminator as line separator, so
the committer, retries and any file system Spark can reach work as for any table.

``read_archives`` streams the lines of each archive (a gzip file is never split)
through a record parser that honours Content-Length; memory holds one record.

``assemble`` joins the records of a capture through their concurrent-to identifiers:
one shuffle on the response's record id, one nested row per capture. Requests and
metadata that name no present response form rows of their own, whose response has null fields.

Payload groups: of the rows with equal payloads of at least ``least_bytes`` the one
with the largest page id is the response and the others revisit it (rows that repeat
the largest id are all responses); smaller payloads are all responses. The largest
id per digest is pre-aggregated before its shuffle; the join back leaves a hot
digest to Spark's skew-join splitting, its other side being one row per digest.

Defined results: a null payload is empty; a null url is written as ``about:blank`` and read back as such;
a null page id never becomes the one referred to, and a group without any id is all responses;
repeated rows give one capture each; an empty table gives no rows; columns other than
the ones named are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.bitmap import bitmap, maybe_in
from ledgerspark.llm.common import materialise, table, work_path

# The format's version line, line ends and the revisit profile.
VERSION = "WARC/1.1"
CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables hold no fetch time
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column, from its hexadecimal text (20 bytes: no padding)."""
    digest = F.sha1(payload)
    groups = []
    for k in range(4):  # 40 bits are 10 hexadecimal and 8 base32 digits
        number = F.conv(F.substring(digest, 10 * k + 1, 10), 16, 10).cast("long")
        digits = F.lpad(F.conv(number.cast("string"), 10, 32), 8, "0")
        groups.append(digits)
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def deduplicated(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                 least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: the stored page whose payload a row repeats, else null."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload")
                        ).withColumn("digest", base32_sha1(F.col("payload")))
    repeated = materialise(
        rows.filter(F.octet_length("payload") >= least_bytes).groupBy(F.col("digest").alias("d")).agg(
            F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("n")).filter("n > 1 and stored is not null")
        .select("d", "stored"), "warc-repeated")
    # pages whose digest surely stands once are written from where they are read
    bits = materialise(bitmap(repeated, F.xxhash64("d")), "warc-bitmap")
    alone = maybe_in(rows, F.xxhash64("digest"), bits, negate=True).withColumn("refers_to", F.lit(None).cast("long"))
    stored = F.when(~F.col("stored").eqNullSafe(F.col("page_id")), F.col("stored")).alias("refers_to")
    shared = maybe_in(rows, F.xxhash64("digest"), bits).join(repeated, F.col("digest") == F.col("d"), "left").select(
        "page_id", "url", "payload", "digest", stored)
    return alone.unionByName(shared)


def _record(kind: str, record_id: Column, content_type: str, headers: list[Column], block: Column) -> Column:
    """One record without its closing two line ends (the sink's separator)."""
    head = F.concat_ws(CRLF, F.lit(VERSION), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), record_id),
                       F.lit(f"WARC-Date: {DATE}"), F.lit(f"Content-Type: {content_type}"), *headers,
                       F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(CRLF * 2), block)


def write_archives(captures: DataFrame, path: str) -> None:
    """Write the rows of ``deduplicated`` as gzip WARC files, three records for each row, side by side in one file."""
    body = F.col("payload").cast("string")
    named = captures.withColumn("n", F.monotonically_increasing_id())  # unique in the committed output, however tasks are retried

    def rid(kind: str) -> Column:
        return F.concat(F.lit("<urn:capture:"), F.col("n").cast("string"), F.lit(f":{kind}>"))

    url = F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\r\n]", "%0A")
    target = F.concat(F.lit("WARC-Target-URI: "), url)
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), rid("response"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(CRLF * 2))
    fields = F.concat(F.concat_ws(CRLF, F.concat(F.lit("page-id: "), F.col("page_id").cast("string")),
                                  F.concat(F.lit("refers-to-page: "), F.col("refers_to").cast("string"))), F.lit(CRLF))
    revisit = F.col("refers_to").isNotNull()
    records = F.array(
        _record("request", rid("request"), "application/http; msgtype=request", [target, concurrent],
                F.concat(F.lit("GET "), url, F.lit(f" HTTP/1.1{CRLF * 2}"))),
        F.when(revisit, _record("revisit", rid("response"), "application/http; msgtype=response",
                                [target, digest, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")], http))
        .otherwise(_record("response", rid("response"), "application/http; msgtype=response", [target, digest],
                           F.concat(http, body))),
        _record("metadata", rid("metadata"), "application/warc-fields", [target, concurrent], fields))
    (named.select(F.explode(records).alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .text(path))


RECORD = ("record_id string, warc_type string, concurrent_to array<string>, target_uri string, headers map<string,string>, "
          "http_headers string, payload binary, payload_bytes long, payload_digest string, stated_digest string")
_KINDS = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(),
          pa.binary(), pa.int64(), pa.string(), pa.string()]


def _parsed(head: list[bytes], block: bytes) -> tuple:
    fields = [line.decode("utf-8", "replace").partition(":") for line in head]
    headers = {name.strip().lower(): value.strip() for name, _, value in fields}
    concurrent = [v.strip() for n, _, v in fields if n.strip().lower() == "warc-concurrent-to"]
    http, payload = None, block
    if headers.get("content-type", "").startswith("application/http"):
        top, _, payload = block.partition(b"\r\n\r\n")
        http = top.decode("utf-8", "replace")
    stored = len(payload)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if headers.get("warc-type") == "revisit":  # the payload stands elsewhere; its length is in the stored HTTP headers
        lines = dict(line.partition(":")[::2] for line in (http or "").split("\r\n")[1:])
        length = next((v.strip() for k, v in lines.items() if k.strip().lower() == "content-length"), "")
        payload, digest, stored = None, stated, int(length) if length.isdigit() else None
    return (headers.get("warc-record-id"), headers.get("warc-type"), concurrent, headers.get("warc-target-uri"),
            sorted(headers.items()), http, payload, stored, digest, stated)


class _Parser:
    """Records from the lines of archives that follow each other; lines come without their ``\\n``."""

    def __init__(self):
        self.file, self.head, self.block, self.missing = None, None, [], 0

    def line(self, file: str, data: bytes) -> tuple | None:
        """Take one line; returns the record that it completes, if any."""
        if file != self.file:
            self.end()
            self.file = file
        if self.missing > 0:
            self.block.append(data)
            self.missing -= len(data) + 1
            if self.missing > 0:
                return None
            # the block ends inside the line break that closes the record: "\\r\\n" belongs to the terminator
            return self._close()
        text = data.removesuffix(b"\r")
        if self.head is None:
            if text.startswith(b"WARC/"):
                self.head = []
            elif text:
                raise ValueError(f"{file}: not a record start: {text[:80]!r}")
        elif text:
            self.head.append(text)
        else:
            length = next((h.partition(b":")[2] for h in self.head if h.lower().startswith(b"content-length:")), None)
            if length is None:
                raise ValueError(f"{file}: a record without Content-Length")
            # the block and the "\\r" of its closing line break end with the line feed that completes this count
            self.missing = int(length) + 2
            self.block = []
        return None

    def _close(self) -> tuple:
        block = b"\n".join(self.block)
        if self.missing != 0 or not block.endswith(b"\r"):
            raise ValueError(f"{self.file}: a block does not end where Content-Length says")
        record = _parsed(self.head, block[:-1])
        self.head, self.block = None, []
        return record

    def end(self) -> None:
        if self.missing > 0 or self.head is not None:
            raise ValueError(f"{self.file}: ends inside a record")


BATCH_BYTES = 4 << 20


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in RECORD.replace("map<string,string>", "map").split(", ")]
    parser, rows, size = _Parser(), [], 0

    def flush() -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS, strict=True)], names=names)

    for batch in batches:
        files = batch.column(0).to_pylist()
        for file, data in zip(files, batch.column(1).to_pylist(), strict=True):
            record = parser.line(file, data)
            if record is not None:
                rows.append(record)
                size += len(record[6] or b"") + 200
                if size >= BATCH_BYTES:
                    yield flush()
                    rows, size = [], 0
    parser.end()
    yield flush()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the gzip archives under ``path``.

    Archives must be compressed (``.gz``): Spark would cut a plain one into splits in the middle of records.
    """
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")
                        ).mapInArrow(_read, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``capture_id``, ``response``, ``requests``, ``metadata`` (nested records).

    Requests and metadata go to every record they are concurrent to. A record id that stands repeatedly counts once for
    the response; further copies of requests and metadata stay in their arrays.
    """
    answers = F.col("warc_type").isin("response", "revisit", "resource")
    linked = records.withColumn("capture_id", F.explode(
        F.when(answers | (F.size("concurrent_to") == 0), F.array("record_id")).otherwise(F.array_distinct("concurrent_to"))))
    fields = [f for f in records.columns if f != "concurrent_to"]
    picked = [F.first(F.when(answers, F.col(f)), ignorenulls=True).alias(f"r_{f}") for f in fields]
    small = F.struct("record_id", "warc_type", "target_uri", "headers", "http_headers", "payload")
    grouped = linked.groupBy("capture_id").agg(
        *picked, F.collect_list(F.when(F.col("warc_type") == "request", small)).alias("requests"),
        F.collect_list(F.when(F.col("warc_type") == "metadata", small)).alias("metadata"))
    # a plain struct: a query that reads some fields of it carries only those through the shuffle
    return grouped.select("capture_id", F.struct(*(F.col(f"r_{f}").alias(f) for f in fields)).alias("response"),
                          "requests", "metadata")


def field(records: Column, name: str) -> Column:
    """A ``name: value`` line of the first record in an array of metadata records, as a number."""
    text = F.decode(F.get(records, F.lit(0))["payload"], "UTF-8")
    return F.nullif(F.regexp_extract(text, rf"(?m)^{name}: (-?\d+)", 1), F.lit("")).cast("long")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    write_archives(deduplicated(table(spark, sf_dir, "pages")), path)
    captures = assemble(read_archives(spark, path))
    return captures.select(
        field(F.col("metadata"), "page-id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.warc_type").alias("record_type"),
        field(F.col("metadata"), "refers-to-page").alias("refers_to"))


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT hex, max(page_id) AS stored FROM p GROUP BY hex),
bits AS (
    SELECT hex, list_aggregate(list_transform(generate_series(1, 32), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
            (CAST(concat('0x', substr(hex, 10 * ((k - 1) // 8) + 1, 10)) AS BIGINT)
             >> CAST(35 - 5 * ((k - 1) % 8) AS BIGINT)) & 31 AS INTEGER), 1)), 'string_agg', '') AS digest
    FROM d)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = stored THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = stored THEN NULL ELSE stored END AS refers_to
FROM p JOIN d USING (hex) JOIN bits USING (hex)
"""
