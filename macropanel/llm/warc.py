"""WARC: archives written and read by Spark, and transactions assembled from their records.

``write_archives`` writes three records per page: a request, a response (or a revisit of the response that has
an equal payload) and a metadata record; request and metadata name their capture in WARC-Concurrent-To. A
record is one row of Spark's text writer with CRLF CRLF as line separator, which is the format's own record
end; files are compressed by the writer.

``read_records`` reads any such archives: Spark's text reader splits files at the version line, one task streams a
(gzipped, so unsplit) file, and a record whose block holds that line itself is put together again by its
Content-Length. ``captures`` joins the records by their concurrent-to identifiers and returns one nested row per
capture; revisits find their response by its record id.

Defined results: a null html is the empty payload; a null url writes no WARC-Target-URI; a null page_id sorts
last among equal payloads and reads back null; rows that repeat a (page_id, url, html) write equal records and
come back as often as they were written; of equal payloads that of the smallest page_id is the response; a very
long payload is one record, joined once; an empty table writes and reads an empty archive; columns beside
page_id, url and html are not read. A record cut off by the end of its file comes back with complete = false.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macropanel.llm.common import Scratch

#: Payloads of at least so many bytes are written once and revisited.
MIN_REVISIT_BYTES = 0
VERSION = "WARC/1.0\r\n"
CRLF = "\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

RECORD = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, declared_digest string, "
    "payload_digest string, payload_bytes long, fields map<string,string>, payload binary, complete boolean"
)
B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex_: Column) -> Column:
    """Upper-case base32 of 160 bits given as 40 hex digits: 5 digits make 4 characters."""

    def four(i: Column) -> Column:
        bits = F.conv(F.substring(hex_, 5 * i + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substring(F.lit(B32), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def _urn(kind: str) -> Column:
    """A record id from the record's own content."""
    key = [F.lit(kind), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), F.col("digest")]
    h = F.md5(F.concat_ws("\u0001", *key).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """The record's text; a header whose value is null is left out."""
    lines = [F.concat(F.lit(f"{k}: "), v if isinstance(v, Column) else F.lit(v), F.lit(CRLF)) for k, v in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF))
    return F.concat(F.lit(VERSION), *[F.coalesce(x, F.lit("")) for x in lines], length, block)


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """The pages as WARC files under ``path``; of equal payloads the smallest (page_id, url) is the response."""
    scratch = Scratch(pages.sparkSession, "warc")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.col("url").cast("string"), r"[\r\n]", " ").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html").cast("long"))
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.coalesce("url", F.lit("")).alias("url"))
    first = p.groupBy("digest", "size").agg(F.min(place).alias("first"), F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("size") >= min_revisit_bytes))
    # a written table, so of known size: broadcast under the session's threshold, else a join that AQE can split
    first = scratch.save(first.select(F.col("digest").alias("_d"), F.col("size").alias("_s"), "first"), "first")
    p = p.join(first, (F.col("digest") == F.col("_d")) & (F.col("size") == F.col("_s")), "left")
    p = p.withColumn("revisit", F.coalesce(place != F.col("first"), F.lit(False)))
    again = F.col("first")
    origin = F.md5(F.concat_ws("\u0001", F.lit("capture"), F.coalesce(again["page_id"].cast("string"), F.lit("")), again["url"], F.col("digest")).cast("binary"))
    cut = [F.substring(origin, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    refers = F.when(F.col("revisit"), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">")))
    capture = _urn("capture")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(CRLF + CRLF))
    uri = ("WARC-Target-URI", F.col("url"))
    response = _record(
        [("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")), ("WARC-Record-ID", capture), ("WARC-Date", DATE), uri,
         ("WARC-Profile", F.when(F.col("revisit"), PROFILE)), ("WARC-Refers-To", refers), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))),
         ("Content-Type", "application/http; msgtype=response")],
        F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html"))),
    )
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-z]+://([^/?#]*)", 1)
    request = _record(
        [("WARC-Type", "request"), ("WARC-Record-ID", _urn("request")), ("WARC-Date", DATE), uri, ("WARC-Concurrent-To", capture), ("Content-Type", "application/http; msgtype=request")],
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(CRLF + CRLF)),
    )
    metadata = _record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata")), ("WARC-Date", DATE), uri, ("WARC-Concurrent-To", capture), ("Content-Type", "application/warc-fields")],
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)),
    )
    # the fastest level: an archive is written once and read once here
    rows = p.select(F.explode(F.array(request, response, metadata)).alias("value"))
    rows.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def parse(raw: bytes) -> dict | None:
    """One record without its version line; None while its block is not all there."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    head: dict[str, str] = {}
    for line in raw[:end].decode("utf-8", "replace").split(CRLF):
        name, _, value = line.partition(":")
        head[name.strip().lower()] = value.strip()
    size = int(head.get("content-length", "0"))
    block = raw[end + 4 : end + 4 + size]
    head_of_block, payload, fields = b"", block, {}
    if "application/http" in head.get("content-type", ""):
        head_of_block, _, payload = block.partition(b"\r\n\r\n")
    elif head.get("content-type", "") == "application/warc-fields":
        head_of_block, payload = block, b""
    for line in head_of_block.decode("utf-8", "replace").split(CRLF):
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    digest = head.get("warc-payload-digest", "")
    return {
        "type": head.get("warc-type"),
        "record_id": head.get("warc-record-id"),
        "concurrent_to": head.get("warc-concurrent-to"),
        "refers_to": head.get("warc-refers-to"),
        "target_uri": head.get("warc-target-uri"),
        "date": head.get("warc-date"),
        "declared_digest": digest.removeprefix("sha1:") or None,
        "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        "payload_bytes": len(payload),
        "fields": list(fields.items()),
        "payload": payload,
        "complete": len(block) == size,
    }


def _announced(raw: bytes) -> int | None:
    """Bytes of the record that the headers announce, headers and all; None while these are not all there."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    at = raw[:end].lower().find(b"content-length:")
    return end + 4 + (int(raw[at + 15 : end].split(b"\r\n", 1)[0]) if at >= 0 else 0)


class _Parts:
    """A record in the parts that version lines cut it into: joined once, when it is whole."""

    def __init__(self, line: bytes):
        self.line, self.parts, self.size, self.need = line, [], 0, None

    def add(self, part: bytes) -> None:
        before = (self.parts[-1][-3:] + self.line if self.parts else b"")[-3:]
        self.size += len(part) + (len(self.line) if self.parts else 0)
        self.parts.append(part)
        if self.need is None and b"\r\n\r\n" in before + part:
            self.need = _announced(self.line.join(self.parts))

    def whole(self) -> bool:
        return self.need is not None and self.size >= self.need

    def take(self) -> bytes:
        raw = self.line.join(self.parts)
        self.parts, self.size, self.need = [], 0, None
        return raw


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per WARC record under ``path`` (gzipped files: one task streams one file, record by record)."""
    kinds = [
        pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
        pa.map_(pa.string(), pa.string()), pa.binary(), pa.bool_(),
    ]
    names = ["type", "record_id", "concurrent_to", "refers_to", "target_uri", "date", "declared_digest", "payload_digest", "payload_bytes", "fields", "payload", "complete"]
    step, line = 8_000_000, VERSION.encode()

    def kernel(batches):
        held, of, out, size = _Parts(line), None, [], 0

        def made():
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], k) for n, k in zip(names, kinds, strict=True)], names=names)

        for batch in batches:
            for value, file in zip(batch.column(0), batch.column(1), strict=True):
                part, at = value.as_py(), file.as_py()
                if held.size and (at != of or held.whole()):
                    n = held.size
                    if (r := parse(held.take())) is not None:
                        out.append(r)
                        size += n
                held.add(part) if held.size or part else None  # a version line inside the block: the record goes on
                of = at
                if size > step:
                    yield made()
                    out, size = [], 0
        if held.size and (r := parse(held.take())) is not None:
            out.append(r)
        if out:
            yield made()

    text = spark.read.option("lineSep", VERSION).text(path)
    rows = text.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
    return rows.mapInArrow(kernel, RECORD)


def captures(records: DataFrame, payload: bool = True) -> DataFrame:
    """One nested row per capture: response (or revisit), request and metadata, joined by concurrent-to identifiers.

    A capture of several requests or metadata records keeps that of the smallest record id and their number, so
    its row stays bounded. A capture written n times gives n rows. ``response.payload`` is null with
    ``payload=False``, and then no payload is shuffled.
    """
    body = F.col("payload") if payload else F.lit(None).cast("binary")
    main = F.col("type").isin("response", "revisit")
    one = F.struct("record_id", "type", "target_uri", "date", "refers_to", "declared_digest", "payload_digest", "payload_bytes", "complete", body.alias("payload"))
    side = F.struct("record_id", "target_uri", "date", "payload_bytes", F.array_sort(F.map_entries("fields")).alias("fields"))
    keyed = records.select(F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("capture_id"), "type", one.alias("one"), side.alias("side"))
    of = lambda t, c: F.when(F.col("type") == t, F.col(c))
    got = keyed.where("capture_id is not null").groupBy("capture_id").agg(
        F.min(F.when(F.col("type").isin("response", "revisit"), F.col("one"))).alias("response"),
        F.count(F.when(F.col("type").isin("response", "revisit"), 1)).alias("n"),
        F.min(of("request", "side")).alias("request"), F.count(of("request", "type")).alias("requests"),
        F.min(of("metadata", "side")).alias("metadata"), F.count(of("metadata", "type")).alias("metadata_records"),
    )
    times = F.explode(F.sequence(F.lit(1), F.greatest(F.col("n"), F.lit(1)).cast("int")))
    return got.select("capture_id", "response", "request", "requests", "metadata", "metadata_records", "n", times.alias("copy"))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: the pages written to archives, read back, assembled; revisits resolved to their response's page."""
    scratch = Scratch(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), f"{scratch.root}/archive")
    c = captures(read_records(spark, f"{scratch.root}/archive"), payload=False).where("n > 0")
    page = F.nullif(F.element_at(F.map_from_entries("metadata.fields"), F.lit("page-id")), F.lit("")).cast("long")
    c = scratch.save(c.select("capture_id", page.alias("page_id"), "copy", "response"), "captures")
    seen = c.where("copy = 1 and response.type = 'response'").select(
        F.col("capture_id").alias("_c"), F.col("page_id").alias("_page"), F.col("response.payload_bytes").alias("_bytes"), F.col("response.payload_digest").alias("_digest")
    )
    r = c.join(seen, F.col("response.refers_to") == F.col("_c"), "left")
    again = F.col("response.type") == "revisit"
    return r.select(
        "page_id",
        F.when(again, F.col("_bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("_digest")).otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(again, F.col("_page")).alias("refers_to"),
    )


#: DuckDB: payloads are grouped as they are; base32 by hand from the hex digest.
ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(sha1(h), ((i // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
