"""WARC archives with revisit resolution (operator 6).

Archives are gzip files of WARC 1.1 records, written by Spark's text writer: a
record is one row, and the CRLF CRLF that ends every record is the writer's line
separator, so the files commit and retry like any Spark output. The reader lets
Spark split the stream before each ``WARC/1.1`` line and joins pieces again where
a block itself holds that sequence (its Content-Length tells), so memory is
bounded by one record, not by one file.

Revisits: headers alone (no payload) meet by payload digest; the record with the
largest key keeps the payload, every other becomes a ``revisit`` that refers to
it. Payloads are joined to those decisions by their own key, so copies of one
payload never gather in one task.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import join_hot, saved, ship

ship(__name__)

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
RECORD_START = RECORD_END + "WARC/1.1" + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "
DATE = "2024-01-01T00:00:00Z"  # the pages table has no capture time
MIN_PAYLOAD = 0

RECORDS = ("key long, uri string, date string, record_id string, record_type string, payload_digest string, "
           "payload_bytes long, refers_to long, payload binary")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: ten hex digits (40 bits) are eight base32 digits."""
    digest = F.sha1(payload)
    eights = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*eights)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One response record per page; null html is an empty payload, a null URL is empty."""
    payload = F.encode(F.coalesce(F.col(f"`{html_col}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("key"),
                        F.regexp_replace(F.coalesce(F.col(f"`{url_col}`"), F.lit("")), r"[\r\n]", "").alias("uri"),
                        payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": base32_sha1(F.col("payload")), "payload_bytes": F.octet_length("payload").cast("long")})
    h = F.md5(F.concat_ws("|", F.col("key").cast("string"), "uri", "payload_digest"))
    uuid = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return rows.select("key", "uri", F.lit(DATE).alias("date"), F.concat(F.lit("urn:uuid:"), uuid).alias("record_id"),
                       F.lit("response").alias("record_type"), "payload_digest", "payload_bytes",
                       F.lit(None).cast("long").alias("refers_to"), "payload")


def resolve_revisits(records: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Make every record whose payload another record also has a revisit of the one with the largest key.

    ``records``: as :func:`page_records` or :func:`read_warc` give them, responses and
    (from older archives) revisits alike; a revisit counts as a copy of its
    payload, and a revisit whose original is not among the records stays as it is.
    Payloads under ``min_payload`` bytes stay responses. Null keys are below all
    others. Repeated rows (equal record ids) stay what they are together. Adds
    origin_id, origin_uri and origin_date for revisits.
    """
    heads = saved(records.drop("payload"), "warc-heads")
    rank = F.struct(F.col("key").isNotNull().alias("known"), "key", "uri", "record_id", "date")
    origins = (heads.filter(F.col("payload_bytes") >= min_payload).groupBy("payload_digest")
               .agg(F.count(F.lit(1)).alias("n"),
                    F.max(F.when(F.col("record_type") == "response", rank)).alias("origin")))
    origins = saved(origins.filter((F.col("n") > 1) & F.col("origin").isNotNull()), "warc-origins")
    met = join_hot(heads.select("payload_digest", "record_id"), origins, "payload_digest", "n")
    decided = saved(met.filter(F.col("record_id") != F.col("origin.record_id")).select(
        "record_id", F.col("origin.key").alias("to"), F.col("origin.record_id").alias("origin_id"),
        F.col("origin.uri").alias("origin_uri"), F.col("origin.date").alias("origin_date")).distinct(), "warc-revisits")
    joined = records.join(decided, "record_id", "left")
    again = F.col("origin_id").isNotNull()
    return joined.withColumns({
        "record_type": F.when(again, F.lit("revisit")).otherwise(F.col("record_type")),
        "refers_to": F.when(again, F.col("to")).otherwise(F.col("refers_to")),
        "payload": F.when(again, F.lit(None).cast("binary")).otherwise(F.col("payload"))}).drop("to")


def write_warc(records: DataFrame, path: str, per_file: int = 100_000) -> None:
    """Write records (with the columns of :func:`resolve_revisits`) as gzip archives with fresh headers."""
    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(name + ": "), value.cast("string"), F.lit(CRLF)), F.lit(""))

    response = F.col("record_type") == "response"
    http = F.concat(F.lit(HTTP_HEAD), F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    length = F.when(response, F.octet_length(http) + F.col("payload_bytes")).otherwise(F.lit(0))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        line("WARC-Target-URI", F.col("uri")), line("WARC-Date", F.col("date")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(response, F.lit("")).otherwise(F.concat(
            F.lit(f"WARC-Profile: {PROFILE}{CRLF}"), line("WARC-Refers-To", F.concat(F.lit("<"), F.col("origin_id"), F.lit(">"))),
            line("WARC-Refers-To-Target-URI", F.col("origin_uri")), line("WARC-Refers-To-Date", F.col("origin_date")))),
        line("X-Record-Key", F.col("key")), line("X-Refers-To-Key", F.col("refers_to")), line("X-Payload-Length", F.col("payload_bytes")),
        F.lit("Content-Type: application/http; msgtype=response" + CRLF), line("Content-Length", length), F.lit(CRLF))
    block = F.when(response, F.concat(F.encode(http, "UTF-8"), F.col("payload"))).otherwise(F.lit(b""))
    # bytes under the name of a string, which the text writer writes unchanged
    rows = records.select(F.concat(F.encode(head, "UTF-8"), block).cast("string").alias("value"))
    rows.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def _parsed(record: bytes):
    head, _, block = record.partition(b"\r\n\r\n")
    fields = {}
    for text in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = text.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, block


def _complete(record: bytes) -> bool:
    """Is the block as long as its header says?"""
    head, found, block = record.partition(b"\r\n\r\n")
    if not found:
        return False
    for text in head.split(b"\r\n"):
        if text[:15].lower() == b"content-length:":
            return len(block) >= int(text[15:])
    return False


def _row(record: bytes) -> tuple:
    fields, block = _parsed(record)
    whole = lambda name: int(fields[name]) if name in fields else None
    block = block[:int(fields["content-length"])]
    payload = None
    if fields.get("warc-type") == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        n, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    else:
        n, digest = whole("x-payload-length"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    return (whole("x-record-key"), fields.get("warc-target-uri"), fields.get("warc-date"), fields.get("warc-record-id", "").strip("<>"),
            fields.get("warc-type"), digest, n, whole("x-refers-to-key"), payload, fields.get("warc-refers-to", "").strip("<>") or None,
            fields.get("warc-refers-to-target-uri"), fields.get("warc-refers-to-date"))


def _read(with_payload: bool):
    names = ["key", "uri", "date", "record_id", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload",
             "origin_id", "origin_uri", "origin_date"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(),
             pa.string(), pa.string(), pa.string()]

    def batch(rows):
        cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        if not with_payload:
            cols[8] = pa.nulls(len(rows), pa.binary())
        return pa.RecordBatch.from_arrays(cols, names)

    def run(batches):
        held, file, rows, size = b"", None, [], 0
        for b in batches:
            paths, values = b.column(1), b.column(0)
            for i in range(b.num_rows):
                piece, path = values[i].as_py(), paths[i].as_py()
                if path != file:
                    held, file = b"", path
                if held:
                    held += RECORD_START.encode() + piece  # the block itself had the separator in it
                else:
                    held = piece if piece.startswith(b"WARC/1.1") else b"WARC/1.1\r\n" + piece
                if _complete(held):
                    rows.append(_row(held))
                    size += len(held)
                    held = b""
                    if size > 8_000_000:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    return run


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of gzip archives below ``path``; the digest and length of responses are those of the payload read.

    ``with_payload=False`` leaves payloads null (they are read and checked, not passed on).
    """
    pieces = (spark.read.option("lineSep", RECORD_START).text(path)
              .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path")))
    return pieces.mapInArrow(_read(with_payload), RECORDS + ", origin_id string, origin_uri string, origin_date string")


def replay(records: DataFrame) -> DataFrame:
    """(record_id, key, payload) of every record: a revisit gets the payload of the response that it refers to."""
    originals = saved(records.filter("record_type = 'response'").select(F.col("record_id").alias("origin_id"), F.col("payload").alias("whole")), "warc-originals")
    own = records.filter("record_type = 'response'").select("record_id", "key", "payload")
    return own.unionByName(records.filter("record_type <> 'response'").select("record_id", "key", "origin_id")
                           .join(originals, "origin_id", "left").select("record_id", "key", F.col("whole").alias("payload")))


def archive_pages(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD, **columns: str) -> DataFrame:
    """Write ``pages`` as deduplicated archives below ``path`` and read them back: one row per page."""
    write_warc(resolve_revisits(page_records(pages, **columns), min_payload), path)
    back = read_warc(pages.sparkSession, path, with_payload=False)
    return back.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", "record_id")


# Not the record ids and addresses: page_id .. refers_to are what the SQL gives.
ORACLE_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
             list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(hex, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT, 1)), 'string_agg', '') AS payload_digest
      FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM d WINDOW same AS (PARTITION BY payload_digest)
"""
