"""WARC archives: written and read through Spark's text source, and assembled into one nested row per capture.

A capture is a request, a response (or a revisit, if another page has the same payload) and a metadata record; request
and metadata name the response in WARC-Concurrent-To. An archive is one gzip file. As WARC records end with an empty
line, the text writer with that line separator writes them, on any file system Spark can reach. The reader cuts the
stream at version lines and puts a record together again, by its Content-Length, where a payload holds such a line.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetloom.llm.common import pick
from sheetloom.session import stage

_VERSION, _CRLF, _END = "WARC/1.1\r\n", "\r\n", "\r\n\r\n"

_RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, uri string, date string, "
    "payload_digest string, http_head string, payload binary, payload_bytes long, content string"
)


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, from its hex form, 40 bits at a time."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(kind: str, capture: Column) -> Column:
    digest = F.md5(F.concat_ws("|", F.lit(kind), capture).cast("binary"))
    cuts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], content: Column) -> Column:
    """The text of a record without the empty line that ends it; a null header is left out."""
    lines = [F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value) for name, value in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(content).cast("string"))
    return F.concat(F.lit(_VERSION), F.concat_ws(_CRLF, *lines, length), F.lit(_END), content)


def write_archives(
    pages: DataFrame,
    path: str,
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Write every row of ``pages`` as a capture to gzip archives below ``path``.

    Of rows with equal payloads of at least ``min_bytes`` bytes that with the smallest id is the response (of repeated
    rows one; null ids last), the others revisit it; smaller payloads are all responses. A null html is an empty
    payload. Control characters and blanks of a URL are %20 in headers; the metadata has it unchanged. Other
    columns are not written. ``pages`` is read twice and must give the same rows in the same partitions, as tables do.
    """
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col)
    payload = F.coalesce("html", F.lit(""))
    rows = rows.select("page_id", "url", payload.alias("html"), F.monotonically_increasing_id().alias("capture"))
    digests = rows.select("page_id", "capture", base32_sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("bytes"))
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "capture"))
    shared = digests.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    shared = stage(shared.where("n > 1").select("digest", F.col("first.capture").alias("first")), "payloads")
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary"))).join(shared, "digest", "left")

    revisit = (F.octet_length("html") >= min_bytes) & (F.col("first") != F.col("capture"))
    uri = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"),
        F.lit(_END),
    )
    response_id = _record_id("response", F.col("capture"))
    common = [("WARC-Target-URI", uri), ("WARC-Date", date)]
    response = _record(
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", response_id),
            *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Refers-To", F.when(revisit, _record_id("response", F.col("first")))),
            ("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        F.when(revisit, head).otherwise(F.concat(head, "html")),
    )
    target = F.coalesce(F.nullif(F.regexp_extract(uri, r"^[^:/]+://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    host = F.coalesce(F.regexp_extract(uri, r"^[^:/]+://([^/?#]*)", 1), F.lit(""))
    request = _record(
        [("WARC-Type", "request"), ("WARC-Record-ID", _record_id("request", F.col("capture"))), *common,
         ("WARC-Concurrent-To", response_id), ("Content-Type", "application/http; msgtype=request")],
        F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(_END)),
    )
    metadata = _record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", _record_id("metadata", F.col("capture"))), *common,
         ("WARC-Concurrent-To", response_id), ("Content-Type", "application/json")],
        F.to_json(F.struct("page_id", "url")),
    )
    records = rows.select(F.explode(F.array(response, request, metadata)).alias("value"))
    records.write.option("lineSep", _END).option("compression", "gzip").text(path)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the pieces between version lines, which come in order, file by file."""
    version, at_file, pieces, missing = _VERSION.encode(), None, [], 0
    for batch in batches:
        found = []
        for file, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if file != at_file:
                if pieces:
                    raise ValueError(f"{at_file} ends within a record")
                at_file = file
                continue  # what stands before the first version line: nothing
            if pieces:
                pieces += [version, piece]
                missing -= len(version) + len(piece)
            else:
                head, _, content = piece.partition(_END.encode())
                fields = dict(line.split(": ", 1) for line in head.decode().split(_CRLF))
                pieces, missing = [content], int(fields["Content-Length"]) - len(content)
            if missing <= 0:
                found.append(_row(fields, b"".join(pieces)[: int(fields["Content-Length"])]))
                pieces = []
        if found:
            yield pa.RecordBatch.from_pylist(found, schema=_ARROW)
    if pieces:
        raise ValueError(f"{at_file} ends within a record")


_ARROW = pa.schema({
    "record_id": pa.string(), "type": pa.string(), "concurrent_to": pa.string(), "refers_to": pa.string(),
    "uri": pa.string(), "date": pa.string(), "payload_digest": pa.string(), "http_head": pa.string(),
    "payload": pa.binary(), "payload_bytes": pa.int64(), "content": pa.string(),
})


def _row(fields: dict[str, str], content: bytes) -> dict:
    kind = fields["WARC-Type"]
    row = dict.fromkeys(_ARROW.names) | {"record_id": fields["WARC-Record-ID"], "type": kind}
    names = {"concurrent_to": "WARC-Concurrent-To", "refers_to": "WARC-Refers-To", "uri": "WARC-Target-URI", "date": "WARC-Date"}
    row |= {column: fields.get(header) for column, header in names.items()}
    if kind not in ("response", "revisit"):
        return row | {"content": content.decode()}
    head, _, payload = content.partition(_END.encode())
    row["http_head"] = head.decode()
    row["payload_digest"] = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "revisit":
        length = next(x for x in row["http_head"].split(_CRLF) if x.lower().startswith("content-length:"))
        return row | {"payload_bytes": int(length.partition(":")[2])}
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest != row["payload_digest"]:
        raise ValueError(f"{row['record_id']}: the payload does not have its digest")
    return row | {"payload": payload, "payload_bytes": len(payload)}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``, payloads checked against their digests; an archive is read in one piece."""
    pieces = spark.read.option("lineSep", _VERSION).text(path)
    pieces = pieces.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(_parsed, _RECORD)


_RESPONSE = ("type", "uri", "date", "http_head", "payload", "payload_bytes", "payload_digest", "refers_to")


def _joined(records: DataFrame) -> DataFrame:
    """Requests and metadata joined to the response or revisit that they are concurrent to, by the response's id; the
    fields of the response are still columns, so that those not asked for are not moved."""
    main = F.col("type").isin("response", "revisit")
    capture = F.when(main, F.col("record_id")).when(F.col("type").isin("request", "metadata"), F.col("concurrent_to"))
    keyed = records.withColumn("capture_id", capture).where("capture_id IS NOT NULL")
    entry = F.struct("record_id", "content")
    beside = lambda kind: F.array_sort(F.collect_list(F.when(F.col("type") == kind, entry)))
    return keyed.groupBy("capture_id").agg(
        *(F.first(F.when(main, F.col(c)), ignorenulls=True).alias(f"r_{c}") for c in _RESPONSE),
        beside("request").alias("requests"),
        beside("metadata").alias("metadata"),
    )


def _response() -> Column:
    return F.struct(*(F.col(f"r_{c}").alias(c) for c in _RESPONSE)).alias("response")


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id, nested response, requests and metadata.

    A capture without a response has a response of null fields; one without requests or metadata has empty arrays.
    """
    return _joined(records).select("capture_id", _response(), "requests", "metadata")


def captures(spark: SparkSession, path: str) -> DataFrame:
    """:func:`assemble` of the archives, with page_id and url of the metadata and, for revisits, the page they refer to.

    Columns: page_id, url, refers_to, capture_id, response, requests, metadata.
    """
    known = F.from_json(F.get("metadata", F.lit(0))["content"], "page_id long, url string")
    every = _joined(read_records(spark, path))
    ids = read_records(spark, path).where("type = 'metadata'")
    page = F.from_json("content", "page_id long")["page_id"].alias("referred")
    ids = stage(ids.select(F.col("concurrent_to").alias("first"), page), "captures")
    every = every.withColumn("first", F.coalesce("r_refers_to", "capture_id"))  # no hot null key
    joined = every.join(ids, "first", "left")
    refers_to = F.when(F.col("r_refers_to").isNotNull(), F.col("referred")).alias("refers_to")
    return joined.select(known["page_id"].alias("page_id"), known["url"].alias("url"), refers_to, "capture_id", _response(), "requests", "metadata")
