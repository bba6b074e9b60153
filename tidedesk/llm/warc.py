"""WARC archives: writing pages as records, and reassembling segmented records on reading.

A response longer than a segment is cut: its first piece is the response record, the others are continuation
records that name the first as their origin, number themselves and, in the last, state the total length. On
reading, pieces are grouped by origin, ordered by number and checked against that length; then the chunked
transfer framing of the HTTP response is decoded. Pages with a payload that an earlier page has already are
written as revisits of it, without the payload.

Archives are written by Spark's text writer, whose line separator is the blank line that ends a record, and
read by its text reader, whose separator is the version line that begins one. So they lie in any store Spark
reaches, and a task holds one batch of records at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType, BooleanType, StructType

from tidedesk.llm.common import shared_folder, stored

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Payloads with fewer bytes are never revisits.
REVISIT_BYTES = 100
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 8_192
DATE = "1970-01-01T00:00:00Z"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
RECORD = pa.schema(
    [
        ("kind", pa.string()),
        ("record", pa.string()),
        ("page", pa.string()),
        ("number", pa.int32()),
        ("total", pa.int64()),
        ("digest", pa.string()),
        ("length", pa.int64()),
        ("refers", pa.string()),
        ("block", pa.binary()),
        ("sized", pa.bool_()),
    ]
)
RECORD_DDL = (
    "kind string, record string, page string, number int, total long, digest string, length long, refers string,"
    " block binary, sized boolean"
)
#: What every version line begins with; archives of others are often of version 1.0.
ANY_VERSION = "WARC/1."


def _pieces(block: Column, size: int) -> Column:
    """The bytes of a binary column in pieces of ``size``; of no bytes, one empty piece."""
    starts = F.sequence(F.lit(0), F.greatest(F.octet_length(block) - 1, F.lit(0)), F.lit(size))
    return F.transform(starts, lambda at: F.substring(block, at + 1, F.lit(size)))


def _chunked(payload: Column) -> Column:
    """Chunked transfer framing, as a string of the same bytes."""
    chunks = F.filter(_pieces(payload, CHUNK_BYTES), lambda c: F.octet_length(c) > 0)
    framed = F.transform(
        chunks, lambda c: F.concat(F.hex(F.octet_length(c)), F.lit("\r\n"), c.cast("string"), F.lit("\r\n"))
    )
    return F.concat(F.array_join(framed, ""), F.lit("0\r\n\r\n"))


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")


def write_archives(pages: DataFrame, path: str) -> None:
    """One response or revisit for every row of ``pages`` (``page_id``, ``url``, ``html``), as gzip archives in ``path``.

    Of pages with equal payloads of at least ``REVISIT_BYTES``, the one with the least ``page_id`` is the
    response; rows that repeat its id are responses, too. A NULL id is never the least. NULL html is an
    empty payload; a NULL url gives no target.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    url = F.regexp_replace("url", "[\r\n]+", " ")
    rows = pages.select("page_id", url.alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    rows = rows.withColumn("length", F.octet_length("payload").cast("long"))
    first = stored(
        rows.where(F.col("length") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first"),
        "first_pages",
    )
    # The scan of ``first`` is broadcast if it is small; else adaptive execution splits a hot payload.
    known = rows.join(first, "digest", "left").withColumn("refers", F.expr("nullif(first, page_id)"))
    revisit = F.col("refers").isNotNull()
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, "").otherwise(_chunked(F.col("payload")))).cast("binary")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    named = known.select(
        "*", F.concat_ws("#", page, F.monotonically_increasing_id().cast("string")).alias("record"), block.alias("block")
    )
    pieces = named.select(
        "page_id", "url", "digest", "length", "refers", "record",
        F.octet_length("block").alias("total"),
        F.posexplode(_pieces(F.col("block"), SEGMENT_BYTES)).alias("at", "piece"),
    )
    begins, segmented = F.col("at") == 0, F.col("total") > SEGMENT_BYTES
    last = (F.col("at") + 1) * SEGMENT_BYTES >= F.col("total")
    kind = F.when(~begins, "continuation").when(revisit, "revisit").otherwise("response")
    name = F.when(begins, F.col("record")).otherwise(F.concat_ws("#", "record", F.col("at").cast("string")))
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    record = F.concat(
        F.lit(VERSION),
        _header("WARC-Type", kind),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), name, F.lit(">"))),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", F.col("url")),
        _header("X-Page-ID", F.when(begins, F.col("page_id"))),
        _header("WARC-Payload-Digest", F.when(begins, F.concat(F.lit("sha256:"), "digest"))),
        _header("X-Payload-Length", F.when(begins, F.col("length"))),
        _header("WARC-Profile", F.when(begins & revisit, profile)),
        _header("WARC-Refers-To", F.when(begins, F.concat(F.lit("<urn:page:"), "refers", F.lit(">")))),
        _header("WARC-Segment-Number", F.when(segmented, F.col("at") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(~begins, F.concat(F.lit("<urn:page:"), "record", F.lit(">")))),
        _header("WARC-Segment-Total-Length", F.when(segmented & last, F.col("total"))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _header("Content-Length", F.octet_length("piece")),
        F.lit("\r\n"),
        F.col("piece").cast("string"),
    )
    pieces.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def _declared(head: bytes) -> int | None:
    """The length that a record's head declares; None if it declares none or no number."""
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon and name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value)
    return None


def _parse(head: bytes, block: bytes, sized: bool) -> dict:
    fields = {}
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")

    def number(name: str) -> int | None:
        return int(fields[name]) if fields.get(name, "").isdigit() else None

    def urn(name: str) -> str | None:
        return fields[name].removeprefix("<urn:page:").removesuffix(">") if name in fields else None

    return {
        "kind": fields.get("warc-type"),
        "record": urn("warc-segment-origin-id") or urn("warc-record-id"),
        "page": fields.get("x-page-id"),
        "number": number("warc-segment-number"),
        "total": number("warc-segment-total-length"),
        "digest": digest.removeprefix("sha256:") if (digest := fields.get("warc-payload-digest", "")).startswith("sha256:") else None,
        "length": number("x-payload-length"),
        "refers": urn("warc-refers-to"),
        "block": block,
        "sized": sized,
    }


def _records(segmented: bool):
    """Records from the text between version lines, in file order. A block that holds a version line itself has
    been cut there; its declared length tells, and it is joined again. A record without a length goes on to the next
    version line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_file = b"", None
        for batch in batches:
            found = []
            for piece, file in zip(batch.column(0), batch.column(1)):
                piece, file = piece.as_py(), file.as_py()
                if file != held_file:
                    held, held_file = b"", file
                held = held + ANY_VERSION.encode() + piece if held else piece
                head, blank, block = held.partition(b"\r\n\r\n")
                if not blank:
                    continue  # nothing before the first version line, or a version line inside the head
                size = _declared(head)
                if size is not None and len(block) < size:
                    continue
                held = b""
                if (b"\r\nwarc-segment-number:" in head.lower()) == segmented:
                    block = block.removesuffix(END.encode()) if size is None else block[:size]
                    found.append(_parse(head, block, size is not None))
            yield pa.RecordBatch.from_pylist(found, schema=RECORD)

    return run


@pandas_udf(StructType().add("payload", BinaryType()).add("sound", BooleanType()))
def _payloads(blocks: pd.Series) -> pd.DataFrame:
    """Payloads of HTTP responses, without their transfer framing."""
    out = []
    for block in blocks:
        head, _, body = block.partition(b"\r\n\r\n")
        out.append(dechunk(body) if b"transfer-encoding: chunked" in head.lower() else (body, True))
    return pd.DataFrame(out, columns=["payload", "sound"])


def dechunk(body: bytes) -> tuple[bytes, bool]:
    """The content of a chunked body, and whether its framing was whole."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0 or end + 2 + size + 2 > len(body):
            return b"".join(parts), False
        if size == 0:
            return b"".join(parts), True
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every response and revisit in the archives of ``path``, whole again.

    ``page`` (the id as text, NULL if it had none), ``record_type``, ``payload`` (NULL for revisits),
    ``payload_bytes`` and ``payload_digest`` of the full payload, ``refers`` (a page id as text), and ``sound``:
    the record states its own length, the pieces are all there, their lengths add up to the total, the framing was
    whole, and the payload has the SHA-256 and the length that its record states, if it does. Records of every version
    1 are read; other digests are not compared.
    """
    raw = spark.read.option("lineSep", ANY_VERSION).text(path).select(F.col("value").cast("binary"), "_metadata.file_path")
    single = raw.mapInArrow(_records(False), RECORD_DDL).withColumn("complete", F.col("sized"))
    pieces = raw.mapInArrow(_records(True), RECORD_DDL)

    def origin(column: str) -> Column:
        return F.max(F.when(F.col("number") == 1, F.col(column))).alias(column)

    # A group is one record: its pieces, in order, are what the record's block was.
    joined = pieces.groupBy("record").agg(
        *[origin(c) for c in ("kind", "page", "digest", "length", "refers")],
        F.max("total").alias("total"),
        F.max("number").alias("last"),
        F.bool_and("sized").alias("sized"),
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("all"),
    )
    block = F.array_join(F.transform("all", lambda p: p["block"].cast("string")), "").cast("binary")
    joined = joined.withColumn("block", block).withColumn(
        "complete",
        F.coalesce((F.octet_length("block") == F.col("total")) & (F.size("all") == F.col("last")) & F.col("sized"), F.lit(False)),
    )
    columns = ["kind", "page", "digest", "length", "refers", "block", "complete"]
    records = single.select(columns).unionByName(joined.select(columns)).where(F.col("kind").isin("response", "revisit"))
    decoded = records.withColumn("p", _payloads("block"))
    revisit = F.col("kind") == "revisit"
    payload = F.when(~revisit, F.col("p.payload"))
    own = decoded.select(
        "page", F.col("kind").alias("record_type"), "refers", "complete", "digest", "length",
        payload.alias("payload"), F.col("p.sound").alias("framed"),
    )
    digest = F.when(F.col("payload").isNull(), F.col("digest")).otherwise(F.sha2("payload", 256))
    length = F.when(F.col("payload").isNull(), F.col("length")).otherwise(F.octet_length("payload").cast("long"))
    as_stated = F.coalesce(digest == F.col("digest"), F.lit(True)) & F.coalesce(length == F.col("length"), F.lit(True))
    sound = F.col("complete") & (F.col("payload").isNull() | (F.col("framed") & as_stated))
    return own.select(
        "page", "record_type", "payload", length.alias("payload_bytes"), digest.alias("payload_digest"), "refers", sound.alias("sound")
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back. An empty table gives an empty result."""
    spark, path = pages.sparkSession, shared_folder(pages.sparkSession, "warc")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    found = read_archives(spark, path)
    return found.select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers").cast(kind).alias("refers_to"),
        "sound",
    )


# Workers get these functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
