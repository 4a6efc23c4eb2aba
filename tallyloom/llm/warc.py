"""WARC archives: writing captures as record transactions, and assembling them again.

A page becomes three records, ``request``, ``metadata`` and ``response`` (or ``revisit``); the first
two name the third in ``WARC-Concurrent-To``. Records are text lines that end in two line breaks, the
WARC record end, so Spark's text writer makes the archives wherever its file systems reach.
Reading parses the archives record by record, by ``Content-Length``, and joins every transaction
back into one nested row.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import read, scratch, ship, stored

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
#: Bytes of an archive, before compression; a task reads and parses one archive at a time.
FILE_BYTES = 128 << 20
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORDS = (
    "record_id string, type string, concurrent_to string, uri string, date string, digest string, "
    "refers_to string, payload_bytes bigint, fields map<string,string>, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five bytes of the digest make eight letters."""
    digest = F.sha1(payload)
    fives = [F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 10).cast("bigint") for i in range(4)]
    return F.concat(*(F.substring(F.lit(BASE32), F.shiftright(five, shift).bitwiseAND(31).cast("int") + 1, F.lit(1)) for five in fives for shift in range(35, -1, -5)))


def captures(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A row for every row of ``pages`` with what its record will be: ``repeats`` names the record that a revisit repeats.

    Of equal payloads of at least ``least_bytes`` bytes the one with the largest ``page_id`` is the response; of several
    with that id the one with the largest url, and of those the first. A missing payload is an empty one, a missing id or url
    is smaller than any. Rows that repeat id, payload and url are numbered from 1. Other columns are ignored.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("bigint"))
    # One column names equal rows, so that the payloads are dealt once, for their repeats and for the join.
    rows = rows.withColumn("capture", F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), "sha", F.coalesce(F.concat(F.lit("="), "url"), F.lit("none"))))
    ids = rows.groupBy("capture").agg(F.max("page_id").alias("page_id"), F.max("url").alias("url"), F.max("sha").alias("sha"), F.max("bytes").alias("bytes"))
    # Written first: a payload of many pages then meets its response in a join whose skew Spark can split.
    first = stored(ids.groupBy("sha").agg(F.max(F.struct("page_id", "url")).alias("keep")), "payload-classes")
    is_kept = F.col("page_id").eqNullSafe(F.col("keep.page_id")) & F.col("url").eqNullSafe(F.col("keep.url"))
    told = ids.join(first, "sha").select("capture", "keep", is_kept.alias("is_kept"))
    unique = rows.groupBy("capture").agg(F.max(F.struct("page_id", "url", "payload", "bytes", "sha")).alias("row"), F.count("*").alias("n"))
    each = unique.join(told, "capture").select("row.*", "keep", "is_kept", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("number"))
    repeats = F.when((F.col("bytes") >= least_bytes) & ~(F.col("is_kept") & (F.col("number") == 1)), F.col("keep"))
    return each.select("page_id", "url", "payload", "bytes", "sha", "number", repeats.alias("repeats"))


def _record_id(kind: str, page: Column, sha: Column, url: Column, number: Column) -> Column:
    named = F.concat_ws("\n", F.lit(kind), F.coalesce(page.cast("string"), F.lit("none")), sha, number.cast("string"), F.coalesce(F.concat(F.lit("="), url), F.lit("none")))
    digest = F.md5(named)
    parts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _clean(text: Column) -> Column:
    return F.regexp_replace(text, r"[\r\n]+", " ")


def records_within(pages: DataFrame, file_bytes: int = FILE_BYTES, most: int = 30_000) -> int:
    """So many records of these pages make an archive of about ``file_bytes`` bytes, uncompressed; ``most`` at most."""
    size = pages.agg(F.avg(F.coalesce(F.octet_length(F.col("html").cast("string")), F.lit(0)))).first()[0] or 0
    return int(max(3, min(most, 3 * file_bytes // (size + 1_500))))


def write_archives(found: DataFrame, folder: str, records_per_file: int = 30_000) -> None:
    """Three records for each capture, as compressed archives of bounded length."""

    def own_id(kind: str) -> Column:
        return _record_id(kind, F.col("page_id"), F.col("sha"), F.col("url"), F.col("number"))

    uri = _clean(F.col("url"))
    response = own_id("response")
    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))

    def record(kind: Column, record_id: Column, headers: list[Column], media: str, block: Column, length: Column | None = None) -> Column:
        head = [
            F.lit("WARC/1.1"),
            F.concat(F.lit("WARC-Type: "), kind),
            F.concat(F.lit("WARC-Record-ID: "), record_id),
            F.lit(f"WARC-Date: {DATE}"),
            F.concat(F.lit("WARC-Target-URI: "), uri),
            *headers,
            F.lit(f"Content-Type: {media}"),
            F.concat(F.lit("Content-Length: "), (F.octet_length(block) if length is None else length).cast("string")),
        ]
        return F.concat(F.concat_ws("\r\n", *head), F.lit(END), block)

    repeats = F.col("repeats").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), response)
    records = F.array(
        record(F.lit("request"), own_id("request"), [concurrent], "application/http;msgtype=request", F.lit(f"GET / HTTP/1.1{END}")),
        record(
            F.lit("metadata"),
            own_id("metadata"),
            [concurrent],
            "application/warc-fields",
            F.concat(F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))), F.when(F.col("url").isNull(), F.lit("\r\nurl: none")).otherwise(F.lit("")), F.lit("\r\n")),
        ),
        record(
            F.when(repeats, "revisit").otherwise("response"),
            response,
            [
                F.concat(F.lit("WARC-Payload-Digest: "), digest),
                F.when(repeats, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _record_id("response", F.col("repeats.page_id"), F.col("sha"), F.col("repeats.url"), F.lit(1)))),
            ],
            "application/http;msgtype=response",
            F.when(repeats, http).otherwise(F.concat(http, F.col("payload"))),
            F.octet_length(http) + F.when(repeats, 0).otherwise(F.col("bytes")),
        ),
    )
    lines = found.select(F.explode(records).alias("value"))
    written = lines.write.option("lineSep", END).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    written.option("maxRecordsPerFile", records_per_file).text(folder)


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if name}


def parse_archive(content: bytes) -> Iterator[dict]:
    """The records of one archive, plain or compressed; a digest that does not meet its payload is an error."""
    stream = gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        head = [line]
        while (line := stream.readline()) not in (b"\r\n", b""):
            head.append(line)
        warc = _headers(b"".join(head))
        block = stream.read(int(warc["content-length"]))
        kind, fields, payload, size = warc["warc-type"], {}, None, None
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            size = int(_headers(http)["content-length"])
            digest = warc["warc-payload-digest"].removeprefix("sha1:")
            if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                raise ValueError(f"payload and digest differ: {warc['warc-record-id']}")
        elif kind == "metadata":
            fields = _headers(b"\r\n" + block)
        yield {
            "record_id": warc["warc-record-id"],
            "type": kind,
            "concurrent_to": warc.get("warc-concurrent-to"),
            "uri": warc.get("warc-target-uri"),
            "date": warc.get("warc-date"),
            "digest": warc.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "refers_to": warc.get("warc-refers-to"),
            "payload_bytes": size,
            "fields": fields,
            "payload": payload,
        }


def read_records(spark: SparkSession, folder: str, with_payload: bool = True, rows_at_once: int = 2_000) -> DataFrame:
    """Every record of the archives below a folder; payloads only where they are asked for."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [column.split()[0] for column in RECORDS.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for row in parse_archive(content):
                    rows.append(row if with_payload else row | {"payload": None})
                    if len(rows) == rows_at_once:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInPandas(parse, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its request, its response or revisit, and its metadata.

    Records meet by the id that ``WARC-Concurrent-To`` names; a capture lacks what was not archived.
    """
    main = records.filter(F.col("type").isin("response", "revisit"))
    beside = records.filter(~F.col("type").isin("response", "revisit"))
    request = F.max(F.when(F.col("type") == "request", F.struct("record_id", "uri", "date")))
    metadata = F.max_by(F.when(F.col("type") == "metadata", F.struct("record_id", "fields")), F.when(F.col("type") == "metadata", F.col("record_id")))
    sides = beside.groupBy(F.col("concurrent_to").alias("__main")).agg(request.alias("request"), metadata.alias("metadata"))
    return main.join(sides, main["record_id"] == sides["__main"], "left").select(
        "record_id",
        F.struct("record_id", "type", "uri", "date", "digest", "payload_bytes", "refers_to", "payload").alias("response"),
        "request",
        "metadata",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived and read back, one row for each row of them."""
    folder = scratch(spark, "warc")
    pages = read(spark, sf_dir, "pages")
    write_archives(captures(pages), folder, records_within(pages))
    records = stored(read_records(spark, folder, with_payload=False), "records")
    page = F.nullif(F.col("metadata.fields")["page-id"], F.lit("none")).cast("bigint")
    rows = assemble(records).select(page.alias("page_id"), F.col("record_id").alias("__record"), *(f"response.{c}" for c in ("type", "digest", "payload_bytes", "refers_to")))
    rows = rows.withColumnsRenamed({"refers_to": "__refers", "digest": "payload_digest", "type": "record_type"})
    originals = rows.filter("record_type = 'response'")
    named = originals.select(F.col("__record").alias("__original"), F.col("page_id").alias("refers_to"))
    repeats = rows.filter("record_type = 'revisit'").join(named, F.col("__refers") == F.col("__original"), "left")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return originals.withColumn("refers_to", F.lit(None).cast("bigint")).select(names).unionByName(repeats.select(names))


def _sql_base32(digest: str) -> str:
    letters = (
        f"substr('{BASE32}', cast(((('0x' || substr({digest}, {1 + 10 * five}, 10))::bigint >> {shift}) & 31) + 1 as integer), 1)"
        for five in range(4)
        for shift in range(35, -1, -5)
    )
    return " || ".join(letters)


OP10_SQL = f"""
with p as (select page_id, coalesce(html, '') as t from pages),
k as (
  select page_id, strlen(t) as payload_bytes, sha1(t) as h, max(page_id) over (partition by t) as keep,
         row_number() over (partition by t order by page_id desc nulls last) as place
  from p)
select page_id, payload_bytes, {_sql_base32('h')} as payload_digest,
       case when place = 1 then 'response' else 'revisit' end as record_type,
       case when place > 1 then keep end as refers_to
from k
"""
