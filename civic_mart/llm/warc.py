"""Legacy archive converter: ARC files in, WARC files out, and a WARC reader.

Version 1 header lines of an ARC file have five fields, version 2 lines ten; a
``filedesc:`` record states which one the lines after it follow.  A record's declared
length says where its block ends, so payloads may hold anything.  The converter
synthesises what WARC asks for beyond that: record identifiers (an URN from the SHA-1 of
the record's own fields, the same on every run), ISO timestamps from the 14-digit ARC
dates, record types and base-32 SHA-1 payload digests.

Files are written by Spark's text writer, one record a row, so that they land on any
file system that Spark knows; a row's bytes go out as they are and the separator is the
record's own trailing line end.  They are read back as whole archives (``binaryFile``)
of a bounded number of records and walked by their declared lengths.
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

from civic_mart.llm.common import table
from civic_mart.sources.sinks import materialize, scratch_path

ARC_FIELDS = {1: ("url", "ip", "date", "mime", "length"),
              2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length")}
ARC_DATE = "20240101000000"  # pages carry no capture time
FILE_RECORDS = 2_000         # records an archive file holds at most
CRLF = "\r\n"


# ---------------------------------------------------------------- ARC

def arc_version_block(version: int) -> str:
    """The ``filedesc:`` record that opens an ARC file."""
    names = {1: "URL IP-address Archive-date Content-type Archive-length",
             2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
    body = f"{version} 0 converter\n{names[version]}\n"
    fields = "text/plain" if version == 1 else "text/plain 200 - - 0 -"
    return f"filedesc://archive.arc 0.0.0.0 {ARC_DATE} {fields} {len(body)}\n{body}\n"


def write_arc(pages: DataFrame, path: str, version: int = 1, file_records: int = FILE_RECORDS) -> None:
    """Write ``pages(page_id, url, html)`` as gzipped ARC files under ``path``.

    White space in an address would break the header line and is percent-encoded; a
    missing address becomes ``about:blank``.  The page id travels as an HTTP header."""
    html = F.coalesce("html", F.lit(""))
    url = F.coalesce(F.regexp_replace("url", r"\s", "%20"), F.lit("about:blank"))
    url = F.when(url == "", F.lit("about:blank")).otherwise(url)
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}X-Page-Id: "),
        F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.lit(f"{CRLF}Content-Length: "),
        F.octet_length(html).cast("string"), F.lit(CRLF * 2))
    extra = F.lit("") if version == 1 else F.lit(" 200 - - 0 -")
    header = F.concat(url, F.lit(f" 0.0.0.0 {ARC_DATE} text/html"), extra, F.lit(" "),
                      (F.octet_length(http) + F.octet_length(html)).cast("string"), F.lit("\n"))
    # the version block opens every file: file_records rows make one
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    opening = F.when(row % file_records == 0, F.lit(arc_version_block(version))).otherwise("")
    pages.select(F.concat(opening, header, http, html).alias("value")).write.option(
        "compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


def read_exactly(f, n: int) -> bytes:
    data = f.read(n)
    if len(data) != n:
        raise ValueError(f"record is cut: {n} bytes declared, {len(data)} there")
    return data


def _open(content: bytes):
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def parse_arc(content: bytes) -> Iterator[dict]:
    """Records (header fields and ``block``) of one ARC file, gzipped or not."""
    f, version = _open(content), 1
    while line := f.readline():
        if not line.strip():
            continue  # the empty line between records
        fields = line.rstrip(b"\r\n").decode("utf-8").split(" ")
        if line.startswith(b"filedesc:"):
            body = read_exactly(f, int(fields[-1]))
            version = int(body.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            continue
        names = ARC_FIELDS[version]
        if len(fields) != len(names):
            raise ValueError(f"version {version} header line has {len(names)} fields: {line[:200]!r}")
        record = dict(zip(names, fields))
        yield record | {"block": read_exactly(f, int(record["length"]))}


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(header block with its empty line, header fields, payload) of an HTTP response."""
    head, sep, payload = block.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8").split(CRLF)[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return head + sep, fields, payload


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def archives(spark: SparkSession, path: str, glob: str = "part-*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("content")


_ARC_ROW = "page_id long, url string, ip string, date string, head binary, payload binary, digest string, record_id string"


def arc_records(files: DataFrame) -> DataFrame:
    """Converted fields of every record of the ARC files in ``content``."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                out = []
                for r in parse_arc(bytes(content)):
                    head, http, payload = http_parts(r["block"])
                    page = http.get("x-page-id", "-")
                    digest, d = base32_sha1(payload), r["date"]
                    name = hashlib.sha1(" ".join((r["url"], d, page, digest)).encode()).hexdigest()
                    out.append((None if page == "-" else int(page), r["url"], r["ip"],
                                f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z", head, payload, digest,
                                f"<urn:uuid:{name[:8]}-{name[8:12]}-5{name[13:16]}-a{name[17:20]}-{name[20:32]}>"))
                    if len(out) >= 200:
                        yield _frame(out)
                        out = []
                if out:
                    yield _frame(out)

    return files.mapInPandas(rows, _ARC_ROW)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["page_id", "url", "ip", "date", "head", "payload", "digest", "record_id"]
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})


# ---------------------------------------------------------------- WARC

def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """WARC record without its last two line ends, which the text writer adds."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{name}: "), v, F.lit(CRLF))).otherwise("") for name, v in headers]
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), *lines, F.lit("Content-Length: "),
                    F.octet_length(block).cast("string"), F.lit(CRLF * 2), block)


def convert(files: DataFrame, path: str, min_bytes: int = 0, file_records: int = FILE_RECORDS) -> None:
    """Convert the ARC files in ``content`` to gzipped WARC files under ``path``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the
    smallest page id is a response; the others become revisits of it without a payload."""
    records = arc_records(files)
    size = F.octet_length("payload")
    # payloads stay out of this pass: only digests are grouped, from partial sums
    first = _first_records(records, size, min_bytes)
    joined = records.join(first, "digest", "left")
    revisit = F.col("first_id").isNotNull() & (size >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    block = F.when(revisit, F.col("head").cast("string")).otherwise(
        F.concat(F.col("head").cast("string"), F.col("payload").cast("string")))
    only = lambda c: F.when(revisit, c)
    value = _record([
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise("response")),
        ("WARC-Record-ID", F.col("record_id")), ("WARC-Date", F.col("date")), ("WARC-Target-URI", F.col("url")),
        ("WARC-IP-Address", F.col("ip")), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", only(F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("WARC-Refers-To", only(F.col("first_id"))), ("WARC-Refers-To-Target-URI", only(F.col("first_url"))),
        ("X-Refers-To-Page", only(F.col("first_page").cast("string"))),
        ("Content-Type", F.lit("application/http; msgtype=response"))], block)
    joined.select(value.alias("value")).write.option("compression", "gzip").option(
        "lineSep", CRLF * 2).option("maxRecordsPerFile", file_records).text(path)


def _first_records(records: DataFrame, size: Column, min_bytes: int) -> DataFrame:
    """Per digest held by more than one record: the record with the smallest page id."""
    return materialize(
        records.where(size >= min_bytes).groupBy("digest").agg(
            F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "record_id", "url"))).alias("low"),
            F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("low").isNotNull())
        .select("digest", F.col("low.page_id").alias("first_page"), F.col("low.record_id").alias("first_id"),
                F.col("low.url").alias("first_url")), "warc-first")


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record of one WARC file."""
    f = _open(content)
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin: {line[:80]!r}")
        fields: dict[str, str] = {}
        while (line := f.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, read_exactly(f, int(fields["content-length"]))


def warc_records(files: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url)``
    of the WARC files in ``content``.  A response's digest is computed from its payload
    and must match the declared one; a revisit has its length and digest in headers."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url"]
        for pdf in batches:
            for content in pdf["content"]:
                out = []
                for w, block in parse_warc(bytes(content)):
                    _, http, payload = http_parts(block)
                    page, declared = http.get("x-page-id", "-"), w["warc-payload-digest"].removeprefix("sha1:")
                    if w["warc-type"] == "response":
                        if base32_sha1(payload) != declared:
                            raise ValueError(f"payload of {w['warc-record-id']} does not match its digest")
                        size, refers = len(payload), None
                    else:
                        size, refers = int(http["content-length"]), int(w["x-refers-to-page"])
                    out.append((None if page == "-" else int(page), size, declared, w["warc-type"], refers,
                                w["warc-record-id"], w["warc-target-uri"]))
                yield pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    return files.mapInPandas(rows, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                   "refers_to long, record_id string, url string")


def arc_to_warc(pages: DataFrame, arc_path: str, warc_path: str, version: int = 1, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as ARC files, convert them to WARC files and read those back.

    Null html is an empty payload.  Rows that repeat a page id each have a record; those
    that repeat the smallest one of their payload are all responses.  A null page id is
    never the smallest; payloads that only such rows hold are all responses.  An empty
    table gives archives without records; other columns are ignored."""
    spark = pages.sparkSession
    write_arc(pages.select("page_id", "url", "html"), arc_path, version)
    convert(archives(spark, arc_path), warc_path, min_bytes)
    return warc_records(archives(spark, warc_path))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_to_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "arc"), scratch_path(spark, "warc")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT page_id, body, hex,
         list_transform(range(40), lambda i: strpos('0123456789abcdef', substr(hex, CAST(i AS INT) + 1, 1)) - 1) AS nib
  FROM p),
low AS (SELECT hex, min(page_id) AS first_page, count(*) AS n FROM p GROUP BY hex)
SELECT b.page_id, CAST(octet_length(encode(b.body)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
    list_sum(list_transform(range(5), lambda j:
      ((nib[CAST((5 * k + j) // 4 + 1 AS INT)] >> CAST(3 - (5 * k + j) % 4 AS INT)) & 1) * (16 >> CAST(j AS INT)))) AS INT), 1)), '')
    AS payload_digest,
  CASE WHEN b.page_id = low.first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN b.page_id = low.first_page THEN NULL ELSE low.first_page END AS refers_to
FROM bits b JOIN low USING (hex)
"""
