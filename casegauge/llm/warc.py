"""Legacy archives: ARC files written, parsed by declared lengths, converted to WARC, read back.

* ``write_arc``: pages as ARC files (version 1 or 2). Every file begins with its version
  block; a record is a header line of the version's fields, whose last one declares the
  length, and that many bytes.
* ``parse_arc``: reads such files; the version block of a file says which fields its header
  lines have. Bodies are taken by declared length, so their bytes may hold anything.
* ``convert``: ARC records to WARC records: identifier (a UUID from address, date and
  digest), timestamp, type, payload digest. Of records with equal payloads of at least
  ``REVISIT_LEAST`` bytes one is a response and the others revisit it.
* ``write_warc`` / ``parse_warc``: the WARC files, and what stands in them.

Files are written by Spark's text writer (bytes as they are) and read as binary files, one
file per task at a time; the writer splits its input by the scan's partitions, so a file
holds about one scan partition's texts. Payloads are never shuffled by content: only
digests are grouped, and the classes of copies are joined back by broadcast if their
measured size allows.

Defined results: a null page is an empty payload; a null address is written as
``about:blank``; blanks in addresses are percent-encoded; a null date is 1970-01-01;
repeated rows give records of their own (equal identifiers); an empty table gives no
records; a record that is cut off by the end of its file, or whose declared length is no
number, raises an error that names the file.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegauge.llm.common import Scratch
from casegauge.operators.joins import broadcast_if_small
from casegauge.session import scratch_path

REVISIT_LEAST = 1000
# The header-line fields of ARC versions 1 and 2.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum",
        "Location", "Offset", "Filename", "Archive-length"),
}
WARC_VERSION = "WARC/1.1"
CRLF = "\r\n"


# ----------------------------------------------------------------------------
# Writing ARC (JVM-side)
# ----------------------------------------------------------------------------

def _header_value(c: Column, empty: str) -> Column:
    """A value as a header-line field: no blanks, never empty."""
    clean = F.regexp_replace(c, r"[\x00-\x20\x7F]", "%20")
    return F.when(c.isNull() | (c == ""), F.lit(empty)).otherwise(clean)


def arc_text(url: Column, date: Column, body: Column, version: int = 1,
             content_type: str = "text/html", ip: str = "0.0.0.0") -> Column:
    """One ARC record: header line and an HTTP response with ``body``; the writer's line
    separator ends it."""
    size = F.octet_length(body).cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: {content_type}; charset=utf-8"
                          f"{CRLF}Content-Length: "), size, F.lit(CRLF + CRLF), body)
    start = [_header_value(url, "about:blank"), F.lit(ip),
             F.date_format(F.coalesce(date, F.lit("1970-01-01").cast("timestamp")),
                           "yyyyMMddHHmmss"), F.lit(content_type)]
    if version == 2:
        start += [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc")]
    line = F.concat_ws(" ", *start, F.octet_length(http).cast("string"))
    return F.concat(line, F.lit("\n"), http)


def version_block(version: int) -> str:
    """The record that begins a file: its body names the version and the fields."""
    body = f"{version} 0 casegauge\n{' '.join(ARC_FIELDS[version])}\n"
    fields = ["filedesc://pages.arc", "0.0.0.0", "19700101000000", "text/plain"]
    if version == 2:
        fields += ["200", "-", "-", "0", "pages.arc"]
    return f"{' '.join(fields)} {len(body)}\n{body}\n"


def write_arc(df: DataFrame, path: str, url: Column, date: Column, body: Column,
              version: int = 1, compression: str = "gzip") -> None:
    """Write the rows of ``df`` as ARC files, one per partition of ``df``. The first row of
    a partition carries the file's version block."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    record = arc_text(url, date, F.coalesce(body, F.lit("")), version)
    text = F.when(first, F.concat(F.lit(version_block(version)), F.col("r"))) \
        .otherwise(F.col("r"))
    df.select(record.alias("r")).select(text.alias("value")).write.option("maxRecordsPerFile", 0) \
        .option("lineSep", "\n").option("compression", compression).text(path)


# ----------------------------------------------------------------------------
# Reading
# ----------------------------------------------------------------------------

def _inflate(raw: bytes) -> bytes:
    """All gzip members of a file, or the file as it is."""
    if raw[:2] != b"\x1f\x8b":
        return raw
    out = []
    while raw:
        d = zlib.decompressobj(31)
        out.append(d.decompress(raw))
        raw = d.unused_data
    return b"".join(out)


def _line(data: bytes, at: int, name: str) -> tuple[bytes, int]:
    end = data.find(b"\n", at)
    if end < 0:
        raise ValueError(f"{name}: header cut off at byte {at}")
    return data[at:end].rstrip(b"\r"), end + 1


def _declared(value: bytes, at: int, data: bytes, name: str) -> int:
    if not value.isdigit() or at + int(value) > len(data):
        raise ValueError(f"{name}: bad declared length {value!r} at byte {at}")
    return int(value)


def arc_records(raw: bytes, name: str = "") -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (by name) and body of every record after the version block."""
    data = _inflate(raw)
    at, fields = 0, None
    while at < len(data):
        if data[at:at + 1] in b"\r\n":  # separators between records
            at += 1
            continue
        line, at = _line(data, at, name)
        values = line.split(b" ")
        n = _declared(values[-1], at, data, name)
        body = data[at:at + n]
        at += n
        if fields is None:
            if not line.startswith(b"filedesc:"):
                raise ValueError(f"{name}: no version block")
            version = int(body.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"{name}: ARC version {version}")
            fields = ARC_FIELDS[version]
            continue
        # a blank inside the address shifts the fields: count from the end
        extra = len(values) - len(fields)
        if extra < 0:
            raise ValueError(f"{name}: {len(values)} header fields, expected {len(fields)}")
        values = [b" ".join(values[:extra + 1]), *values[extra + 1:]]
        yield {f: v.decode("utf-8", "replace") for f, v in zip(fields, values)}, body


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and payload; a block that is no HTTP response has
    no head."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


ARC_COLUMNS = ("url string, ip string, date string, content_type string, "
               "payload_bytes bigint, sha1 string")
_ARC = pa.schema([("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
                  ("content_type", pa.string()), ("payload_bytes", pa.int64()),
                  ("sha1", pa.string())])
_BATCH = 4 << 20


def _slices(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``_BATCH`` bytes."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row) + 64
        if total >= _BATCH:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("path")[i].as_py(), batch.column("content")[i].as_py()


def parse_arc(spark: SparkSession, path: str, with_block: bool = False) -> DataFrame:
    """One row per ARC record: address, IP, date, type, payload size and SHA-1 (hex); with
    ``with_block`` also the record's bytes."""
    schema = _ARC.append(pa.field("block", pa.binary())) if with_block else _ARC

    def rows(batches):
        for name, raw in _files(batches):
            for h, block in arc_records(raw, name):
                _, payload = split_http(block)
                row = (h["URL"], h["IP-address"], h["Archive-date"], h["Content-type"],
                       len(payload), hashlib.sha1(payload).hexdigest())
                yield (*row, block) if with_block else row
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(
        lambda b: _slices(rows(b), schema, lambda r: len(r[-1])),
        ARC_COLUMNS + (", block binary" if with_block else ""))


# ----------------------------------------------------------------------------
# Conversion (JVM-side)
# ----------------------------------------------------------------------------

def record_id() -> Column:
    """A UUID (version 5 layout) from address, date and payload digest."""
    h = F.sha1(F.concat_ws(" ", "url", "date", "sha1"))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1,
                          F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"),
                    F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"),
                    F.substring(h, 21, 12))


def timestamp(date: Column) -> Column:
    """ARC's 14 digits as WARC's timestamp."""
    return F.regexp_replace(F.rpad(date, 14, "0"), r"^(....)(..)(..)(..)(..)(..)$",
                            "$1-$2-$3T$4:$5:$6Z")


def responses(index: DataFrame, order: Column, least: int = REVISIT_LEAST) -> DataFrame:
    """Classes of equal payloads with more than one record: digest, and of the record with
    the largest ``order`` (the response) its order, identifier, address and date."""
    return index.where(F.col("payload_bytes") >= least) \
        .withColumn("pick", F.struct(order.alias("at"), record_id().alias("id"),
                                     F.col("url"), F.col("date"))) \
        .groupBy("sha1", "payload_bytes").agg(F.max("pick").alias("r"),
                                              F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select("sha1", "payload_bytes", "r")


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def warc_text(revisit: Column) -> Column:
    """One WARC record (without its last line end, which the writer adds)."""
    address = F.col("url")
    http = F.col("block").cast("string")
    is_http = F.substring(http, 1, 5) == "HTTP/"
    shared = F.concat(
        _field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), record_id(), F.lit(">"))),
        _field("WARC-Target-URI", address), _field("WARC-IP-Address", F.col("ip")),
        _field("WARC-Date", timestamp(F.col("date"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("base32"))))
    response = F.concat(
        F.lit(WARC_VERSION + CRLF + "WARC-Type: response" + CRLF), shared,
        _field("Content-Type", F.when(is_http, F.lit("application/http;msgtype=response"))
               .otherwise(F.col("content_type"))),
        _field("Content-Length", F.octet_length("block").cast("string")), F.lit(CRLF), http,
        F.lit(CRLF))
    again = F.concat(
        F.lit(WARC_VERSION + CRLF + "WARC-Type: revisit" + CRLF), shared,
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
              + CRLF),
        _field("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), F.col("r.id"), F.lit(">"))),
        _field("WARC-Refers-To-Target-URI", F.col("r.url")),
        _field("WARC-Refers-To-Date", timestamp(F.col("r.date"))),
        F.lit("Content-Length: 0" + CRLF + CRLF + CRLF))
    return F.when(revisit, again).otherwise(response)


def base32(sha1: Column) -> Column:
    """Base32 of a hex SHA-1: its 160 bits in groups of five."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(sha1, 1 + 10 * i, 10), 16, 2), 40, "0")
                      for i in range(4)])
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(*[F.substring(letters, F.conv(F.substring(bits, 1 + 5 * i, 5), 2, 10)
                                  .cast("int") + 1, F.lit(1)) for i in range(32)])


def convert(spark: SparkSession, arc_path: str, warc_path: str, order: Column,
            compression: str = "gzip", scratch: Scratch | None = None) -> None:
    """ARC files to WARC files. ``order`` ranks records of equal payloads (over the columns
    of ``parse_arc``); the largest becomes the response. A first pass reads digests only."""
    scratch = scratch or Scratch(spark)
    classes = scratch.stage(responses(parse_arc(spark, arc_path), order), "warc-classes")
    small, _ = broadcast_if_small(classes)
    records = parse_arc(spark, arc_path, with_block=True).join(
        small, ["sha1", "payload_bytes"], "left")
    revisit = F.coalesce(F.col("r.at") != order, F.lit(False))
    records = records.withColumn("base32", base32(F.col("sha1")))
    records.select(warc_text(revisit).alias("value")).write.option("lineSep", CRLF) \
        .option("compression", compression).text(warc_path)
    scratch.drop(classes)


def warc_records(raw: bytes, name: str = "") -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields (lower case) and block of every WARC record."""
    data = _inflate(raw)
    at = 0
    while at < len(data):
        if data[at:at + 1] in b"\r\n":
            at += 1
            continue
        line, at = _line(data, at, name)
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no WARC record at byte {at}")
        fields: dict[str, str] = {}
        while True:
            line, at = _line(data, at, name)
            if not line:
                break
            key, _, value = line.partition(b":")
            fields[key.decode().strip().lower()] = value.decode("utf-8", "replace").strip()
        n = _declared(fields.get("content-length", "").encode(), at, data, name)
        yield fields, data[at:at + n]
        at += n


_WARC = pa.schema([("id", pa.string()), ("url", pa.string()), ("date", pa.string()),
                   ("record_type", pa.string()), ("refers_to_id", pa.string()),
                   ("declared_sha1", pa.string()), ("sha1", pa.string()),
                   ("payload_bytes", pa.int64())])
WARC_COLUMNS = ("id string, url string, date string, record_type string, refers_to_id string, "
                "declared_sha1 string, sha1 string, payload_bytes bigint")


def _uuid(value: str | None) -> str | None:
    return value.removeprefix("<urn:uuid:").removesuffix(">") if value else None


def parse_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record. ``sha1`` and ``payload_bytes`` are measured on the block's
    payload and null for revisits, which have none; ``declared_sha1`` is the header's."""
    def rows(batches):
        for name, raw in _files(batches):
            for f, block in warc_records(raw, name):
                digest = f.get("warc-payload-digest", "")
                declared = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest else None
                kind = f["warc-type"]
                payload = None if kind == "revisit" else split_http(block)[1]
                yield (_uuid(f["warc-record-id"]), f.get("warc-target-uri"), f["warc-date"], kind,
                       _uuid(f.get("warc-refers-to")), declared,
                       None if payload is None else hashlib.sha1(payload).hexdigest(),
                       None if payload is None else len(payload))
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(lambda b: _slices(rows(b), _WARC, lambda r: 200), WARC_COLUMNS)


# ----------------------------------------------------------------------------
# Pages
# ----------------------------------------------------------------------------

# a page's id rides in its address's fragment
_PAGE = "#page-id="


def page_number(url: Column) -> Column:
    return F.regexp_extract(url, r"#page-id=(-?[0-9]+)$", 1).try_cast("bigint")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", version: int = 2) -> DataFrame:
    """Pages written as ARC files, converted to WARC and read back: page_id, payload_bytes,
    payload_digest, record_type and refers_to (the response's page_id). Sizes and digests
    of revisits are those of the response they refer to, found by its identifier."""
    spark = pages.sparkSession
    scratch = Scratch(spark)
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    url = F.concat(F.coalesce(F.col(f"`{url_col}`"), F.lit("about:blank")), F.lit(_PAGE),
                   F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    write_arc(pages, arc, url, F.lit(None).cast("timestamp"), F.col(f"`{html_col}`"), version)
    convert(spark, arc, warc, page_number(F.col("url")), scratch=scratch)
    read = scratch.stage(parse_warc(spark, warc), "warc-records")
    scratch.free(arc, warc)
    read = read.withColumn("page_id", page_number(F.col("url")))
    own = read.where("refers_to_id is null").select(
        "page_id", "payload_bytes", F.col("sha1").alias("payload_digest"), "record_type",
        F.lit(None).cast("bigint").alias("refers_to"))
    again = read.where("refers_to_id is not null")
    wanted = again.select(F.col("refers_to_id").alias("id")).distinct()
    targets = scratch.stage(read.where("refers_to_id is null").join(
        wanted, "id", "left_semi").select(
        F.col("id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("bytes"), F.col("sha1").alias("digest"))
        .dropDuplicates(["refers_to_id"]), "warc-targets")
    small, _ = broadcast_if_small(targets)
    revisits = again.join(small, "refers_to_id", "left").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", "refers_to")
    return own.unionByName(revisits)
