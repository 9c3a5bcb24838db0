import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from casegauge.llm import warc
from casegauge.llm.common import table
from casegauge.session import scratch_path
from tests.conftest import SF_SMALL

SCHEMA = "page_id bigint, url string, html string, date string, ip string, sha1 string, r string"
LONG = "<p>ünïcode</p>\r\n" * 200
TRICKY = "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 50 + "http://a 0.0.0.0 1 text/html 99\nHTTP/1.1\r\n\r\n"


def rows():
    return [(1, "http://a/ b", LONG), (2, None, LONG), (9, "http://c", LONG), (3, "", "short"),
            (4, "http://d", "short"), (5, "http://e", None), (6, "http://f", ""), (7, "x", TRICKY),
            (7, "x", TRICKY), (8, "y", "z" * 400_000), (10, "u", "\n\n lines \r\n")]


def frame(spark, data):
    return spark.createDataFrame([(*r, "d", "i", "s", "r") for r in data], SCHEMA)


def brute(data):
    last = {}
    for i, _, h in data:
        last[h or ""] = max(i, last.get(h or "", i))
    out = []
    for i, _, h in data:
        raw = (h or "").encode()
        again = len(raw) >= 1000 and last[h] != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(),
                    "revisit" if again else "response", last[h] if again else None))
    return sorted(out, key=str)


def result(df, **kw):
    return sorted([tuple(r[:5]) for r in warc.archive_pages(df, **kw).collect()], key=str)


@pytest.mark.parametrize("version", [1, 2])
def test_pages_come_back(spark, version):
    assert result(frame(spark, rows()), version=version) == brute(rows())


def test_table_and_empty_table(spark):
    pages = table(spark, SF_SMALL, "pages")
    assert result(pages) == brute([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert result(frame(spark, [])) == []


def test_archives_on_disk(spark):
    """Both kinds of file, with and without compression, read as their declared lengths say."""
    for compression in ("none", "gzip"):
        arc, out = scratch_path(spark, "arc"), scratch_path(spark, "warc")
        warc.write_arc(frame(spark, rows()).coalesce(1), arc, F.col("url"),
                       F.lit("2001-02-03 04:05:06").cast("timestamp"), F.col("html"),
                       1, compression)
        raw = bytes(spark.read.format("binaryFile").load(arc).first()["content"])
        found = list(warc.arc_records(raw))
        assert [warc.split_http(b)[1] for _, b in found] == [(r[2] or "").encode() for r in rows()]
        assert found[0][0]["URL"] == "http://a/%20b" and found[1][0]["URL"] == "about:blank"
        warc.convert(spark, arc, out, F.col("url"), compression)
        records = [x for f in spark.read.format("binaryFile").load(out).collect()
                   for x in warc.warc_records(bytes(f["content"]))]
        assert len(records) == len(rows())
        for fields, block in records:
            assert fields["warc-date"] == "2001-02-03T04:05:06Z"
            assert len(block) == int(fields["content-length"])
            if fields["warc-type"] == "response":
                digest = hashlib.sha1(warc.split_http(block)[1]).hexdigest()
                row = spark.range(1).select(warc.base32(F.lit(digest)).alias("b")).first()
                assert fields["warc-payload-digest"] == "sha1:" + row["b"]


def test_legacy_lines():
    block = warc.version_block(1).encode()
    body = b"plain body"
    record = b"http://x y 1.2.3.4 19990101000000 text/plain %d\n%s\n" % (len(body), body)
    got = list(warc.arc_records(gzip.compress(block) + gzip.compress(record)))
    assert got == [({"URL": "http://x y", "IP-address": "1.2.3.4", "Archive-date": "19990101000000",
                     "Content-type": "text/plain", "Archive-length": "10"}, body)]
    for bad in (block + record[:-8], block + b"a b c d x\n", record, block + b"no newline"):
        with pytest.raises(ValueError):
            list(warc.arc_records(bad, "file"))
