"""Small scalar functions and helpers, each against its stated rule."""

import datetime as dt

from pyspark.sql import functions as F

from casegauge.functions import text
from casegauge.operators import report, store
from casegauge.session import scratch_path, shuffle_partitions_for
from casegauge.sources import files


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_text_helpers(spark):
    assert one(spark, text.case_label(F.col("i")), [(1,), (None,)], "i long") == ["C1", None]
    assert one(spark, text.or_default(F.col("s"), "(empty)"), [("x",), ("",), (None,)],
               "s string") == ["x", "(empty)", "(empty)"]
    assert one(spark, text.prompt_lines(F.col("a"), F.lit("b"), F.col("c")),
               [("a", None), (None, "c")], "a string, c string") == ["a\nb", "b\nc"]
    stamps = one(spark, text.file_timestamp(F.col("n")),
                 [("report_20240105_101010.csv",), ("report.csv",), ("x_20241399_999999",)],
                 "n string")
    assert stamps == [dt.datetime(2024, 1, 5, 10, 10, 10), None, None]


def test_date_extent_falls_back_to_the_last_year(spark):
    empty = spark.createDataFrame([(None,), ("not a date",)], "validated_at string")
    r = report.date_extent(empty, today=dt.date(2024, 3, 1)).first()
    assert (r["min_date"], r["max_date"]) == (dt.date(2023, 3, 2), dt.date(2024, 3, 1))
    some = spark.createDataFrame([("2024-01-05T23:30:00-05:00",), ("2024-01-02T00:00:00+00:00",)],
                                 "validated_at string")
    r = report.date_extent(some).first()          # offsets are converted to UTC first
    assert (r["min_date"], r["max_date"]) == (dt.date(2024, 1, 2), dt.date(2024, 1, 6))


def test_badges(spark):
    got = one(spark, report.verdict_badge(F.col("v")),
              [("Passed",), ("Failed",), ("passed",), (None,)], "v string")
    assert got == ["✅ Passed", "❌ Failed", "⚠️ Error", "⚠️ Error"]
    assert one(spark, report.flag_badge(F.col("b")), [(True,), (False,), (None,)],
               "b boolean") == ["✅ Pass", "❌ Fail", "⚠️ Error"]
    assert one(spark, report.blank_as_dash(F.col("s")), [("x",), ("",), (" ",), (None,)],
               "s string") == ["x", "—", " ", "—"]


def test_completed_ids_and_standards_text(spark):
    facts = spark.createDataFrame([("C1", "r1"), ("C1", "r1"), ("C2", "r2")],
                                  "case_id string, run_id string")
    assert [r[0] for r in store.completed_ids(facts, "r1").collect()] == ["C1"]
    path = scratch_path(spark, "standards") + "/standards.md"
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("# Standards\n\n- one\n- two\n")
    rows = files.read_standards(spark, path).collect()
    assert len(rows) == 1 and rows[0]["standards"] == "# Standards\n\n- one\n- two\n"


def test_shuffle_partition_sizing():
    assert shuffle_partitions_for(0, 100) == 300                       # at least 3 waves
    assert shuffle_partitions_for(1000 * 200 * 1024 * 1024, 100) == 1000
    assert shuffle_partitions_for(100 * 2 ** 40, 8000) == 524_288      # 200 MB each, no cap


def test_id_helpers_match_python_regex_on_random_text(spark):
    """F1 F2: the id in a link and the digits of an id follow Python's Unicode ``\\d``."""
    import random
    import re

    rng = random.Random(9)
    alphabet = list("ab/C-_ 0123456789") + ["٣", "४", "５", "view", "/view/"]
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in samples], "s string")
    got = df.select("s", text.extract_id(F.col("s")).alias("id"),
                    text.digits_only(F.col("s")).alias("d")).collect()
    for r in got:
        m = re.search(r"/view/(\d+)", r["s"])
        assert r["id"] == (m.group(1) if m else None), r["s"]
        assert r["d"] == re.sub(r"[^\d]", "", r["s"]), r["s"]


def test_broadcast_needs_both_row_and_byte_bounds(spark):
    """A side is broadcast only under both bounds; wide text rows fail the byte bound."""
    from casegauge.operators import joins

    narrow = spark.createDataFrame([(i, "x") for i in range(100)], "k long, s string")
    wide = spark.createDataFrame([(i, "x" * 10_000) for i in range(100)], "k long, s string")
    assert joins.broadcast_if_small(narrow, max_rows=1000, max_bytes=100_000)[1] is True
    assert joins.broadcast_if_small(wide, max_rows=1000, max_bytes=100_000)[1] is False
    assert joins.broadcast_if_small(narrow, max_rows=10, max_bytes=100_000)[1] is False
    est = wide.agg(joins.estimated_bytes(wide)).first()[0]
    assert 1_000_000 <= est <= 1_001_000
