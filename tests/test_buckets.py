"""Tables filed by key bucket: merges, point reads, compaction, a swap cut short."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from casegauge import api
from casegauge.operators import store
from casegauge.sources.buckets import COMPACT_AFTER, BucketTable

SCHEMA = "case_id string, seen string, title string"


def newest(rows):
    return rows.groupBy("case_id").agg(F.max(F.struct("seen", "title")).alias("v")) \
        .select("case_id", "v.seen", "v.title")


@pytest.fixture
def table(spark, tmp_path):
    def make():
        schema = spark.createDataFrame([], SCHEMA).schema
        return BucketTable(spark, str(tmp_path / "t"), "case_id", schema, newest, n=8)
    return make


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def contents(df):
    return {r["case_id"]: (r["seen"], r["title"]) for r in df.collect()}


def test_random_histories_equal_a_dictionary(spark, table):
    rng = random.Random(1)
    expected = {}
    t = table()
    for step in range(COMPACT_AFTER + 4):
        rows = {f"C{rng.randrange(40)}": (f"{step:03d}", rng.choice(["a", "b", None]))
                for _ in range(rng.randrange(0, 9))}
        expected.update(rows)
        t.append(frame(spark, [(k, *v) for k, v in rows.items()]), f"p{step}")
        if step == 5:
            t.compact()
    assert len(t.deltas()) < COMPACT_AFTER
    assert contents(t.read()) == expected
    assert all(contents(t.at(k)) == {k: expected[k]} for k in list(expected)[:3])
    assert contents(t.at("none")) == {}
    assert contents(table().read()) == expected


def test_only_touched_buckets_are_written(spark, table):
    t = table()
    t.upsert(frame(spark, [(f"C{i}", "001", "x") for i in range(100)]), "p0")
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{t.path}/base/bucket=*/*.parquet")}
    t.upsert(frame(spark, [("C7", "002", "y")]), "p1")
    after = set(glob.glob(f"{t.path}/base/bucket=*/*.parquet"))
    changed = {os.path.dirname(p) for p in after ^ set(before)}
    bucket = frame(spark, [("C7", "", "")]).select(t.bucket_of(F.col("case_id"))).first()[0]
    assert changed == {f"{t.path}/base/bucket={bucket}"}
    assert contents(t.read())["C7"] == ("002", "y") and len(contents(t.read())) == 100


def test_a_key_is_read_from_its_bucket_alone(spark, table):
    t = table()
    t.append(frame(spark, [(f"C{i}", "001", "x") for i in range(100)]), "p0")
    t.compact()
    t.append(frame(spark, [(f"C{i}", "002", "y") for i in range(0, 100, 2)]), "p1")
    read = t.at("C8").inputFiles()
    folders = {os.path.basename(os.path.dirname(f)) for f in t.rows().where(
        F.col("bucket") == t.bucket_of(F.lit("C8"))).select("bucket").inputFiles()}
    assert len(folders) >= 1 and contents(t.at("C8")) == {"C8": ("002", "y")}
    plan = t.at("C8")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert read


def test_a_table_keeps_its_number_of_buckets(spark, table):
    t = table()
    t.append(frame(spark, [(f"C{i}", "001", "x") for i in range(50)]), "p0")
    other = BucketTable(spark, t.path, "case_id", t.schema, newest, n=64)
    assert other.n == 8 and contents(other.at("C7")) == {"C7": ("001", "x")}


def test_a_delta_given_twice_counts_once(spark, table):
    t = table()
    for _ in range(2):
        t.append(frame(spark, [("C1", "001", "x")]), "p0")
    assert t.rows().count() == 1


@pytest.mark.parametrize("moved", [0, 1, 99])
def test_a_swap_cut_short_is_finished(spark, table, monkeypatch, moved):
    """The process dies before the first bucket is moved, in the middle, and before the deltas
    are dropped: the next open finishes, and nothing is lost or doubled."""
    t = table()
    t.upsert(frame(spark, [(f"C{i}", "001", "x") for i in range(30)]), "p0")
    t.append(frame(spark, [(f"C{i}", "002", "y") for i in range(20, 40)]), "p1")
    monkeypatch.setattr(BucketTable, "_settle", lambda self: None)
    t.compact()
    staged = sorted(glob.glob(f"{t.path}/staged/bucket=*"))
    import shutil
    for folder in staged[:moved]:
        old = f"{t.path}/base/{os.path.basename(folder)}"
        if os.path.exists(old):
            shutil.rmtree(old)
        os.rename(folder, old)
    monkeypatch.undo()
    again = table()
    assert not os.path.exists(f"{t.path}/staged") and again.deltas() == []
    assert contents(again.read()) == {f"C{i}": ("002", "y") if i >= 20 else ("001", "x")
                                      for i in range(40)}


def test_latest_scores_merge_in_steps(spark, tmp_path):
    """Ties are kept, rows merged twice aren't doubled, equal rows of one part stay apart."""
    schema = spark.createDataFrame([], "case_id string, validated_at string, row_key string").schema
    t = BucketTable(spark, str(tmp_path / "t"), "case_id", schema, api._merge_latest, n=4)
    rng = random.Random(2)
    rows = []
    for part in range(5):
        some = [(f"C{rng.randrange(6)}", f"2024-01-0{rng.randrange(1, 4)}") for _ in range(12)]
        t.append(spark.createDataFrame(some, "case_id string, validated_at string"), f"p{part}",
                 unique=True)
        rows += some
        if part % 2:
            t.compact()
    last = {c: max(v for k, v in rows if k == c) for c, _ in rows}
    expected = sorted((c, v) for c, v in rows if v == last[c])
    assert sorted((r.case_id, r.validated_at) for r in t.read().collect()) == expected
    whole = spark.createDataFrame(rows, "case_id string, validated_at string")
    assert store.latest_per_key(whole).count() == len(expected)
