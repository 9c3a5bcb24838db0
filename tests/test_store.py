"""Store operators: latest view with ties, upsert idempotence, counters, resume."""

import datetime as dt

from pyspark.sql import functions as F

from casegauge.operators import store
from casegauge.plans import fixtures as fx
from tests.conftest import SF

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def test_latest_keeps_ties_and_dedup_breaks_them(spark):
    rows = [(1, 10, T0, "Passed"), (2, 10, T0, "Failed"), (3, 10, T0 - dt.timedelta(1), "Failed"),
            (4, 11, T0, None)]
    f = spark.createDataFrame(rows, "score_id long, case_id long, validated_at timestamp, verdict string")
    assert store.latest_per_key(f).where("case_id = 10").count() == 2
    one = store.latest_per_key(f, dedup=True, tie_break=["score_id"]).where("case_id = 10").collect()
    assert [r["score_id"] for r in one] == [2]


def test_latest_plan_limits_before_shuffle(spark):
    f = fx.scores(fx.tables(spark, SF))
    plan = store.latest_per_key(f)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_records_with_latest_marks_never_scored(spark):
    t = fx.tables(spark, SF)
    v = store.records_with_latest(fx.cases(t), fx.scores(t), fx.runs(t))
    assert v.count() == 1500
    assert v.where("never_scored").count() == 1350
    assert v.where("verdict IS NOT NULL").count() == 120


def test_upsert_is_idempotent_and_keeps_first_seen(spark):
    old = spark.createDataFrame([(1, "a", "t0", "t0"), (2, "b", "t0", "t0")],
                                "case_id long, title string, first_seen_at string, last_updated_at string")
    new = spark.createDataFrame([(2, None, "t1", "t1"), (3, "c", "t1", "t1")], old.schema)
    once = store.upsert(old, new, "case_id", keep_first=["first_seen_at"])
    twice = store.upsert(once, new, "case_id", keep_first=["first_seen_at"])
    a = sorted(tuple(r) for r in once.collect())
    assert a == [(1, "a", "t0", "t0"), (2, None, "t0", "t1"), (3, "c", "t1", "t1")]
    assert sorted(tuple(r) for r in twice.collect()) == a


def test_run_counters_sum_to_run_rows(spark):
    t = fx.tables(spark, SF)
    c = store.run_counters(fx.runs(t), fx.scores(t))
    bad = c.where(F.col("passed_count") + F.col("needs_improvement_count") + F.col("failed_count")
                  + F.col("error_count") != F.col("total_cases"))
    assert c.count() == 30 and bad.count() == 0


def test_writes_by_key(spark):
    old = spark.createDataFrame([("r1", "a"), ("r2", "b")], "run_id string, model string")
    new = spark.createDataFrame([("r2", "B"), ("r3", "C")], old.schema)
    assert sorted(tuple(r) for r in store.insert_if_absent(old, new, "run_id").collect()) == \
        [("r1", "a"), ("r2", "b"), ("r3", "C")]
    assert sorted(tuple(r) for r in store.replace_by_key(old, new, "run_id").collect()) == \
        [("r1", "a"), ("r2", "B"), ("r3", "C")]
    assert store.append_new(old, new, ["run_id"]).count() == 1


def test_resume_skips_completed(spark):
    todo = spark.createDataFrame([(1,), (2,), (3,)], "case_id long")
    facts = spark.createDataFrame([(1, "r"), (2, "other")], "case_id long, run_id string")
    assert [r[0] for r in store.remaining(todo, facts, run_id="r").orderBy("case_id").collect()] == [2, 3]


def test_save_run_composes_writes(spark):
    recs = spark.createDataFrame([(1, "a", "t0")], "case_id long, title string, first_seen_at string")
    runs = spark.createDataFrame([("r1", 1)], "run_id string, total_cases long")
    facts = spark.createDataFrame([("r1", 1, 10, "Passed")],
                                  "run_id string, case_id long, score_id long, verdict string")
    new_recs = spark.createDataFrame([(1, "A", "t1"), (2, "b", "t1")], recs.schema)
    run_row = spark.createDataFrame([("r2", 2)], runs.schema)
    new_facts = spark.createDataFrame([("r2", 1, 11, None), ("r2", 2, 12, "Failed"),
                                       ("r1", 1, 10, "Passed")], facts.schema)
    r, n, f = store.save_run(recs, runs, facts, new_recs, run_row, new_facts)
    assert sorted(tuple(x) for x in r.collect()) == [(1, "A", "t0"), (2, "b", "t1")]
    assert sorted(x[0] for x in n.collect()) == ["r1", "r2"]
    assert f.count() == 3  # the replayed r1 row is not appended twice


def test_record_log_view_equals_sequential_upserts(spark):
    """U2 by merge-on-read: the newest snapshot's content (NULLs included), the first
    time seen kept -- the same table as applying the upsert snapshot by snapshot in time
    order; a replayed snapshot changes nothing."""
    import random

    from casegauge.operators import store
    from casegauge.streaming import incremental as inc

    random.seed(7)
    snaps = []
    for i in range(60):
        cid = random.choice([1, 2, 3, 4, 5, 5, 5, 5])          # one hot record
        snaps.append((cid, random.choice(["a", "b", None]), random.choice(["T", None]),
                      "P", "C", i, f"2024-01-{1 + i // 10:02d} 00:00:{i % 7:02d}"))
    cols = "case_id long, title string, tribe string, product string, capability string, " \
           "score_id long, seen_at string"
    log = spark.createDataFrame(snaps, cols).withColumn("seen_at", F.to_timestamp("seen_at"))
    view = {r["case_id"]: tuple(r) for r in inc.current_records(log).collect()}
    replay = log.unionByName(log.where(F.col("score_id") < 50))
    assert {r["case_id"]: tuple(r) for r in inc.current_records(replay).collect()} == view

    table = None
    rec_cols = ["case_id", "title", "tribe", "product", "capability"]
    for r in sorted(log.collect(), key=lambda r: (r["seen_at"], r["score_id"])):
        new = spark.createDataFrame([(*[r[c] for c in rec_cols], r["seen_at"], r["seen_at"])],
                                    cols.rsplit(", score_id", 1)[0] +
                                    ", first_seen_at timestamp, last_updated_at timestamp")
        table = new if table is None else store.upsert(table, new, "case_id",
                                                       keep_first=["first_seen_at"])
        table = spark.createDataFrame(table.collect(), table.schema)   # keep the plan small
    assert {r["case_id"]: tuple(r) for r in table.collect()} == view


def test_orphans_both_reasons_with_and_without_broadcast(spark):
    """Unknown record and unknown run, a hot orphan record included; the result is
    the same whether the unknown ids are broadcast or joined by shuffle."""
    from casegauge.operators import store

    facts = spark.createDataFrame(
        [(i, 9 if i < 40 else i % 3, "r1" if i % 5 else "rX") for i in range(60)],
        "score_id long, case_id long, run_id string")
    records = spark.createDataFrame([(0,), (1,), (2,)], "case_id long")
    runs = spark.createDataFrame([("r1",)], "run_id string")
    want = sorted([(i, "unknown record") for i in range(40)] +
                  [(i, "unknown run") for i in range(60) if i % 5 == 0])
    for bound in (1_000, 0):
        got = sorted((r["score_id"], r["reason"]) for r in
                     store.orphans(facts, records, runs, max_broadcast_rows=bound).collect())
        assert got == want


def test_store_operators_against_python_on_random_data(spark):
    """Latest per key (ties kept / dedup), upsert and run counters equal their semantics
    stated in Python, on random facts with a hot key, timestamp ties and NULL verdicts."""
    import random
    from collections import Counter, defaultdict

    from casegauge.operators import store

    rng = random.Random(13)
    facts = [(i, 0 if rng.random() < 0.33 else rng.randint(1, 40), f"r{rng.randint(1, 4)}",
              rng.choice(["Passed", "Failed", "Needs Improvement", None]), rng.randint(1, 6))
             for i in range(1200)]
    df = spark.createDataFrame(facts, "score_id long, case_id long, run_id string, "
                                      "verdict string, validated_at long")
    newest = defaultdict(int)
    for f in facts:
        newest[f[1]] = max(newest[f[1]], f[4])
    ties = sorted(f[0] for f in facts if f[4] == newest[f[1]])
    assert sorted(r["score_id"] for r in store.latest_per_key(df).collect()) == ties
    one = {}
    for f in sorted(facts, key=lambda f: (f[4], f[0])):
        one[f[1]] = f[0]
    assert sorted(r["score_id"] for r in store.latest_per_key(
        df, dedup=True, tie_break=["score_id"]).collect()) == sorted(one.values())

    runs = spark.createDataFrame([(f"r{k}", "p", "m", 0, "t") for k in range(1, 6)],
                                 "run_id string, provider string, model string, total_cases long, "
                                 "run_at string")
    want = defaultdict(Counter)
    for f in facts:
        want[f[2]][f[3]] += 1
    for r in store.run_counters(runs, df).collect():
        c = want[r["run_id"]]
        assert (r["passed_count"], r["needs_improvement_count"], r["failed_count"],
                r["error_count"]) == (c["Passed"], c["Needs Improvement"], c["Failed"], c[None])

    old = [(k, rng.choice(["a", None]), f"o{k}") for k in range(0, 60, 2)]
    new = [(k, rng.choice(["b", None]), f"n{k}") for k in range(0, 60, 3)]
    schema = "case_id long, title string, first_seen_at string"
    merged = {r["case_id"]: (r["title"], r["first_seen_at"]) for r in store.upsert(
        spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), "case_id",
        keep_first=["first_seen_at"]).collect()}
    expect = {k: (t, f) for k, t, f in old}
    for k, t, f in new:
        expect[k] = (t, expect[k][1] if k in expect else f)
    assert merged == expect
