"""User-level API end to end: land -> screen -> passed -> validate (resume) -> store views."""

from pyspark.sql import functions as F

from casegauge import api
from casegauge.plans import fixtures as fx
from casegauge.session import scratch_path
from tests.conftest import SF_SMALL


def test_pipeline_end_to_end(spark):
    base = scratch_path(spark, "test-api")
    fx.landed_response_lines(fx.tables(spark, SF_SMALL)).write.text(f"{base}/responses")
    path, rep, totals = api.save_all_cases(spark, f"{base}/responses", f"{base}/reports",
                                           run_ts="20240105_101010")
    assert path.endswith("run_ts=20240105_101010")
    passed = api.fetch_passed_cases(spark, f"{base}/reports")
    n = passed.count()
    assert n == rep.where(F.col("General Standards") == "Passed").count() > 0
    assert totals == {"total": rep.count(), "passed": n, "failed": rep.count() - n}
    breakdown = api.failure_breakdown(rep)
    assert breakdown.columns == ["Criterion", "Failed cases"] and breakdown.count() > 0

    rows, counts = api.validate_cases(spark, passed, f"{base}/store", run_id="r1",
                                      now="2024-01-06T00:00:00", output_dir=f"{base}/out")
    assert rows.count() == n == counts["total"]
    assert counts["passed"] + counts["needs_improvement"] + counts["failed"] + counts["errors"] == n
    csv = spark.read.option("header", True).csv(f"{base}/out/validation_reports/run_ts=r1")
    assert csv.count() == n and len(csv.columns) == 11
    # an older-format report saved under a name that sorts first is not the latest
    spark.createDataFrame([("C9", "t", True, "old")],
                          "`Test Case ID` string, Title string, `Overall Passed` boolean, Summary string") \
        .write.option("header", True).csv(f"{base}/out/validation_reports/run_ts=a0")
    latest = api.latest_validation_report(spark, f"{base}/out")
    assert latest.count() == n and "Verdict" in latest.columns
    assert api.latest_validation_report(spark, f"{base}/nothing") is None
    view = api.get_all_cases(spark, f"{base}/store")
    assert view.count() == n and view.where("verdict IS NULL").count() == 0

    again, again_counts = api.validate_cases(spark, passed, f"{base}/store", run_id="r1",
                                             now="2024-01-07T00:00:00", output_dir=f"{base}/out")
    assert again.count() == 0                              # resume: everything already scored
    assert again_counts["total"] == n                      # N9: the run's report is whole
    assert spark.read.option("header", True).csv(
        f"{base}/out/validation_reports/run_ts=r1").count() == n
    runs = api.get_validation_runs(spark, f"{base}/store").collect()
    assert len(runs) == 1
    r = runs[0]
    assert r["total_cases"] == n
    assert r["passed_count"] + r["needs_improvement_count"] + r["failed_count"] + r["error_count"] == n

    second, _ = api.validate_cases(spark, passed, f"{base}/store", run_id="r2",
                                   now="2024-01-08T00:00:00")
    assert second.count() == n
    runs = {r["run_id"]: r for r in api.get_validation_runs(spark, f"{base}/store").collect()}
    assert set(runs) == {"r1", "r2"}
    assert (runs["r1"]["run_at"], runs["r1"]["total_cases"]) == ("2024-01-06T00:00:00", n)
    assert [r["run_id"] for r in api.get_validation_runs(spark, f"{base}/store").collect()] == \
        ["r2", "r1"]
    # counters are sums of the parts' own counts: no score is read for them
    assert not any("score_facts" in f or "score_history" in f
                   for f in api.read_runs(spark, f"{base}/store").inputFiles())
    # facts are appended, never rewritten: one part per call that scored something
    import glob
    assert len(glob.glob(f"{base}/store/score_facts/run=*/part=*")) == 2
    assert api.read_facts(spark, f"{base}/store", "r1").count() == n
    assert api.read_facts(spark, f"{base}/store", "none-such").count() == 0
    cid = passed.first()["Test Case ID"]
    hist = api.get_case_history(spark, f"{base}/store", cid).collect()
    assert [h["run_id"] for h in hist] == ["r2", "r1"]
    view = api.get_all_cases(spark, f"{base}/store")
    assert view.count() == n
    rec = view.where(F.col("case_id") == cid).first()
    assert (rec["first_seen_at"], rec["last_updated_at"]) == ("2024-01-06T00:00:00",
                                                               "2024-01-08T00:00:00")


def test_generate_endpoint_file(spark):
    base = scratch_path(spark, "test-endpoints")
    spark.createDataFrame([("C1", "https://x/index.php?/cases/view/11"), ("C2", "no id here")],
                          ["ID", "Testrail Link"]).write.option("header", True).csv(f"{base}/ids.csv")
    out, rejected = api.generate_endpoint_file(spark, f"{base}/ids.csv", f"{base}/out")
    assert out.endswith("ids-endpoint")
    got = spark.read.option("header", True).csv(out).collect()
    assert [(r["ID"], r["endpoint"].rsplit("/", 1)[-1]) for r in got] == [("C1", "11")]
    assert [r["ID"] for r in rejected.collect()] == ["C2"]


def test_save_all_cases_decodes_retrieval_fields(spark):
    """Tribe / Product / Capability come from the dictionary file; unknown ids stay empty."""
    import json
    import os

    base = scratch_path(spark, "test-api-maps")
    os.makedirs(base, exist_ok=True)
    doc = {"field_maps": {"STATUS_MAP": {"2": "New"}},
           "retrieval_fields": {"_comment": "retrieval", "TRIBE_MAP": {"1": "Payments"},
                                "PRODUCT_MAP": {"5": "Cards", "_comment": "x"},
                                "CAPABILITY_MAP": {"9": "Refunds"}}}
    with open(f"{base}/maps.json", "w") as fh:
        json.dump(doc, fh)
    lines = [json.dumps({"ID": "1", "status_code": 200, "response": {
        "id": 1, "title": "a", "custom_case_tribe": 1, "custom_product_prod": 5,
        "custom_capability": 9, "priority_id": 1, "custom_automatability": 2,
        "custom_automation_status": 1, "custom_testing_type": 17, "case_status_id": 2,
        "custom_testing_phase": [1]}}),
        json.dumps({"ID": "2", "status_code": 200, "response": {
            "id": 2, "title": "b", "custom_case_tribe": 4, "custom_product_prod": None,
            "custom_capability": 9}})]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{base}/responses")
    _, rep, totals = api.save_all_cases(spark, f"{base}/responses", f"{base}/reports",
                                        run_ts="20240105_101010", maps_path=f"{base}/maps.json")
    got = {r["Test Case ID"]: (r["Tribe"], r["Product"], r["Capability"], r["General Standards"])
           for r in rep.collect()}
    assert got == {"C1": ("Payments", "Cards", "Refunds", "Passed"),
                   "C2": (None, None, "Refunds", "Failed")}
    assert totals == {"total": 2, "passed": 1, "failed": 1}


def test_build_links_file_and_run_pipeline(spark):
    import json
    import os

    base = scratch_path(spark, "test-api-links")
    spark.createDataFrame([("C2615919", "a"), ("x", "b")], ["ID", "Title"]) \
        .write.option("header", True).csv(f"{base}/ids.csv")
    out, enriched = api.build_links_file(spark, f"{base}/ids.csv", f"{base}/out")
    assert out.endswith("ids_with_links")
    assert enriched.columns == ["ID", "Testrail Link", "Title"]
    links = {r["ID"]: r["Testrail Link"] for r in
             spark.read.option("header", True).csv(out).collect()}
    assert links["C2615919"].endswith("/2615919") and links["x"] in ("", None)

    # the enriched file is the next run's id list; one of its links has no id
    responses = [json.dumps({"ID": "C2615919", "status_code": 200, "response": {
        "id": 2615919, "title": "t", "priority_id": 1, "custom_automatability": 2,
        "custom_automation_status": 1, "custom_testing_type": 17, "case_status_id": 2,
        "custom_testing_phase": [12]}})]
    os.makedirs(f"{base}/responses", exist_ok=True)
    spark.createDataFrame([(x,) for x in responses], "value string").write.mode("overwrite") \
        .text(f"{base}/responses")
    res = api.run_pipeline(spark, out, f"{base}/responses", f"{base}/run", run_ts="20240101_000000")
    assert [r["ID"] for r in res["rejected"].collect()] == ["x"]
    assert {r["ID"]: r["fetch_status"] for r in res["fetch_status"].collect()} == {"C2615919": "ok"}
    stored = spark.read.parquet(f"{base}/run/quarantine/run_ts=20240101_000000").collect()
    assert [tuple(r) for r in stored] == [tuple(r) for r in res["quarantine"].collect()] == [
        ("link without an id", "x", links["x"])]
    assert res["totals"] == {"total": 1, "passed": 1, "failed": 0}


def test_run_all_scores_passed_records_only_when_there_are_some(spark):
    import json

    base = scratch_path(spark, "test-api-runall")
    spark.createDataFrame([("C1", "https://x/index.php?/cases/view/1"),
                           ("C2", "https://x/index.php?/cases/view/2")], ["ID", "Testrail Link"]) \
        .write.option("header", True).csv(f"{base}/ids.csv")

    def land(path, phases):
        lines = [json.dumps({"ID": f"C{i}", "status_code": 200, "response": {
            "id": i, "title": f"t{i}", "priority_id": 1, "custom_automatability": 2,
            "custom_automation_status": 1, "custom_testing_type": 17, "case_status_id": 2,
            "custom_testing_phase": p, "custom_preconds": "<ol><li>Open https://x as user</li></ol>",
            "custom_steps_separated": [{"content": "<p>click save</p>", "expected": "saved"}]}})
            for i, p in ((1, phases[0]), (2, phases[1]))]
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)

    land(f"{base}/none", ([3], [4]))          # no regression phase: nothing passes
    out = api.run_all(spark, f"{base}/ids.csv", f"{base}/none", f"{base}/o1", f"{base}/store1",
                      run_id="20240101_000001")
    assert out["validation"] is None and out["totals"]["passed"] == 0
    land(f"{base}/some", ([12], [4]))
    out = api.run_all(spark, f"{base}/ids.csv", f"{base}/some", f"{base}/o2", f"{base}/store2",
                      run_id="20240101_000002", now="2024-01-01T00:00:02")
    assert out["validation"].count() == 1 and out["validation_counts"]["total"] == 1
    assert api.get_validation_runs(spark, f"{base}/store2").count() == 1
    # the output folder now holds a screening report and a newer validation report: the
    # passed cases still come from the screening report
    assert api.fetch_passed_cases(spark, f"{base}/o2").count() == 1
    assert api.latest_validation_report(spark, f"{base}/o2").count() == 1


def test_store_tables_written_by_an_older_version_are_upgraded(spark):
    """Legacy score rows get their verdict from the pass flag; old run rows count 0
    needs-improvement; the views work over a mix of old and new parts."""
    base = scratch_path(spark, "test-api-legacy-store")
    spark.createDataFrame([("s1", "C1", "r0", 1, "2024-01-01T00:00:00"),
                           ("s2", "C2", "r0", 0, "2024-01-01T00:00:00"),
                           ("s3", "C3", "r0", None, "2024-01-01T00:00:00")],
                          "score_id string, case_id string, run_id string, overall_passed int, "
                          "validated_at string").write.parquet(f"{base}/score_facts/part=old")
    spark.createDataFrame([("s4", "C1", "r1", "Needs Improvement", "2024-02-01T00:00:00")],
                          "score_id string, case_id string, run_id string, verdict string, "
                          "validated_at string").write.parquet(f"{base}/score_facts/part=new")
    spark.createDataFrame([("r0", "p", "m", 3, 1, 1, 1, "2024-01-01T00:00:00")],
                          "run_id string, provider string, model string, total_cases long, "
                          "passed_count long, failed_count long, error_count long, run_at string") \
        .write.parquet(f"{base}/validation_runs/version=20240101")
    facts = {r["score_id"]: r["verdict"] for r in api.read_facts(spark, base).collect()}
    assert facts == {"s1": "Passed", "s2": "Failed", "s3": None, "s4": "Needs Improvement"}
    run = api.get_validation_runs(spark, base).first()
    assert run["needs_improvement_count"] == 0 and run["passed_count"] == 1
    assert api.read_facts(spark, f"{base}/nothing").count() == 0
    # an older record log is merged in, and the store grows on: by a run of its own and the old one
    spark.createDataFrame([("C1", "old", "2024-01-01T00:00:00", "1")],
                          "case_id string, title string, seen_at string, version string") \
        .write.parquet(f"{base}/test_cases/part=1")
    for run_id in ("r9", "r0"):
        api.validate_cases(spark, _cases(spark, ["C1", "C9"]), base, run_id=run_id,
                           now=f"2024-03-01T00:00:0{len(run_id)}")
    runs = {r["run_id"]: r for r in api.get_validation_runs(spark, base).collect()}
    assert runs["r9"]["passed_count"] == 2
    # C1 was scored in r0 before, C9 is new: the old counters and the new part's
    assert (runs["r0"]["passed_count"], runs["r0"]["total_cases"]) == (2, 3)
    records = {r["case_id"]: (r["title"], r["first_seen_at"]) for r in
               api.read_records(spark, base).collect()}
    assert records == {"C1": ("tC1", "2024-01-01T00:00:00"), "C9": ("tC9", "2024-03-01T00:00:02")}
    assert [r["run_id"] for r in api.get_case_history(spark, base, "C1").collect()] == ["r9", "r0"]
    latest = {r["case_id"]: r["run_id"] for r in api.read_latest(spark, base).collect()}
    assert latest.pop("C9") in ("r0", "r9")  # scored in both runs at one time
    assert latest == {"C1": "r9", "C2": "r0", "C3": "r0"}


def test_reply_id_in_report_request_id_in_store(spark):
    """An evaluator answering with another id -- the report row shows the reply's id,
    the stored score keeps the request's; a failing call is an error row with the
    request's id and a NULL verdict."""
    import json

    import pandas as pd

    def evaluator(pdf: pd.DataFrame) -> pd.Series:
        def one(cid):
            if cid.endswith("2"):
                raise RuntimeError("service down")
            crit = {"passed": True, "remarks": ""}
            return json.dumps({"test_case_id": "X" + cid, "preconditions": crit,
                               "test_steps": crit, "expected_results": crit,
                               "verdict": "Passed", "overall_remarks": "", "improvements": ""})
        return pdf["case_id"].map(one)

    base = scratch_path(spark, "test-api-reply-id")
    passed = spark.createDataFrame(
        [("C1", "a", "1. x", "1. y", "z"), ("C2", "b", "1. x", "1. y", "z")],
        "`Test Case ID` string, Title string, `Pre Conditions` string, `Test Steps` string, "
        "`Expected Result` string")
    rows, counts = api.validate_cases(spark, passed, f"{base}/store", evaluator=evaluator,
                                      run_id="r1", now="2024-01-01T00:00:00")
    got = {r["Test Case ID"]: r["Verdict"] for r in rows.collect()}
    assert got == {"XC1": "Passed", "C2": None}
    assert (counts["passed"], counts["errors"]) == (1, 1)
    stored = {r["case_id"]: r["verdict"] for r in api.read_facts(spark, f"{base}/store").collect()}
    assert stored == {"C1": "Passed", "C2": None}
    err = [r for r in rows.collect() if r["Verdict"] is None][0]
    assert err["Overall Remarks"].startswith("Error during validation: RuntimeError: service down")
    lost = [tuple(r)[:5] for r in api.read_quarantine(spark, f"{base}/store").collect()]
    assert lost == [("r1", "C1", "XC1", "reply names another record", True)]


def test_evaluator_receives_the_prompt(spark):
    """with the standards text, each record's prompt holds the standards, the case's
    fields, '(empty)' for a missing text, and the instructions."""
    import json

    import pandas as pd

    seen = {}

    def evaluator(pdf: pd.DataFrame) -> pd.Series:
        crit = {"passed": True, "remarks": ""}
        for cid, prompt in zip(pdf["case_id"], pdf["prompt"]):
            seen[cid] = prompt
        return pdf["case_id"].map(lambda cid: json.dumps({
            "preconditions": crit, "test_steps": crit, "expected_results": crit,
            "verdict": "Passed", "overall_remarks": "", "improvements": ""}))

    base = scratch_path(spark, "test-api-prompt")
    passed = spark.createDataFrame(
        [("C1", "Login", "web", "Regression", "1. Open https://x", None, "shown")],
        "`Test Case ID` string, Title string, `Testing Type` string, `Testing Phase` string, "
        "`Pre Conditions` string, `Test Steps` string, `Expected Result` string")
    rows, _ = api.validate_cases(spark, passed, f"{base}/store", evaluator=evaluator,
                                 run_id="r1", now="2024-01-01T00:00:00", parallelism=1,
                                 standards="# Standards\nbe clear", instructions="Judge it.")
    assert [r["Verdict"] for r in rows.collect()] == ["Passed"]   # it read the prompt column
    # the evaluator ran in a Python worker: rebuild the prompt natively to compare
    from casegauge.operators import score
    c = F.col
    prompt = passed.select(score.evaluation_prompt(
        F.lit("# Standards\nbe clear"), F.lit(None), c("`Test Case ID`"), c("Title"),
        c("`Testing Type`"), c("`Testing Phase`"), c("`Pre Conditions`"), c("`Test Steps`"),
        c("`Expected Result`"), "Judge it.")).first()[0]
    assert prompt.startswith("## Quality Standards Reference\n\n# Standards\nbe clear\n\n---\n")
    assert "**Test Case ID:** C1\n**Title:** Login\n**Testing Type:** web\n" in prompt
    assert "**Test Steps:**\n(empty)\n" in prompt and prompt.endswith("---\n\nJudge it.")


def test_no_successful_fetch_writes_no_report(spark):
    """With no status-200 response nothing is written, so the newest report (and the
    passed cases) stay those of the previous run."""
    import json

    base = scratch_path(spark, "test-api-nofetch")
    good = json.dumps({"ID": "1", "status_code": 200, "response": {
        "id": 1, "priority_id": 1, "custom_automatability": 2, "custom_automation_status": 1,
        "custom_testing_type": 17, "case_status_id": 2, "custom_testing_phase": [12]}})
    spark.createDataFrame([(good,)], "value string").write.text(f"{base}/r1")
    spark.createDataFrame([(json.dumps({"ID": "2", "status_code": 404}),)],
                          "value string").write.text(f"{base}/r2")
    p1, _, t1 = api.save_all_cases(spark, f"{base}/r1", f"{base}/out", run_ts="20240101_000000")
    p2, _, t2 = api.save_all_cases(spark, f"{base}/r2", f"{base}/out", run_ts="20240102_000000")
    assert p1 is not None and p2 is None and t2 == {"total": 0, "passed": 0, "failed": 0}
    assert [r["Test Case ID"] for r in api.fetch_passed_cases(spark, f"{base}/out").collect()] == ["C1"]


def test_partial_run_then_resume_reports_the_whole_run(spark):
    """J9 + N9 + N10: half the records scored, the run resumed with all of them: the second
    call scores only the rest, the run's CSV and counters cover the whole run, and the
    run keeps the total it was opened with."""
    base = scratch_path(spark, "test-api-resume")
    passed = spark.createDataFrame(
        [(f"C{i}", f"t{i}", "1. Open https://x as user", "1. click save", "saved") for i in range(10)],
        "`Test Case ID` string, Title string, `Pre Conditions` string, `Test Steps` string, "
        "`Expected Result` string")
    first_half = passed.where(F.col("`Test Case ID`").isin(*[f"C{i}" for i in range(5)]))
    rows1, c1 = api.validate_cases(spark, first_half, f"{base}/store", run_id="r1",
                                   now="2024-01-01T00:00:00", output_dir=f"{base}/out")
    rows2, c2 = api.validate_cases(spark, passed, f"{base}/store", run_id="r1",
                                   now="2024-01-02T00:00:00", output_dir=f"{base}/out")
    assert (rows1.count(), rows2.count()) == (5, 5)
    assert (c1["total"], c2["total"]) == (5, 10)
    csv = spark.read.option("header", True).csv(f"{base}/out/validation_reports/run_ts=r1")
    assert sorted(r["Test Case ID"] for r in csv.collect()) == sorted(f"C{i}" for i in range(10))
    run = api.get_validation_runs(spark, f"{base}/store").first()
    assert run["total_cases"] == 5                     # set when the run was opened
    assert run["passed_count"] + run["needs_improvement_count"] + run["failed_count"] \
        + run["error_count"] == 10


def _cases(spark, ids):
    return spark.createDataFrame(
        [(i, f"t{i}", "1. Open https://x as user", "1. Click save", "saved", "Pay") for i in ids],
        "`Test Case ID` string, Title string, `Pre Conditions` string, `Test Steps` string, "
        "`Expected Result` string, Tribe string")


def test_scores_are_stored_in_parts_and_a_failed_run_resumes(spark, tmp_path):
    """A run that breaks in a later part keeps the scores of the parts before, shows them in
    the history, and the resumed run calls the evaluator once for each record left."""
    import json

    import pandas as pd
    import pytest

    log, switch = str(tmp_path / "calls"), str(tmp_path / "broken")

    def evaluator(pdf: pd.DataFrame) -> pd.Series:
        import os
        cid = pdf["case_id"].iloc[0]
        if cid == "C7" and os.path.exists(switch):
            raise SystemExit("worker lost")      # not an error of the row: the job fails
        with open(log, "a") as f:
            f.write(cid + "\n")
        crit = {"passed": True, "remarks": ""}
        return pd.Series([json.dumps({"preconditions": crit, "test_steps": crit,
                                      "expected_results": crit, "verdict": "Passed"})])

    base = str(tmp_path)
    passed = _cases(spark, [f"C{i}" for i in range(12)])
    n = 4
    order = {r["id"]: r["p"] for r in passed.select(F.col("`Test Case ID`").alias("id"), F.pmod(
        F.xxhash64("`Test Case ID`"), F.lit(n)).alias("p")).collect()}
    open(switch, "w").close()
    args = dict(evaluator=evaluator, run_id="r1", part_size=3, parallelism=1)
    with pytest.raises(Exception):
        api.validate_cases(spark, passed, f"{base}/store", now="2024-01-01T00:00:00", **args)
    before = {i for i, p in order.items() if p < order["C7"]}
    stored = {r["case_id"] for r in api.get_completed_case_ids(spark, f"{base}/store", "r1").collect()}
    assert before <= stored < set(order)
    assert stored - before <= {i for i, p in order.items() if p == order["C7"]}
    before = stored
    for cid in sorted(before)[:1]:
        assert api.get_case_history(spark, f"{base}/store", cid).count() == 1
    import os
    os.unlink(switch)
    open(log, "w").close()
    rows, counts = api.validate_cases(spark, passed, f"{base}/store", now="2024-01-02T00:00:00", **args)
    assert rows.count() == 12 - len(before) == counts["passed"]
    assert sorted(open(log).read().split()) == sorted(set(order) - before)
    run = api.get_validation_runs(spark, f"{base}/store").first()
    assert (run["total_cases"], run["passed_count"], run["run_at"]) == (12, 12, "2024-01-01T00:00:00")


def test_repeated_ids_give_one_row_each(spark, tmp_path):
    from casegauge.operators import score

    for name, evaluator in (("a", None), ("b", score.completeness_evaluator)):
        rows, _ = api.validate_cases(spark, _cases(spark, ["C1", "C1", "C1", "C2"]),
                                     f"{tmp_path}/{name}", evaluator=evaluator, run_id="r1")
        assert sorted(r["Test Case ID"] for r in rows.collect()) == ["C1"] * 3 + ["C2"]
        assert api.read_facts(spark, f"{tmp_path}/{name}").count() == 4


def test_store_functions_for_users(spark, tmp_path):
    """A run opened, stored in two calls, read back; examples for new records."""
    base = str(tmp_path / "store")
    passed = _cases(spark, ["C1", "C2", "C3"])
    assert api.get_completed_case_ids(spark, base, "r1").count() == 0
    api.init_validation_run(spark, base, "r1", "p", "m", 3, now="2024-01-01T00:00:00")
    assert api.get_validation_runs(spark, base).first()["total_cases"] == 3
    cases = api._passed_as_records(passed)
    from casegauge.operators import score
    rows = score.result_rows(score.rule_screen(cases))
    for ids in (["C1"], ["C2", "C3"]):
        api.save_case_result(spark, base, cases.where(F.col("case_id").isin(ids)),
                             rows.where(F.col("`Test Case ID`").isin(ids)), "r1")
    assert {r[0] for r in api.get_completed_case_ids(spark, base, "r1").collect()} == {"C1", "C2", "C3"}
    api.save_validation_run(spark, base, cases, rows, "r2", "p", "m")
    runs = {r["run_id"]: r for r in api.get_validation_runs(spark, base).collect()}
    for r in runs.values():
        assert r["total_cases"] == 3 == sum(r[c] for c in (
            "passed_count", "needs_improvement_count", "failed_count", "error_count"))
    # results of unknown records, or of a run that isn't open, are kept aside with the reason
    api.save_case_result(spark, base, cases.limit(0), rows.withColumn("case_id", F.lit("Z9")).limit(1), "r2")
    api.save_case_result(spark, base, cases, rows.limit(1), "r3")
    lost = {(r["run_id"], r["case_id"], r["reason"], r["stored"])
            for r in api.read_quarantine(spark, base).where("not stored").collect()}
    assert {(a, c) for a, _, c, _ in lost} == {("r2", "unknown record"), ("r3", "unknown run")}
    assert api.read_facts(spark, base, "r3").count() == 0 and api.read_facts(spark, base, "r2").count() == 3
    # the same results again change nothing
    api.save_case_result(spark, base, cases, rows, "r2")
    assert {r["run_id"]: r["passed_count"] + r["needs_improvement_count"] + r["failed_count"]
            for r in api.get_validation_runs(spark, base).collect()} == {"r1": 3, "r2": 3}
    assert api.get_case_history(spark, base, "C2").count() == 2
    got = api.get_few_shots(spark, base, api._passed_as_records(_cases(spark, ["C1", "N1"])))
    shown = {}
    for r in got.collect():
        shown.setdefault(r["case_id"], set()).add(r["example_id"])
    assert shown == {"C1": {"C2", "C3"}, "N1": {"C1", "C2", "C3"}}
    remark = spark.createDataFrame([("Status = Obsolete",), ("Priority/Risk is null",)], "r string")
    assert [r[0] for r in remark.select(api.categorize_remark(F.col("r"))).collect()] == \
        ["Status", "Priority/Risk"]


def test_rules_follow_the_dictionary_file(spark, tmp_path):
    """The standards' maps of a dictionary file replace the fixed ones: in the rules, the
    remarks and the decoded columns."""
    import json

    doc = {"field_maps": {"STATUS_MAP": {"2": "Obsolete", "40": "Active"},
                          "TESTING_PHASE_MAP": {"77": "Regression"}}, "retrieval_fields": {}}
    (tmp_path / "maps.json").write_text(json.dumps(doc))
    good = {"title": "a", "priority_id": 1, "custom_automatability": 2,
            "custom_automation_status": 1, "custom_testing_type": 17, "custom_testing_phase": [77]}
    lines = [json.dumps({"ID": str(i), "status_code": 200,
                         "response": {"id": i, **good, "case_status_id": s}}) for i, s in ((1, 40), (2, 2))]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_path}/responses")
    _, rep, _ = api.save_all_cases(spark, f"{tmp_path}/responses", f"{tmp_path}/out",
                                   run_ts="20240101_000000", maps_path=f"{tmp_path}/maps.json")
    got = [(r["Test Case ID"], r["General Standards"], r["Remarks"], r["Status"], r["Testing Phase"])
           for r in rep.collect()]
    assert got == [("C1", "Passed", "", "Active", "Regression"),
                   ("C2", "Failed", "Status = Obsolete", "Obsolete", "Regression")]
    assert [r["Test Case ID"] for r in api.fetch_passed_cases(spark, f"{tmp_path}/out").collect()] == ["C1"]
