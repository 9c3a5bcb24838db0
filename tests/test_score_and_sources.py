"""Reply parsing, the pluggable evaluator path, file sources/sinks and streaming."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from casegauge.functions import text
from casegauge.operators import score
from casegauge.plans import catalogue
from casegauge.session import scratch_path
from casegauge.sources import files
from casegauge.streaming import incremental as inc
from tests.conftest import SF

GOOD = ('{"test_case_id": "C1", "preconditions": {"passed": true, "remarks": ""}, '
        '"test_steps": {"passed": false, "remarks": "x"}, '
        '"expected_results": {"passed": true, "remarks": ""}, "verdict": "Needs Improvement", '
        '"overall_remarks": "o", "improvements": "i"}')


def parse(spark, replies):
    df = spark.createDataFrame([(r, "REQ") for r in replies], "reply string, rid string")
    return text.parse_replies(df, "reply", "rid").select("r.*").collect()


def test_reply_forms(spark):
    no_verdict = GOOD.replace('"verdict": "Needs Improvement", ', "")
    rows = parse(spark, [f"Sure:\n```json\n{GOOD}\n```\nbye", f"x {GOOD} y", "no braces",
                         GOOD.replace("Needs Improvement", "Maybe"), no_verdict,
                         GOOD.replace('"test_case_id": "C1", ', "")])
    assert rows[0]["valid"] and rows[0]["verdict"] == "Needs Improvement"
    assert rows[1]["valid"] and not rows[1]["test_steps"]["passed"]
    assert not rows[2]["valid"] and rows[2]["error"].startswith("no JSON")
    assert not rows[3]["valid"]
    assert rows[4]["valid"] and rows[4]["verdict"] == "Failed"
    assert rows[5]["valid"] and rows[5]["test_case_id"] == "REQ"


def test_evaluator_errors_become_rows(spark):
    def flaky(pdf: pd.DataFrame) -> pd.Series:
        if (pdf["case_id"] == "2").any():
            raise RuntimeError("service unavailable")
        return pd.Series([f"```json\n{GOOD}\n```"] * len(pdf), index=pdf.index)

    cases = spark.createDataFrame([("1",), ("2",), ("3",)], "case_id string")
    out = {r["case_id"]: r for r in score.score(cases, flaky).collect()}
    assert out["1"]["evaluation"]["verdict"] == "Needs Improvement"
    assert out["2"]["evaluation"]["verdict"] is None
    assert "service unavailable" in out["2"]["evaluation"]["overall_remarks"]
    assert out["3"]["evaluation"]["verdict"] == "Needs Improvement"


def test_csv_contract_and_multiline_roundtrip(spark):
    base = scratch_path(spark, "test-csv")
    df = spark.createDataFrame([("C1", 'a "quoted"\nsecond line', "https://x/view/12")],
                               ["ID", "Title", "Testrail Link"])
    df.write.option("header", True).option("escape", '"').csv(f"{base}/src")
    back = files.read_csv(spark, f"{base}/src", required=files.SOURCE_REQUIRED)
    assert back.collect()[0]["Title"] == 'a "quoted"\nsecond line'
    ok, rejected = files.endpoints_from_source(back)
    assert ok.first()["endpoint"].endswith("/12") and rejected.count() == 0
    with pytest.raises(files.ContractError):
        files.require_columns(back, ["ID", "Missing"])
    linked = files.add_link_column(spark.createDataFrame([("C2615919", "t")], ["ID", "Title"]))
    assert linked.columns == ["ID", "Testrail Link", "Title"]
    assert linked.first()["Testrail Link"].endswith("/2615919")


def test_landed_responses_with_quarantine(spark):
    base = scratch_path(spark, "test-json")
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/r.jsonl", "w") as fh:
        fh.write('{"ID": "1", "status_code": 200, "response": {"id": 1, "priority_id": 2}}\n')
        fh.write('{"ID": "2", "status_code": 404, "response": null}\n')
        fh.write('{"ID": "3", "status_code": 200, "resp\n')
    env, bad = files.read_responses(spark, base)
    assert env.count() == 2 and bad.count() == 1
    assert files.fetched_records(env).first()["priority_id"] == 2
    assert tuple(files.fetch_counts(env).first()) == (1, 1)


def test_latest_snapshot(spark):
    base = scratch_path(spark, "test-snap")
    df = spark.createDataFrame([("Passed", "C1")], ["General Standards", "Test Case ID"])
    files.write_snapshot(df, base, "20240101_000000")
    files.write_snapshot(df.withColumn("Test Case ID", F.lit("C2")), base, "20240301_000000")
    assert files.latest_snapshot_path(spark, base).endswith("run_ts=20240301_000000")
    got = files.read_latest_report(spark, base, required=["Test Case ID"]).first()
    assert got["Test Case ID"] == "C2"


def test_stream_equals_batch_after_restart(spark):
    out = catalogue.REGISTRY["stream_upsert"](spark, SF)
    assert out.count() == 10000
    assert out.select("score_id").distinct().count() == 10000
    counters = catalogue.REGISTRY["stream_counters"](spark, SF)
    batch = catalogue.REGISTRY["run_counters"](spark, SF).select(
        "run_id", "passed_count", "needs_improvement_count", "failed_count", "error_count")
    assert counters.exceptAll(batch).count() == 0 and batch.exceptAll(counters).count() == 0


def test_scores_that_land_again_are_stored_once(spark, tmp_path):
    """In the same batch, in a later one, after a restart; rows without a whole key are told
    apart by their content."""
    def rows(*some):
        return spark.createDataFrame([(s, c, r, "Passed", None, None, None, None) for s, c, r in some],
                                     inc.SCORE_SCHEMA)
    args = (spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ckpt")
    for some in ([(1, 1, "a"), (1, 1, "a"), (2, 1, "a")], [(1, 1, "a"), (3, 1, "a"), (1, 1, "b")],
                 [(None, 1, "a"), (None, 2, "a"), (None, 2, "a"), (2, 1, "a")]):
        inc.land_files(rows(*some), f"{tmp_path}/in")
        inc.run_to_completion(inc.save_scores_stream(*args))
    got = [(r.score_id, r.case_id, r.run_id) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got, key=str) == sorted([(1, 1, "a"), (2, 1, "a"), (3, 1, "a"), (1, 1, "b"),
                                           (None, 1, "a"), (None, 2, "a")], key=str)


def test_replies_go_to_facts_or_to_the_quarantine(spark, tmp_path):
    lines = ['{"score_id":1,"case_id":1,"reply_case_id":1,"run_id":"a","verdict":"Passed"}',
             '{"score_id":2,"case_id":1,"reply_case_id":9,"run_id":"a"}', '{"score_id":3,"case',
             '{"score_id":4,"case_id":7,"run_id":"a"}', '{"score_id":5,"case_id":1,"run_id":"z"}',
             '{"score_id":6,"run_id":"a"}', '{"score_id":3,"case']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_path}/in")
    records = spark.createDataFrame([(1,)], "case_id long")
    runs = spark.createDataFrame([("a",)], "run_id string")
    out = f"{tmp_path}/store"
    inc.run_to_completion(inc.save_replies_stream(spark, f"{tmp_path}/in", out, f"{tmp_path}/c",
                                                  records, runs))
    assert {r.score_id for r in spark.read.parquet(f"{out}/facts").collect()} == {1, 2}
    lost = {(r.score_id, r.reason, r.stored) for r in
            spark.read.parquet(f"{out}/quarantine").collect()}
    assert lost == {(2, "reply names another record", True), (None, "unreadable line", False),
                    (4, "unknown record", False), (5, "unknown run", False),
                    (6, "incomplete key", False)}
    torn = spark.read.parquet(f"{out}/quarantine").where("reason = 'unreadable line'").collect()
    assert [r.raw for r in torn] == [lines[2]]
    assert tuple(inc.read_counters(spark, out).first()) == ("a", 1, 0, 0, 1)
    # the record becomes known: its reply is stored, once
    more = spark.createDataFrame([(1,), (7,)], "case_id long")
    assert [r.score_id for r in inc.readmit(spark, out, more, runs, 0).collect()] == [4]
    assert inc.readmit(spark, out, more, runs, 1).count() == 0
    assert tuple(inc.read_counters(spark, out).first()) == ("a", 1, 0, 0, 2)


def test_legacy_normalize(spark):
    df = spark.createDataFrame([(True, "s"), (False, None), (None, "x")],
                               "`Overall Passed` boolean, Summary string")
    rows = files.normalize_validation(df).collect()
    assert [r["Verdict"] for r in rows] == ["Passed", "Failed", None]
    assert rows[0]["Overall Remarks"] == "s" and rows[0]["Improvements"] == ""
    assert inc.SCORE_SCHEMA.fieldNames()[0] == "score_id"


def test_legacy_flag_spellings(spark):
    """Text and numeric legacy flags: only true/1 and false/0 count; other values stay NULL."""
    text = spark.createDataFrame([("True",), ("false",), ("TRUE",), ("yes",), ("1",), (None,)],
                                 "`Overall Passed` string")
    assert [r["Verdict"] for r in files.normalize_validation(text).collect()] == \
        ["Passed", "Failed", "Passed", None, "Passed", None]
    nums = spark.createDataFrame([(1.0,), (0.0,), (2.0,), (None,)], "`Overall Passed` double")
    assert [r["Verdict"] for r in files.normalize_validation(nums).collect()] == \
        ["Passed", "Failed", None, None]


def test_breakdown_criterion_strips_unicode_space(spark):
    """The criterion before ' = ' is stripped like Python's str.strip (NBSP included)."""
    from casegauge.operators import report
    df = spark.createDataFrame([("Failed", " Status  = Obsolete; Priority/Risk is null")],
                               "verdict string, remarks string")
    got = {r["criterion"]: r["failed_cases"]
           for r in report.failure_breakdown(df, compat=True).collect()}
    assert got == {"Status": 1, "Priority/Risk": 1}


def test_reply_contract_json_types(spark):
    """flags accept JSON booleans, 1/0 and text spellings; texts must be JSON strings;
    a missing verdict defaults to Failed, a non-enum one is invalid; a missing id is the
    request id, a numeric one is invalid."""
    from casegauge.functions import text as tx

    def reply(passed='true', remarks='""', extra=', "verdict": "Passed"', tcid='"C7", '):
        return ('{' + (f'"test_case_id": {tcid}' if tcid else '') +
                f'"preconditions": {{"passed": {passed}, "remarks": {remarks}}}, '
                '"test_steps": {"passed": true, "remarks": ""}, '
                '"expected_results": {"passed": false, "remarks": "x"}' + extra + '}')
    cases = {
        "bool": (reply(), (True, True, "Passed", "C7")),
        "text flag": (reply(passed='"No"'), (True, False, "Passed", "C7")),
        "int flag": (reply(passed='1'), (True, True, "Passed", "C7")),
        "bad int flag": (reply(passed='2'), (False, None, "Passed", "C7")),
        "null flag": (reply(passed='null'), (False, None, "Passed", "C7")),
        "numeric remarks": (reply(remarks='5'), (False, True, "Passed", "C7")),
        "no verdict": (reply(extra=''), (True, True, "Failed", "C7")),
        "bad verdict": (reply(extra=', "verdict": "passed"'), (False, True, "passed", "C7")),
        "no id": (reply(tcid=''), (True, True, "Passed", "REQ")),
        "numeric id": (reply(tcid='7, '), (False, True, "Passed", None)),
        "repeated key, last wins": (reply(extra=', "verdict": "Maybe", "verdict": "Failed"'),
                                    (True, True, "Failed", "C7")),
        "criterion not an object": ('{"preconditions": true, "test_steps": {"passed": true, '
                                    '"remarks": ""}, "expected_results": {"passed": true, '
                                    '"remarks": ""}}', (False, None, "Failed", "REQ")),
    }
    df = spark.createDataFrame([(k, "```json\n" + v + "\n```") for k, (v, _) in cases.items()],
                               "k string, reply string").withColumn("req", F.lit("REQ"))
    got = {r["k"]: (r["valid"], r["passed"], r["verdict"], r["tcid"]) for r in
           tx.parse_replies(df, "reply", "req").select(
               "k", "r.valid", F.col("r.preconditions.passed").alias("passed"), "r.verdict",
               F.col("r.test_case_id").alias("tcid")).collect()}
    assert got == {k: want for k, (_, want) in cases.items()}


def test_fetch_status_per_endpoint(spark):
    """Ok if any landed envelope of the id returned 200 (a retry), failed when only
    other / missing status codes landed, not fetched when none did."""
    endpoints = spark.createDataFrame([("1", "e1"), ("2", "e2"), ("3", "e3"), ("4", "e4")],
                                      "ID string, endpoint string")
    env = spark.createDataFrame([("1", 404), ("1", 200), ("2", None), ("3", 500)],
                                "ID string, status_code int")
    got = {r["ID"]: r["fetch_status"] for r in files.fetch_status(endpoints, env).collect()}
    assert got == {"1": "ok", "2": "failed", "3": "failed", "4": "not fetched"}


def test_response_lines_parsed_once_and_classified(spark):
    """Torn lines and JSON values that are not objects go to the quarantine; an envelope
    with a mistyped field is kept (that field NULL): a code sent as text fails its rule
    with 'None', as the reference's screen does."""
    from casegauge.operators import standards

    base = scratch_path(spark, "test-responses")
    rec = ('{"id": 7, "priority_id": 1, "custom_automatability": "2", '
           '"custom_automation_status": 1, "custom_testing_type": 17, "case_status_id": 2, '
           '"custom_testing_phase": [12]}')
    lines = ['{"ID": "7", "status_code": 200, "response": ' + rec + '}',
             '{"ID": "8", "status_co', '[1, 2]', 'null', '{"ID": "9", "status_code": 404}', '   ']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(base)
    env, bad = files.read_responses(spark, base)
    assert sorted(r["line"] for r in bad.collect()) == sorted(['{"ID": "8", "status_co', '[1, 2]', 'null'])
    assert sorted(r["ID"] for r in env.collect()) == ["7", "9"]
    row = standards.flatten(files.fetched_records(env)).first()
    assert (row["General Standards"], row["Remarks"]) == ("Failed", "Automatability = None")
    counts = files.ingest_counts(spark, base).first()
    assert (counts["ok"], counts["failed"], counts["quarantined"]) == (1, 1, 3)


def test_success_without_a_record_is_quarantined(spark):
    from casegauge.session import scratch_path
    from casegauge.sources import files

    base = scratch_path(spark, "test-null-record")
    lines = ['{"ID": "7", "status_code": 200, "response": null}', '{"ID": "8", "status_code": 200}',
             '{"ID": "9", "status_code": 404, "response": null}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(base)
    env, bad = files.read_responses(spark, base)
    assert sorted(r["line"] for r in bad.collect()) == lines[:2]
    assert [r["ID"] for r in env.collect()] == ["9"]
    counts = files.ingest_counts(spark, base).first()
    assert (counts["ok"], counts["failed"], counts["quarantined"]) == (0, 1, 2)
    asked = spark.createDataFrame([("7",), ("8",), ("9",)], "ID string")
    status = {r["ID"]: r["fetch_status"] for r in files.fetch_status(asked, env).collect()}
    assert status == {"7": "not fetched", "8": "not fetched", "9": "failed"}


def test_reply_parsing_matches_a_typed_contract_on_random_replies(spark):
    """F20 F21 differential: 3,000 random replies (fenced, in prose, none, broken; every
    field's JSON type varied) -- validity and values equal a pydantic model of the result
    contract (lax mode), with the contract's defaults for missing keys."""
    import enum
    import json
    import random
    import re

    import pydantic

    class Verdict(str, enum.Enum):
        passed = "Passed"
        needs = "Needs Improvement"
        failed = "Failed"

    class Crit(pydantic.BaseModel):
        passed: bool
        remarks: str

    class Result(pydantic.BaseModel):
        test_case_id: str
        preconditions: Crit
        test_steps: Crit
        expected_results: Crit
        verdict: Verdict
        overall_remarks: str
        improvements: str

    def contract(reply, request_id):
        m = re.search(r"```(?:json)?\s*(\{.*?\})\s*```", reply, re.DOTALL) or \
            re.search(r"\{.*\}", reply, re.DOTALL)
        if not m:
            return (False,)
        try:
            d = json.loads(m.group(1) if m.re.groups else m.group(0))
            r = Result(test_case_id=d.get("test_case_id", request_id),
                       preconditions=d["preconditions"], test_steps=d["test_steps"],
                       expected_results=d["expected_results"],
                       verdict=d.get("verdict", "Failed"),
                       overall_remarks=d.get("overall_remarks", ""),
                       improvements=d.get("improvements", ""))
        except Exception:
            return (False,)
        return (True, r.test_case_id, r.verdict.value, r.preconditions.passed,
                r.preconditions.remarks, r.test_steps.passed, r.overall_remarks, r.improvements)

    rng = random.Random(3)
    flags = ["true", "false"] * 8 + ["1", "0", "2", "1.0", "0.5", '"yes"', '"No"', '"TRUE"',
                                     '"t"', '"off"', '"maybe"', "null", '"1"', '"on "']
    texts = ['""', '"x"'] * 6 + ["5", "null", "true"]
    absent = None

    def field(name, choices):
        v = rng.choice(choices)
        return "" if v is absent else f'"{name}": {v}, '

    replies = []
    for i in range(3000):
        body = ("{" + field("test_case_id", [absent, '"C1"', '"C1"', '"C1"', "7", "null"])
                + f'"preconditions": {{"passed": {rng.choice(flags)}, "remarks": {rng.choice(texts)}}}, '
                + f'"test_steps": {{"passed": {rng.choice(flags)}, "remarks": ""}}, '
                + '"expected_results": {"passed": true, "remarks": ""}, '
                + field("overall_remarks", [absent, '""', '"s"', '"s"', '"s"', "3", "null"])
                + field("improvements", [absent, '""', '"do x"', '"do x"', "null"])
                + '"verdict": ' + rng.choice(['"Passed"', '"Needs Improvement"', '"Failed"'] * 3
                                             + ['"passed"', "1", "null"]) + "}")
        if rng.random() < 0.15:
            body = body.replace('"verdict": ', "").replace("}", "", 1)   # drop the verdict key
        wrap = rng.choice(["```json\n{}\n```", "Result:\n```\n{}\n```\nok", "Here: {} done",
                           "{}", "no json here", "```json\n{} oops\n```"])
        replies.append((f"R{i}", wrap.replace("{}", body) if "{}" in wrap else wrap))
    df = spark.createDataFrame(replies, "request_id string, reply string")
    out = text.parse_replies(df, "reply", "request_id").select(
        "request_id", "reply", "r.valid", "r.test_case_id", "r.verdict",
        F.col("r.preconditions.passed").alias("p1"), F.col("r.preconditions.remarks").alias("m1"),
        F.col("r.test_steps.passed").alias("p2"), "r.overall_remarks", "r.improvements")
    bad = []
    for r in out.collect():
        got = (False,) if not r["valid"] else (True, r["test_case_id"], r["verdict"], r["p1"],
                                                r["m1"], r["p2"], r["overall_remarks"],
                                                r["improvements"])
        want = contract(r["reply"], r["request_id"])
        if got != want:
            bad.append((r["reply"], got, want))
    assert bad == [], bad[:3]
    assert sum(1 for r in replies if contract(r[1], r[0])[0]) > 300


def test_csv_with_byte_order_mark_reads_like_without(spark):
    """A file written with a UTF-8 byte-order mark (as the reference writes its CSVs)
    has the same header and rows as one without."""
    import os

    base = scratch_path(spark, "test-bom")
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/ids.csv", "w", encoding="utf-8-sig") as fh:
        fh.write('ID,Testrail Link\nC1,"https://x/index.php?/cases/view/1"\n')
    df = files.read_csv(spark, f"{base}/ids.csv", required=files.SOURCE_REQUIRED)
    assert df.columns == ["ID", "Testrail Link"]
    assert [tuple(r) for r in df.collect()] == [("C1", "https://x/index.php?/cases/view/1")]


def test_per_row_evaluator_is_called_once_per_record(spark, tmp_path):
    import pandas as pd

    from casegauge.operators import score

    log = str(tmp_path / "calls")

    def evaluator(pdf):
        with open(log, "a") as f:
            f.write("".join(f"{i}\n" for i in pdf["case_id"]))
        if "3" in set(pdf["case_id"]):
            raise RuntimeError("bad row")
        return pd.Series(["{}"] * len(pdf))
    cases = spark.createDataFrame([(str(i), "t") for i in range(10)], "case_id string, title string")
    rows = score.score(cases.coalesce(1), evaluator, per_row=True).collect()
    assert len(rows) == 10
    assert sorted(open(log).read().split()) == [str(i) for i in range(10)]


def test_numbered_steps_are_screened_like_plain_ones(spark):
    from casegauge.operators import score

    pre, want = "Open https://app.test as user admin in UAT", "Saved"
    rows = [("a", pre, "Click the Save button\nEnter amount \"10\"", want),
            ("b", pre, "1. Click the Save button\n2. Enter amount \"10\"", want),
            ("c", pre, "1. Enter amount", want), ("d", pre, "1. Insert \"x\"\n2. \n", want)]
    got = {r.case_id: (r.evaluation.verdict, r.evaluation.test_steps.remarks) for r in
           score.rule_screen(spark.createDataFrame(rows, "case_id string, pre_conditions string, "
                             "test_steps string, expected_result string")).collect()}
    assert got == {"a": ("Passed", ""), "b": ("Passed", ""),
                   "c": ("Needs Improvement", "input steps lack data"), "d": ("Passed", "")}


def test_csv_keeps_outer_blanks(spark, tmp_path):
    from casegauge.sources import files

    df = spark.createDataFrame([("1", "  lead and trail  ")], "ID string, text string")
    files.csv_writer(df.write).csv(str(tmp_path / "out"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "out")).collect()] == [
        ("1", "  lead and trail  ")]
