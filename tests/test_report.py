"""Report semantics pinned against Python's own formatting and string rules."""

from pyspark.sql import functions as F

from casegauge.operators import report


def test_pass_rate_text_matches_python_percent_format(spark):
    """The whole-percent text equals f"{passed/total:.0%}" for every fraction, and an
    empty report shows 0%."""
    rows = [(p, t) for t in range(1, 161) for p in range(0, t + 1)]
    df = spark.createDataFrame(rows, "p long, t long")
    got = df.select("p", "t", F.format_string("%d%%", F.bround(
        F.coalesce(F.try_divide(F.col("p"), F.col("t")), F.lit(0.0)) * 100).cast("long"))
        .alias("s")).collect()
    assert [r.s for r in got] == [f"{p / t:.0%}" for p, t in rows]
    empty = spark.createDataFrame([], "`General Standards` string")
    r = report.totals(empty).first()
    assert (r["total"], r["passed"], r["failed"], r["pass_rate_text"]) == (0, 0, 0, "0%")
    one = spark.createDataFrame([("Passed",), ("Failed",), ("Failed",)], "`General Standards` string")
    assert report.totals(one).first()["pass_rate_text"] == f"{1 / 3:.0%}"


def test_search_is_lowercased_regex_over_title_or_id(spark):
    """The pattern is a regular expression, lower-cased with the text; NULL titles
    never match through the title; ``literal`` searches plain substrings."""
    df = spark.createDataFrame([("C1", "Login Page"), ("C22", None), ("C3", "a.b")],
                               "case_id string, title string")
    ids = lambda cond: sorted(r[0] for r in df.where(cond).collect())
    assert ids(report.search("LOGIN")) == ["C1"]
    assert ids(report.search("c2+")) == ["C22"]
    assert ids(report.search("a.b")) == ["C3"]
    assert ids(report.search(".", literal=True)) == ["C3"]
    assert report.search("") is None


def test_compat_breakdown_matches_the_text_rule_on_random_remarks(spark):
    """G4/F4 (compat): counts equal the rule stated plainly -- split on ';', strip (Python
    whitespace), drop blanks, the part before the first ' = ', 'Priority/Risk' for a remark
    starting with 'priority' (any case), else the remark itself."""
    import random
    from collections import Counter

    rng = random.Random(4)
    pieces = ["Status = Obsolete", " Testing Phase = ", "Priority/Risk is null", "PRIORITY x",
              "Testing Type = web = x", "  ", "", "odd remark", " Status = New",
              "Automatability = None", "a=b", " = lead"]
    remarks = [";".join(rng.choice(pieces) for _ in range(rng.randint(0, 4))) for _ in range(1500)]
    rows = [("Failed", r) for r in remarks] + [("Passed", "Status = Obsolete")] * 5 + [("Failed", None)]
    df = spark.createDataFrame(rows, "verdict string, remarks string")
    got = {r["criterion"]: r["failed_cases"] for r in
           report.failure_breakdown(df, compat=True).collect()}
    want = Counter()
    for v, rem in rows:
        if v != "Failed":
            continue
        for part in (rem or "").split(";"):
            part = part.strip()
            if not part:
                continue
            if " = " in part:
                want[part.split(" = ", 1)[0].strip()] += 1
            elif part.lower().startswith("priority"):
                want["Priority/Risk"] += 1
            else:
                want[part] += 1
    assert got == dict(want)
