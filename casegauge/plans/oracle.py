"""Independent DuckDB SQL for each catalogue query (views: the driver tables).

The SQL restates each derivation and operator directly (CASE/VALUES/joins/window
functions) rather than calling this package, so it checks the Spark plans from outside.
"""

from __future__ import annotations

# --- Fixed values: code labels, and the codes that pass each rule (stated here anew, so that a
# wrong entry in the operators shows). ---
AUTOMATABILITY = {1: "Automated", 2: "Automatable", 3: "Non-Automatable", 4: "To be Determined",
                  5: "For Migration"}
AUTOMATION_STATUS = {1: "Not Started", 2: "In Progress", 3: "Blocked Test Data",
                     4: "Blocked Incomplete Steps", 5: "Blocked Access Issues", 6: "Obsolete",
                     7: "Blocked Feature Issue", 8: "Blocked Others", 9: "Reviewed = Passed DOR",
                     10: "Completed", 11: "None"}
TESTING_TYPE = {1: "api", 2: "api-and-database", 3: "api-and-mobile", 4: "api-and-logs-checking",
                5: "api-and-sms", 6: "api-and-web", 7: "database", 8: "database-and-logs-checking",
                9: "database-and-sms", 10: "logs-checking", 11: "mobile", 12: "mobile-and-database",
                13: "mobile-and-logs-checking", 14: "mobile-and-sms", 15: "sms",
                16: "sms-and-logs-checking", 17: "web", 18: "web-and-database",
                19: "web-and-logs-checking", 20: "web-and-mobile", 21: "web-and-sms"}
STATUS = {2: "New", 3: "Reviewed", 4: "Obsolete", 5: "Inactive", 6: "Active"}
TESTING_PHASE = {1: "BE Regression", 2: "FE Regression", 3: "FVT", 4: "FE Sanity", 5: "BE Sanity",
                 6: "Pre-Test", 7: "Post-Test", 8: "Cleanpass Project", 9: "Sprint Testing",
                 10: "Sanity", 11: "Smoke", 12: "Regression"}
PASSING = {"Automatability": (2, 4), "Testing Type": (17,), "Automation Status": (1, 9),
           "Status": (2, 3, 6), "Testing Phase": (1, 2, 12)}
# --- end of fixed values ---

SQL: dict[str, str] = {}


def _values(mapping: dict[int, str]) -> str:
    rows = ", ".join(f"({k}, '{v}')" for k, v in sorted(mapping.items()))
    return f"(VALUES {rows})"


def _map(mapping: dict[int, str]) -> str:
    return "MAP {" + ", ".join(f"{k}: '{v}'" for k, v in sorted(mapping.items())) + "}"


def _ids(rule_name: str) -> str:
    return ", ".join(str(i) for i in PASSING[rule_name])


CASES_RAW = """
cases_raw AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
         ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS priority_id,
    CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 7 ELSE 2 END AS INT) AS aut,
    CAST(CASE WHEN o_orderkey % 6 = 0 THEN o_custkey % 12 ELSE 1 END AS INT) AS ast,
    CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 23 ELSE 17 END AS INT) AS tt,
    CAST(CASE o_orderstatus WHEN 'F' THEN 6 WHEN 'O' THEN 2 ELSE 1 + o_custkey % 6 END AS INT) AS st,
    CASE o_orderkey % 8 WHEN 0 THEN []::INT[] WHEN 1 THEN NULL WHEN 2 THEN [3, 4]
         WHEN 3 THEN [99] WHEN 4 THEN [12] WHEN 5 THEN [2, 5] ELSE [1, 3] END AS phases
  FROM orders
)"""

DECODED = f""",
decoded AS (
  SELECT c.*, a.label AS aut_l, s.label AS ast_l, t.label AS tt_l, u.label AS st_l,
    array_to_string(list_transform(coalesce(phases, []::INT[]),
      lambda p: coalesce({_map(TESTING_PHASE)}[p], CAST(p AS VARCHAR))), ', ') AS phase_l,
    coalesce(list_bool_or(list_transform(coalesce(phases, []::INT[]),
      lambda p: p IN ({_ids('Testing Phase')}))), false) AS ok_ph
  FROM cases_raw c
  LEFT JOIN {_values(AUTOMATABILITY)} a(id, label) ON a.id = c.aut
  LEFT JOIN {_values(AUTOMATION_STATUS)} s(id, label) ON s.id = c.ast
  LEFT JOIN {_values(TESTING_TYPE)} t(id, label) ON t.id = c.tt
  LEFT JOIN {_values(STATUS)} u(id, label) ON u.id = c.st
),
screen AS (
  SELECT *,
    coalesce(aut IN ({_ids('Automatability')}), false) AS ok_aut,
    coalesce(tt IN ({_ids('Testing Type')}), false) AS ok_tt,
    coalesce(ast IN ({_ids('Automation Status')}), false) AS ok_ast,
    coalesce(st IN ({_ids('Status')}), false) AS ok_st,
    priority_id IS NOT NULL AS ok_pr
  FROM decoded
),
evaluated AS (
  SELECT *,
    concat_ws('; ',
      CASE WHEN NOT ok_aut THEN 'Automatability = ' || coalesce(aut_l, 'None') END,
      CASE WHEN NOT ok_tt THEN 'Testing Type = ' || coalesce(tt_l, 'None') END,
      CASE WHEN NOT ok_ast THEN 'Automation Status = ' || coalesce(ast_l, 'None') END,
      CASE WHEN NOT ok_st THEN 'Status = ' || coalesce(st_l, 'None') END,
      CASE WHEN NOT ok_pr THEN 'Priority/Risk is null' END,
      CASE WHEN NOT ok_ph THEN 'Testing Phase = ' || phase_l END) AS remarks,
    CASE WHEN ok_aut AND ok_tt AND ok_ast AND ok_st AND ok_pr AND ok_ph
         THEN 'Passed' ELSE 'Failed' END AS verdict
  FROM screen
)"""

SCREEN = CASES_RAW + DECODED

SQL["standards_eval"] = f"""
WITH {SCREEN}
SELECT verdict AS "General Standards", remarks AS "Remarks", 'C' || CAST(id AS VARCHAR) AS "Test Case ID",
  priority_id AS "Priority", aut_l AS "Automatability", ast_l AS "Automation Status",
  tt_l AS "Testing Type", st_l AS "Status", phase_l AS "Testing Phase"
FROM evaluated
"""

SQL["failure_breakdown"] = f"""
WITH {SCREEN},
flags AS (
  SELECT 'Automatability' AS criterion, NOT ok_aut AS bad FROM screen
  UNION ALL SELECT 'Testing Type', NOT ok_tt FROM screen
  UNION ALL SELECT 'Automation Status', NOT ok_ast FROM screen
  UNION ALL SELECT 'Status', NOT ok_st FROM screen
  UNION ALL SELECT 'Priority/Risk', NOT ok_pr FROM screen
  UNION ALL SELECT 'Testing Phase', NOT ok_ph FROM screen
)
SELECT criterion, CAST(count(*) AS BIGINT) AS failed_cases
FROM flags WHERE bad GROUP BY criterion ORDER BY failed_cases DESC, criterion
"""

SQL["passed_ordered"] = f"""
WITH {SCREEN}
SELECT 'C' || CAST(id AS VARCHAR) AS "Test Case ID", verdict AS "General Standards",
  priority_id AS "Priority"
FROM evaluated WHERE verdict = 'Passed' ORDER BY 1
"""

SQL["failure_breakdown_compat"] = f"""
WITH {SCREEN},
parts AS (
  SELECT trim(unnest(string_split(remarks, ';'))) AS part FROM evaluated WHERE verdict = 'Failed'
)
SELECT CASE WHEN contains(part, ' = ') THEN trim(split_part(part, ' = ', 1))
            WHEN starts_with(lower(part), 'priority') THEN 'Priority/Risk'
            ELSE part END AS criterion,
       CAST(count(*) AS BIGINT) AS failed_cases
FROM parts WHERE part <> '' GROUP BY 1 ORDER BY failed_cases DESC, criterion
"""

SQL["report_totals"] = f"""
WITH {SCREEN}
SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(count_if(verdict = 'Passed') AS BIGINT) AS passed,
  CAST(count(*) - count_if(verdict = 'Passed') AS BIGINT) AS failed,
  round(CAST(count_if(verdict = 'Passed') AS DOUBLE) / count(*), 6) AS pass_rate,
  printf('%d%%', CAST(round_even(100.0 * count_if(verdict = 'Passed') / count(*), 0) AS BIGINT)) AS pass_rate_text
FROM evaluated
"""

# ------------------------------------------------------------------ store & reports ----

STORE = """
cases AS (
  SELECT c_custkey AS case_id, c_name AS title, r_name AS tribe, n_name AS product,
         concat_ws('/', n_name, c_mktsegment) AS capability
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
scores AS (
  SELECT event_id AS score_id, user_id AS case_id, strftime(ts, '%Y-%m-%d') AS run_id,
    CASE WHEN event_type = 'purchase' THEN 'Passed'
         WHEN event_type IN ('view', 'click') THEN 'Needs Improvement'
         WHEN event_type = 'signup' THEN 'Failed' END AS verdict,
    CASE WHEN event_type <> 'error' THEN value >= 5 END AS preconditions_passed,
    CASE WHEN event_type <> 'error' THEN value >= 10 END AS test_steps_passed,
    CASE WHEN event_type <> 'error' THEN value >= 2 END AS expected_results_passed,
    ts AS validated_at
  FROM events
),
runs AS (
  SELECT run_id, 'rule-screen' AS provider, 'standards-v1' AS model,
         count(*) AS total_cases, min(validated_at) AS run_at
  FROM scores GROUP BY run_id
),
latest AS (
  SELECT * FROM scores WHERE validated_at IS NOT NULL
  QUALIFY rank() OVER (PARTITION BY case_id ORDER BY validated_at DESC) = 1
),
view AS (
  SELECT c.*, l.score_id, l.run_id, l.verdict, l.preconditions_passed, l.test_steps_passed,
         l.expected_results_passed, l.validated_at, r.provider, r.model,
         l.case_id IS NULL AS never_scored
  FROM cases c LEFT JOIN latest l ON c.case_id = l.case_id
  LEFT JOIN runs r ON l.run_id = r.run_id
),
counters AS (
  SELECT r.run_id, r.provider, r.model, r.total_cases,
    CAST(count_if(s.verdict = 'Passed') AS BIGINT) AS passed_count,
    CAST(count_if(s.verdict = 'Needs Improvement') AS BIGINT) AS needs_improvement_count,
    CAST(count_if(s.verdict = 'Failed') AS BIGINT) AS failed_count,
    CAST(count_if(s.score_id IS NOT NULL AND s.verdict IS NULL) AS BIGINT) AS error_count,
    r.run_at
  FROM runs r LEFT JOIN scores s ON s.run_id = r.run_id
  GROUP BY r.run_id, r.provider, r.model, r.total_cases, r.run_at
)"""

SQL["verdict_frequency"] = f"""
WITH {STORE}
SELECT verdict, count(*) AS n FROM scores WHERE verdict IS NOT NULL
GROUP BY verdict ORDER BY n DESC, verdict
"""

SQL["verdict_counters"] = f"""
WITH {STORE}
SELECT count(*) AS total,
  CAST(count_if(verdict = 'Passed') AS BIGINT) AS passed,
  CAST(count_if(verdict = 'Needs Improvement') AS BIGINT) AS needs_improvement,
  CAST(count_if(verdict = 'Failed') AS BIGINT) AS failed,
  CAST(count_if(verdict IS NULL) AS BIGINT) AS errors,
  CAST(count_if(never_scored) AS BIGINT) AS never_scored
FROM view
"""

SQL["run_counters"] = f"WITH {STORE} SELECT * FROM counters"

SQL["latest_per_case"] = f"WITH {STORE} SELECT * FROM latest"

SQL["latest_with_ties"] = """
SELECT a.o_custkey, a.o_orderkey, a.o_orderdate FROM orders a
JOIN (SELECT o_custkey, max(o_orderdate) AS m FROM orders GROUP BY o_custkey) b
  ON a.o_custkey = b.o_custkey AND a.o_orderdate = b.m
"""

SQL["latest_dedup"] = """
SELECT o_custkey, max(o_orderkey) AS o_orderkey, o_orderdate FROM orders a
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders b WHERE b.o_custkey = a.o_custkey)
GROUP BY o_custkey, o_orderdate
"""

SQL["cases_with_latest"] = f"WITH {STORE} SELECT * FROM view ORDER BY case_id"

SQL["case_history"] = f"""
WITH {STORE}
SELECT s.*, r.provider, r.model FROM scores s JOIN runs r ON s.run_id = r.run_id
ORDER BY s.case_id, s.validated_at DESC, s.score_id DESC
"""

SQL["case_point_history"] = f"""
WITH {STORE}
SELECT s.*, r.provider, r.model FROM scores s JOIN runs r ON s.run_id = r.run_id
WHERE s.case_id = (SELECT case_id FROM scores GROUP BY case_id ORDER BY count(*) DESC, case_id LIMIT 1)
ORDER BY s.validated_at DESC, s.score_id DESC
"""

SQL["completed_in_run"] = f"""
WITH {STORE}
SELECT DISTINCT case_id FROM scores WHERE run_id = (SELECT max(run_id) FROM scores)
"""

SQL["store_save_run"] = f"""
WITH {STORE},
newest AS (SELECT max(run_id) AS run_id FROM scores),
touched AS (SELECT DISTINCT case_id FROM scores WHERE run_id = (SELECT run_id FROM newest)),
saved AS (
  SELECT case_id, case_id IN (SELECT case_id FROM touched) AS again, title, tribe, product, capability
  FROM cases)
SELECT 'records' AS part, CAST(case_id AS VARCHAR) AS id, concat_ws('|',
  CASE WHEN again THEN title || ' v2' ELSE title END, CASE WHEN again THEN '-' ELSE tribe END,
  product, capability) AS content
FROM saved
UNION ALL
SELECT 'runs', run_id, concat_ws('|', provider,
  CASE WHEN run_id = (SELECT run_id FROM newest) THEN model ELSE 'standards-v0' END, total_cases,
  strftime(run_at, '%Y-%m-%d %H:%M:%S'))
FROM runs
UNION ALL
SELECT 'scores', CAST(score_id AS VARCHAR), concat_ws('|', case_id, run_id, coalesce(verdict, '-'),
  coalesce(CAST(preconditions_passed AS VARCHAR), '-'), coalesce(CAST(test_steps_passed AS VARCHAR), '-'),
  coalesce(CAST(expected_results_passed AS VARCHAR), '-'), strftime(validated_at, '%Y-%m-%d %H:%M:%S'))
FROM scores
"""

SQL["current_scores"] = SQL["latest_per_case"]

SQL["report_positions"] = f"""
WITH {SCREEN},
shown AS (SELECT 'C' || CAST(id AS VARCHAR) AS id, verdict FROM evaluated)
SELECT id AS "Test Case ID", verdict AS "General Standards",
  row_number() OVER (ORDER BY CASE WHEN verdict = 'Passed' THEN 0 ELSE 1 END, id) AS position
FROM shown
"""

SQL["filtered_values"] = f"""
WITH {STORE}
SELECT case_id, product, never_scored FROM view WHERE tribe = 'EUROPE' AND verdict IS NULL
"""

SQL["dictionary_decode"] = """
SELECT c_custkey, c_nationkey, n_name AS nation
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
"""

SQL["reverse_lookup"] = """
SELECT c_custkey, CAST(c_nationkey AS INTEGER) AS id FROM customer
WHERE c_nationkey = (SELECT min(n_nationkey) FROM nation WHERE lower(n_name) = 'nation_7')
"""

SQL["runs_newest_first"] = f"WITH {STORE} SELECT * FROM counters ORDER BY run_at DESC, run_id"

SQL["facets"] = f"""
WITH {STORE}
SELECT DISTINCT * FROM (
  SELECT 'tribe' AS facet, tribe AS value FROM view WHERE tribe IS NOT NULL
  UNION ALL SELECT 'product', product FROM view WHERE product IS NOT NULL
  UNION ALL SELECT 'capability', capability FROM view WHERE capability IS NOT NULL)
ORDER BY facet, value
"""

SQL["date_extent"] = f"""
WITH {STORE}
SELECT coalesce(min(CAST(validated_at AS DATE)), current_date - 365) AS min_date,
       coalesce(max(CAST(validated_at AS DATE)), current_date) AS max_date
FROM view
"""

SQL["date_extent_fallback"] = f"""
WITH {STORE}
SELECT coalesce(min(CAST(validated_at AS DATE)), DATE '2024-06-01' - 365) AS min_date,
       coalesce(max(CAST(validated_at AS DATE)), DATE '2024-06-01') AS max_date
FROM view WHERE never_scored
"""

SQL["empty_store"] = f"""
WITH {STORE}
SELECT case_id, title, CAST(NULL AS VARCHAR) AS verdict, CAST(NULL AS VARCHAR) AS provider,
  true AS never_scored FROM cases
"""

SQL["filtered_export"] = f"""
WITH {STORE}
SELECT CAST(case_id AS VARCHAR) AS case_id, title, capability, verdict, run_id
FROM view WHERE verdict = 'Failed'
"""

SQL["filtered_view"] = f"""
WITH {STORE}
SELECT case_id, title, tribe, product, capability, verdict, validated_at FROM view
WHERE verdict = 'Needs Improvement'
  AND CAST(validated_at AS DATE) BETWEEN DATE '2024-01-20' AND DATE '2024-01-31'
  AND (regexp_matches(lower(coalesce(title, '')), 'customer#0+1')
       OR regexp_matches(lower(CAST(case_id AS VARCHAR)), 'customer#0+1'))
"""

SQL["display_labels"] = f"""
WITH {STORE}
SELECT case_id,
  CASE verdict WHEN 'Passed' THEN '✅ Passed' WHEN 'Needs Improvement' THEN '🔧 Needs Improvement'
       WHEN 'Failed' THEN '❌ Failed' ELSE '⚠️ Error' END AS verdict_label,
  CASE WHEN preconditions_passed IS NULL THEN '⚠️ Error' WHEN preconditions_passed THEN '✅ Pass' ELSE '❌ Fail' END AS preconditions_label,
  CASE WHEN test_steps_passed IS NULL THEN '⚠️ Error' WHEN test_steps_passed THEN '✅ Pass' ELSE '❌ Fail' END AS test_steps_label,
  CASE WHEN expected_results_passed IS NULL THEN '⚠️ Error' WHEN expected_results_passed THEN '✅ Pass' ELSE '❌ Fail' END AS expected_results_label,
  coalesce(nullif(provider, ''), '—') AS provider_label
FROM view
"""

SNAPSHOTS = """
old AS (
  SELECT c_custkey AS case_id, c_name AS title, c_mktsegment AS capability,
         '2024-01-01T00:00:00+00:00' AS first_seen_at, '2024-01-01T00:00:00+00:00' AS last_updated_at
  FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
),
new AS (
  SELECT c_custkey AS case_id, c_name || ' v2' AS title,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS capability,
         '2024-02-01T00:00:00+00:00' AS first_seen_at, '2024-02-01T00:00:00+00:00' AS last_updated_at
  FROM customer WHERE c_mktsegment IN ('FURNITURE', 'HOUSEHOLD', 'MACHINERY')
)"""

SQL["upsert_cases"] = f"""
WITH {SNAPSHOTS}
SELECT coalesce(n.case_id, o.case_id) AS case_id,
  CASE WHEN n.case_id IS NOT NULL THEN n.title ELSE o.title END AS title,
  CASE WHEN n.case_id IS NOT NULL THEN n.capability ELSE o.capability END AS capability,
  coalesce(o.first_seen_at, n.first_seen_at) AS first_seen_at,
  CASE WHEN n.case_id IS NOT NULL THEN n.last_updated_at ELSE o.last_updated_at END AS last_updated_at
FROM old o FULL OUTER JOIN new n ON o.case_id = n.case_id
"""

SQL["bucket_upsert"] = SQL["upsert_cases"]

RUN_SNAPSHOTS = f"""
{STORE},
old_runs AS (
  SELECT run_id, 'rule-screen' AS provider, 'standards-v1' AS model, count(*) AS total_cases,
         min(validated_at) AS run_at
  FROM scores WHERE day(validated_at) <= 20 GROUP BY run_id
),
new_runs AS (
  SELECT run_id, 'rule-screen' AS provider, 'standards-v2' AS model, count(*) AS total_cases,
         min(validated_at) AS run_at
  FROM scores WHERE day(validated_at) >= 15 GROUP BY run_id
)"""

SQL["insert_if_absent"] = f"""
WITH {RUN_SNAPSHOTS}
SELECT * FROM old_runs
UNION ALL SELECT * FROM new_runs WHERE run_id NOT IN (SELECT run_id FROM old_runs)
"""

SQL["replace_run"] = f"""
WITH {RUN_SNAPSHOTS}
SELECT * FROM old_runs WHERE run_id NOT IN (SELECT run_id FROM new_runs)
UNION ALL SELECT * FROM new_runs
"""

SQL["orphans"] = f"""
WITH {RUN_SNAPSHOTS}, {SNAPSHOTS.strip()}
SELECT score_id, case_id, run_id, 'unknown record' AS reason FROM scores
WHERE case_id NOT IN (SELECT case_id FROM old)
UNION ALL
SELECT score_id, case_id, run_id, 'unknown run' FROM scores
WHERE run_id NOT IN (SELECT run_id FROM old_runs)
"""

SQL["resume_remaining"] = """
SELECT doc_id, lang, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""

# ------------------------------------------------------------------ text & scoring -----

from casegauge.functions import html as _h  # noqa: E402
from casegauge.functions import text as _t  # noqa: E402
from casegauge.operators import score as _s  # noqa: E402


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _unescape(x: str) -> str:
    for ent, ch in _h.ENTITIES:
        x = f"replace({x}, {_q(ent)}, {_q(ch)})"
        if (ent, ch) in _h.LEGACY_ENTITIES:
            # the name without ';' before a non-alphanumeric character or the node's end;
            # applied twice so that two such entities in a row are both decoded
            for _ in range(2):
                x = (f"regexp_replace({x}, {_q(ent[:-1] + '([^-.A-Za-z0-9]|$)')}, "
                     f"{_q(ch + chr(92) + '1')}, 'g')")
    return x


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {_q(_h.STRIP_RE)}, '', 'g')"


def _nodes(x: str) -> str:
    parts = f"string_split(regexp_replace({x}, {_q(_h.TAG_RE)}, chr(1), 'g'), chr(1))"
    return (f"list_filter(list_transform({parts}, lambda p: {_strip(_unescape('p'))}), "
            f"lambda p: p <> '')")


CLEAN_PAGES = f"""
cleaned AS (
  SELECT page_id, regexp_replace(coalesce(html, ''), {_q(_h.REMOVED_RE)}, chr(1), 'g') AS h
  FROM pages
)"""

SQL["html_text"] = f"""
WITH {CLEAN_PAGES}
SELECT page_id, array_to_string({_nodes('h')}, chr(10)) AS text FROM cleaned
"""

SQL["numbered_list"] = f"""
WITH {CLEAN_PAGES}
SELECT page_id, array_to_string(list_transform(regexp_extract_all(h, {_q(_h.LI_RE)}, 1),
    lambda x, i: CAST(i AS VARCHAR) || '. ' || array_to_string({_nodes('x')}, ' ')), chr(10)) AS items
FROM cleaned
"""

SQL["screen_full"] = f"""
WITH cases_raw AS (
  SELECT page_id AS id, url, html,
    CASE WHEN page_id % 9 <> 0 THEN CAST(1 + page_id % 4 AS INT) END AS priority_id,
    CAST(CASE WHEN page_id % 4 = 0 THEN page_id % 7 ELSE 2 END AS INT) AS aut,
    CAST(CASE WHEN page_id % 6 = 0 THEN page_id % 12 ELSE 1 END AS INT) AS ast,
    CAST(CASE WHEN page_id % 5 = 0 THEN page_id % 23 ELSE 17 END AS INT) AS tt,
    CAST(CASE WHEN page_id % 7 = 0 THEN 1 + page_id % 6 ELSE 2 END AS INT) AS st,
    CASE page_id % 8 WHEN 0 THEN []::INT[] WHEN 1 THEN NULL WHEN 2 THEN [3, 4]
         WHEN 3 THEN [99] ELSE [1, 12] END AS phases
  FROM pages
){DECODED},
cleaned AS (
  SELECT e.*, n.n_name AS tribe, lower(p.n_name) AS product, r.r_name AS capability,
    regexp_replace(coalesce(html, ''), {_q(_h.REMOVED_RE)}, chr(1), 'g') AS h
  FROM evaluated e LEFT JOIN nation n ON n.n_nationkey = id % 30
  LEFT JOIN nation p ON p.n_nationkey = id % 26
  LEFT JOIN region r ON id % 3 <> 0 AND r.r_regionkey = id % 5
)
SELECT verdict AS "General Standards", remarks AS "Remarks", 'C' || CAST(id AS VARCHAR) AS "Test Case ID",
  url AS "Title", array_to_string({_nodes('h')}, chr(10)) AS "Project Initiative",
  tribe AS "Tribe", product AS "Product", capability AS "Capability", priority_id AS "Priority",
  aut_l AS "Automatability", ast_l AS "Automation Status", tt_l AS "Testing Type",
  st_l AS "Status", phase_l AS "Testing Phase",
  array_to_string(list_transform(regexp_extract_all(h, {_q(_h.LI_RE)}, 1),
    lambda x, i: CAST(i AS VARCHAR) || '. ' || array_to_string({_nodes('x')}, ' ')), chr(10)) AS "Pre Conditions",
  "Pre Conditions" AS "Test Steps",
  array_to_string({_nodes("(h || chr(10) || 'Shown')")}, chr(10)) AS "Expected Result"
FROM cleaned
"""

SQL["endpoint_file"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS "ID",
  CASE WHEN c_acctbal >= 0 THEN {_q(_t.DEFAULT_API_BASE)} || regexp_replace(c_name, '[^0-9]', '', 'g') END AS endpoint,
  CASE WHEN c_acctbal < 0 THEN 'https://cases.example.com/' END AS link
FROM customer
"""

SQL["endpoint_from_link"] = f"""
SELECT page_id, nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS record_id,
  {_q(_t.DEFAULT_API_BASE)} || nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS endpoint,
  CASE WHEN nullif(regexp_extract(url, '/([0-9]+)', 1), '') IS NULL THEN 'rejected' ELSE 'ok' END AS status
FROM pages
"""

SQL["link_builder"] = f"""
SELECT c_custkey, c_name AS "ID",
  CASE WHEN regexp_replace(c_name, '[^\\p{{Nd}}]', '', 'g') <> ''
       THEN {_q(_t.DEFAULT_VIEW_BASE)} || regexp_replace(c_name, '[^\\p{{Nd}}]', '', 'g') ELSE '' END AS link
FROM customer
"""

SQL["steps_join"] = """
SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) AS steps,
       string_agg(coalesce(role, ''), chr(10) ORDER BY turn) AS expected
FROM conversations GROUP BY conv_id
"""

SQL["json_result_parse"] = f"""
WITH b AS (
  SELECT event_id, 'C' || CAST(user_id AS VARCHAR) AS request_id,
    '{{"test_case_id": "C' || CAST(user_id AS VARCHAR) ||
    '", "preconditions": {{"passed": ' || CASE WHEN value >= 5 THEN 'true' ELSE 'false' END ||
    ', "remarks": ""}}, "test_steps": {{"passed": ' || CASE WHEN value >= 10 THEN 'true' ELSE 'false' END ||
    ', "remarks": "steps"}}, "expected_results": {{"passed": ' || CASE WHEN value >= 2 THEN 'true' ELSE 'false' END ||
    ', "remarks": ""}}, ' ||
    CASE WHEN event_type = 'purchase' THEN '"verdict": "Passed", '
         WHEN event_type IN ('view', 'click') THEN '"verdict": "Needs Improvement", '
         WHEN event_type = 'signup' THEN '"verdict": "Failed", '
         WHEN value >= 20 THEN '"verdict": "Maybe", ' ELSE '' END ||
    '"overall_remarks": "event ' || event_type || '", "improvements": "", "context": ' || props || '}}' AS body
  FROM events
),
r AS (
  SELECT event_id, request_id,
    CASE event_id % 4
      WHEN 0 THEN '```json' || chr(10) || body || chr(10) || '```'
      WHEN 1 THEN 'Here is my evaluation:' || chr(10) || '```' || chr(10) || body || chr(10) || '```' || chr(10) || 'Done.'
      WHEN 2 THEN 'Result: ' || body || ' -- end'
      ELSE 'I could not evaluate this case.' END AS reply
  FROM b
),
j AS (
  SELECT event_id, request_id,
    coalesce(nullif(regexp_extract(reply, {_q(_t.FENCED_JSON_RE)}, 1), ''),
             nullif(regexp_extract(reply, {_q(_t.BRACED_JSON_RE)}, 0), '')) AS js
  FROM r
),
p AS (
  SELECT event_id, js,
    CASE WHEN json_exists(js, '$.verdict') THEN json_extract_string(js, '$.verdict') ELSE 'Failed' END AS verdict,
    CASE WHEN json_exists(js, '$.test_case_id') THEN json_extract_string(js, '$.test_case_id') ELSE request_id END AS tcid,
    CASE WHEN json_exists(js, '$.overall_remarks') THEN json_extract_string(js, '$.overall_remarks') ELSE '' END AS overall,
    CASE WHEN json_exists(js, '$.improvements') THEN json_extract_string(js, '$.improvements') ELSE '' END AS impr,
    TRY_CAST(json_extract_string(js, '$.preconditions.passed') AS BOOLEAN) AS pre_p,
    json_extract_string(js, '$.preconditions.remarks') AS pre_r,
    TRY_CAST(json_extract_string(js, '$.test_steps.passed') AS BOOLEAN) AS st_p,
    json_extract_string(js, '$.test_steps.remarks') AS st_r,
    TRY_CAST(json_extract_string(js, '$.expected_results.passed') AS BOOLEAN) AS ex_p,
    json_extract_string(js, '$.expected_results.remarks') AS ex_r
  FROM j WHERE js IS NOT NULL AND json_valid(js)
),
v AS (
  SELECT j.event_id, p.*,
    coalesce(p.verdict IN ('Passed', 'Needs Improvement', 'Failed')
      AND pre_p IS NOT NULL AND pre_r IS NOT NULL AND st_p IS NOT NULL AND st_r IS NOT NULL
      AND ex_p IS NOT NULL AND ex_r IS NOT NULL AND overall IS NOT NULL AND impr IS NOT NULL
      AND tcid IS NOT NULL, false) AS ok
  FROM j LEFT JOIN p ON j.event_id = p.event_id
)
SELECT event_id, ok AS is_valid,
  CASE WHEN ok THEN tcid END AS test_case_id, CASE WHEN ok THEN verdict END AS verdict,
  CASE WHEN ok THEN pre_p END AS preconditions_passed, CASE WHEN ok THEN st_p END AS test_steps_passed,
  CASE WHEN ok THEN ex_p END AS expected_results_passed, CASE WHEN ok THEN overall END AS overall_remarks
FROM v
"""

SQL["legacy_upgrade"] = """
SELECT 'D' || CAST(d.doc_id AS VARCHAR) AS test_case_id,
  CASE WHEN l.quality = 1 THEN 'Passed' WHEN l.quality IS NOT NULL THEN 'Failed' END AS verdict,
  CASE WHEN l.toxic = 1 THEN 'flagged as toxic' WHEN l.toxic = 0 THEN '' END AS overall_remarks,
  '' AS improvements,
  CAST(l.quality = 1 AS INT) AS overall_passed_int
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

DOC_CASES = """
doc_lines AS (
  SELECT doc_id, lang, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
doc_cases AS (
  SELECT doc_id AS case_id, concat_ws('/', lang, source) AS title, lines[1] AS pre_conditions,
    CASE WHEN len(lines) >= 3 THEN array_to_string(lines[2:len(lines) - 1], chr(10)) ELSE '' END AS test_steps,
    CASE WHEN len(lines) >= 2 THEN lines[len(lines)] ELSE '' END AS expected_result
  FROM doc_lines
)"""

# The expected vocabulary of the deterministic screen, stated here on its own.
X2_URL_RE = "https?://"
X2_CREDENTIAL_RE = "(^|[^a-z])(username|password|login|credential|account|role|user)([^a-z]|$)"
X2_ENVIRONMENT_RE = "(^|[^a-z])(sit|uat|staging|prod|production|environment)([^a-z]|$)"
X2_IMPERATIVE_RE = ("^(open|click|enter|type|select|navigate|go|verify|check|input|fill|submit|press|"
                    "login|log|tap|choose|upload|download|scroll|wait|launch|close|insert)([^a-z]|$)")
X2_INPUT_RE = "^(enter|type|input|fill|insert)([^a-z]|$)"
X2_COMPOUND_RE = "(^|[^a-z])(then|and then)([^a-z]|$)"
X2_DATA_RE = "[\"'0-9]"

SQL["rule_screen"] = f"""
WITH {DOC_CASES},
parts AS (
  SELECT case_id, title, lower(coalesce(pre_conditions, '')) AS p,
    list_filter(list_transform(string_split(coalesce(test_steps, ''), chr(10)),
      lambda s: {_strip("regexp_replace(" + _strip('s') + ", '^[0-9]+[.][ \\t]*', '')")}), lambda s: s <> '') AS step_lines,
    {_strip("coalesce(expected_result, '')")} AS e
  FROM doc_cases
),
low AS (
  SELECT *, list_transform(step_lines, lambda s: lower({_strip('s')})) AS low_steps FROM parts
),
f AS (
  SELECT case_id, title,
    regexp_matches(p, {_q(X2_URL_RE)}) OR regexp_matches(coalesce(low_steps[1], ''), {_q(X2_URL_RE)}) AS has_url,
    regexp_matches(p, {_q(X2_CREDENTIAL_RE)}) AS has_cred,
    regexp_matches(p, {_q(X2_ENVIRONMENT_RE)}) AS env_word,
    len(step_lines) > 0 AS has_steps,
    coalesce(list_bool_and(list_transform(low_steps, lambda s: regexp_matches(s, {_q(X2_IMPERATIVE_RE)}))), true) AS imperative,
    coalesce(list_bool_and(list_transform(low_steps, lambda s: NOT regexp_matches(s, {_q(X2_COMPOUND_RE)}))), true) AS atomic,
    coalesce(list_bool_and(list_transform(low_steps, lambda s: NOT regexp_matches(s, {_q(X2_INPUT_RE)})
                                                   OR regexp_matches(s, {_q(X2_DATA_RE)}))), true) AS with_data,
    e <> '' AS has_expected
  FROM low
),
g AS (
  SELECT *, env_word OR has_url AS has_env FROM f
),
h AS (
  SELECT *,
    has_url AND has_cred AND has_env AS pre_ok,
    has_steps AND imperative AND atomic AND with_data AS steps_ok,
    concat_ws('; ', CASE WHEN NOT has_url THEN 'URL missing' END,
                    CASE WHEN NOT has_cred THEN 'credentials missing' END,
                    CASE WHEN NOT has_env THEN 'environment missing' END) AS pre_rm,
    concat_ws('; ', CASE WHEN NOT has_steps THEN 'no test steps' END,
                    CASE WHEN has_steps AND NOT imperative THEN 'steps not imperative' END,
                    CASE WHEN has_steps AND NOT atomic THEN 'steps not atomic' END,
                    CASE WHEN has_steps AND NOT with_data THEN 'input steps lack data' END) AS steps_rm,
    CASE WHEN NOT has_expected THEN 'expected result missing' ELSE '' END AS exp_rm
  FROM g
),
k AS (
  SELECT *,
    CASE WHEN pre_ok AND steps_ok AND has_expected THEN 'Passed'
         WHEN (NOT has_url AND NOT has_cred) OR NOT has_steps OR NOT has_expected THEN 'Failed'
         ELSE 'Needs Improvement' END AS verdict,
    concat_ws('; ', nullif(pre_rm, ''), nullif(steps_rm, ''), nullif(exp_rm, '')) AS overall
  FROM h
)
SELECT CAST(case_id AS VARCHAR) AS "Test Case ID", title AS "Title",
  pre_ok AS "Preconditions Passed", pre_rm AS "Preconditions Remarks",
  steps_ok AS "Test Steps Passed", steps_rm AS "Test Steps Remarks",
  has_expected AS "Expected Results Passed", exp_rm AS "Expected Results Remarks",
  verdict AS "Verdict", overall AS "Overall Remarks",
  CASE WHEN verdict = 'Passed' THEN '' ELSE 'Address: ' || overall END AS "Improvements"
FROM k
"""

# numbering the lines changes nothing
SQL["rule_screen_numbered"] = SQL["rule_screen"]

# a resumed run's report is the screen of all documents
SQL["score_resume"] = SQL["rule_screen"]

SQL["run_stamps"] = """
SELECT CAST(doc_id AS VARCHAR) AS case_id, true AS utc, true AS scored, true AS first, true AS last
FROM documents
"""

SQL["rule_screen_titled"] = f"""
WITH plain AS ({SQL["rule_screen"]}),
titled AS (
  SELECT *, regexp_matches(lower(coalesce("Title", '')), '(^|[^a-z])en([^a-z]|$)') AS ok FROM plain
),
joined AS (
  SELECT * EXCLUDE ("Verdict", "Overall Remarks", "Improvements"),
    CASE WHEN "Verdict" = 'Passed' AND NOT ok THEN 'Needs Improvement' ELSE "Verdict" END AS v,
    concat_ws('; ', CASE WHEN NOT ok THEN 'title lacks the platform label' END,
              nullif("Overall Remarks", '')) AS o
  FROM titled
)
SELECT * EXCLUDE (ok, v, o), v AS "Verdict", o AS "Overall Remarks",
  CASE WHEN v = 'Passed' THEN '' ELSE 'Address: ' || o END AS "Improvements"
FROM joined
"""

SQL["prompt_with_standards"] = f"""
WITH {DOC_CASES},
written AS (SELECT string_agg(r_name, chr(10) ORDER BY r_regionkey) || chr(10) AS s FROM region),
f AS (
  SELECT case_id, coalesce(title, '') AS title, split_part(title, '/', 1) AS kind, s,
    coalesce(nullif(pre_conditions, ''), '(empty)') AS p, coalesce(nullif(test_steps, ''), '(empty)') AS t,
    coalesce(nullif(expected_result, ''), '(empty)') AS e
  FROM doc_cases CROSS JOIN written
)
SELECT case_id, array_to_string([
  '## Quality Standards Reference', '', s, '', '---', '', '## Test Case to Evaluate', '',
  '**Test Case ID:** ' || CAST(case_id AS VARCHAR), '**Title:** ' || title,
  '**Testing Type:** ' || kind, '**Testing Phase:** ', '', '**Pre Conditions:**', p, '',
  '**Test Steps:**', t, '', '**Expected Result:**', e, '', '---', '', 'Answer as JSON.'], chr(10)) AS prompt
FROM f
"""

SQL["rules_from_dictionary"] = """
SELECT c_custkey,
  CASE WHEN n_regionkey IN (0, 1, 2) THEN 'Passed' ELSE 'Failed' END AS verdict,
  CASE n_regionkey WHEN 3 THEN 'Status = Obsolete' WHEN 4 THEN 'Status = Inactive' ELSE '' END AS remarks
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

SQL["score_batch"] = f"""
WITH {DOC_CASES},
f AS (
  SELECT case_id, coalesce(pre_conditions, '') <> '' AS a, coalesce(test_steps, '') <> '' AS b,
         coalesce(expected_result, '') <> '' AS c
  FROM doc_cases
),
n AS (SELECT *, CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) AS n FROM f)
SELECT CAST(case_id AS VARCHAR) AS "Test Case ID", CAST(NULL AS VARCHAR) AS "Title",
  a AS "Preconditions Passed", CASE WHEN a THEN '' ELSE 'empty' END AS "Preconditions Remarks",
  b AS "Test Steps Passed", CASE WHEN b THEN '' ELSE 'empty' END AS "Test Steps Remarks",
  c AS "Expected Results Passed", CASE WHEN c THEN '' ELSE 'empty' END AS "Expected Results Remarks",
  CASE n WHEN 3 THEN 'Passed' WHEN 0 THEN 'Failed' ELSE 'Needs Improvement' END AS "Verdict",
  CAST(n AS VARCHAR) || ' of 3 criteria present' AS "Overall Remarks", '' AS "Improvements"
FROM n
"""

# ------------------------------------------------------------------ similar examples ---

SIMILAR = f"""{STORE},
latest1 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY validated_at DESC, score_id DESC) AS rn
                 FROM scores) WHERE rn = 1
),
pool AS (
  SELECT c.case_id, nullif(c.capability, '') AS cap, nullif(c.product, '') AS prod,
         nullif(c.tribe, '') AS trb, l.verdict, md5('seed|' || CAST(c.case_id AS VARCHAR)) AS okey
  FROM cases c JOIN latest1 l ON c.case_id = l.case_id WHERE l.verdict IS NOT NULL
),
rec AS (
  SELECT case_id, nullif(capability, '') AS cap, nullif(product, '') AS prod, nullif(tribe, '') AS trb
  FROM cases
),
cand AS (
  SELECT r.case_id, p.case_id AS example_id, 1 AS level, p.okey, p.verdict
  FROM rec r JOIN pool p ON p.cap = r.cap AND p.case_id <> r.case_id
  UNION ALL
  SELECT r.case_id, p.case_id, 2, p.okey, p.verdict
  FROM rec r JOIN pool p ON p.prod = r.prod AND p.case_id <> r.case_id
  UNION ALL
  SELECT r.case_id, p.case_id, 3, p.okey, p.verdict
  FROM rec r JOIN pool p ON p.trb = r.trb AND p.case_id <> r.case_id
),
dedup AS (
  SELECT case_id, example_id, min(level) AS level, any_value(okey) AS okey, any_value(verdict) AS verdict
  FROM cand GROUP BY case_id, example_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY case_id, level ORDER BY okey, example_id) AS r,
    sum(CASE WHEN level = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY case_id) AS c1,
    sum(CASE WHEN level = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY case_id) AS c2,
    sum(CASE WHEN level = 3 THEN 1 ELSE 0 END) OVER (PARTITION BY case_id) AS c3
  FROM dedup
),
q1 AS (SELECT *, least(c1, 5) AS t1 FROM ranked),
q2 AS (SELECT *, CASE WHEN t1 < 3 THEN least(c2, 5 - t1) ELSE 0 END AS t2 FROM q1),
q3 AS (SELECT *, CASE WHEN t1 + t2 < 3 THEN least(c3, 5 - t1 - t2) ELSE 0 END AS t3 FROM q2),
kept AS (
  SELECT * FROM q3
  WHERE r <= CASE level WHEN 1 THEN t1 WHEN 2 THEN t2 ELSE t3 END
),
examples AS (
  SELECT case_id, example_id, level,
  row_number() OVER (PARTITION BY case_id ORDER BY level, r) AS ordinal, verdict
FROM kept
)"""

SQL["similar_examples"] = f"WITH {SIMILAR} SELECT * FROM examples"


# ------------------------------------------------------------------ streaming ----------

SQL["stream_counters"] = f"""
WITH {STORE}
SELECT run_id,
  CAST(count_if(verdict = 'Passed') AS BIGINT) AS passed_count,
  CAST(count_if(verdict = 'Needs Improvement') AS BIGINT) AS needs_improvement_count,
  CAST(count_if(verdict = 'Failed') AS BIGINT) AS failed_count,
  CAST(count_if(verdict IS NULL) AS BIGINT) AS error_count
FROM scores GROUP BY run_id
"""

SQL["stream_upsert"] = f"WITH {STORE} SELECT * FROM scores"

REPLIES = f"""{RUN_SNAPSHOTS}, {SNAPSHOTS.strip()},
seen AS (
  SELECT score_id, case_id, run_id, verdict, score_id % 97 = 5 AS torn, score_id % 50 = 7 AS odd,
    case_id IN (SELECT case_id FROM old) AS record, run_id IN (SELECT run_id FROM old_runs) AS run
  FROM scores
)"""
SQL["stream_quarantine"] = f"""
WITH {REPLIES}
SELECT score_id, case_id, run_id, verdict, 'stored' AS outcome, CAST(NULL AS VARCHAR) AS line
FROM seen WHERE NOT torn AND record AND run
UNION ALL
SELECT score_id, case_id, run_id, NULL,
  CASE WHEN NOT record THEN 'unknown record' WHEN NOT run THEN 'unknown run'
       ELSE 'reply names another record' END, NULL
FROM seen WHERE NOT torn AND (odd OR NOT record OR NOT run)
UNION ALL
SELECT NULL, NULL, NULL, NULL, 'unreadable line', substr(concat('{{"score_id":', score_id,
  ',"case_id":', case_id, ',"reply_case_id":', case_id + CASE WHEN odd THEN 1 ELSE 0 END), 1, 25)
FROM seen WHERE torn
"""

SQL["stream_readmit"] = f"""
WITH {REPLIES}
SELECT run_id,
  CAST(count_if(verdict = 'Passed') AS BIGINT) AS passed_count,
  CAST(count_if(verdict = 'Needs Improvement') AS BIGINT) AS needs_improvement_count,
  CAST(count_if(verdict = 'Failed') AS BIGINT) AS failed_count,
  CAST(count_if(verdict IS NULL) AS BIGINT) AS error_count
FROM seen WHERE NOT torn AND case_id IN (SELECT c_custkey FROM customer) GROUP BY run_id
"""

SQL["stream_records"] = f"""
WITH {STORE},
res AS (
  SELECT s.score_id, s.case_id, s.validated_at, c.title || ' [' || s.run_id || ']' AS title,
    CASE WHEN s.verdict IS NOT NULL THEN c.tribe END AS tribe, c.product, c.capability
  FROM scores s JOIN cases c ON c.case_id = s.case_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY validated_at DESC, score_id DESC) AS rn,
    min(validated_at) OVER (PARTITION BY case_id) AS first_seen_at,
    max(validated_at) OVER (PARTITION BY case_id) AS last_updated_at
  FROM res
)
SELECT case_id, title, tribe, product, capability, first_seen_at, last_updated_at
FROM ranked WHERE rn = 1
"""

# ------------------------------------------------------------------ ingest & export ----

_EQ = ('"General Standards", "Remarks", "Test Case ID", "Priority", "Automatability", '
       '"Automation Status", "Testing Type", "Status", "Testing Phase"')

SQL["ingest_screen"] = f"""
WITH {SCREEN}
SELECT verdict AS "General Standards", remarks AS "Remarks", 'C' || CAST(id AS VARCHAR) AS "Test Case ID",
  priority_id AS "Priority", aut_l AS "Automatability", ast_l AS "Automation Status",
  tt_l AS "Testing Type", st_l AS "Status", phase_l AS "Testing Phase"
FROM evaluated
WHERE id % 97 <> 5 AND id % 10 <> 9 AND id % 50 <> 7
"""

SQL["ingest_counts"] = """
WITH k AS (
  SELECT o_orderkey % 97 = 5 AS cut, o_orderkey % 10 = 9 AS s404,
         o_orderkey % 10 <> 9 AND o_orderkey % 50 = 7 AS nostatus
  FROM orders
)
-- a line without a status is shorter than the cut, so cutting it leaves it whole
SELECT CAST(count_if(NOT cut AND NOT s404 AND NOT nostatus) AS BIGINT) AS ok,
  CAST(count_if((s404 OR nostatus) AND (NOT cut OR nostatus)) AS BIGINT) AS failed,
  CAST(count_if(cut AND NOT nostatus) AS BIGINT) AS quarantined
FROM k
"""

SQL["ingest_quarantine"] = """
SELECT 'unreadable line' AS reason, CAST(NULL AS VARCHAR) AS "ID",
  substr('{"ID":"' || o_orderkey || '","status_code":'
         || CASE WHEN o_orderkey % 10 = 9 THEN '404' ELSE '200' END || ',"response', 1, 25) AS raw
FROM orders WHERE o_orderkey % 97 = 5 AND NOT (o_orderkey % 10 <> 9 AND o_orderkey % 50 = 7)
UNION ALL
SELECT 'link without an id', CAST(c_custkey AS VARCHAR), 'https://cases.example.com/'
FROM customer WHERE c_acctbal < 0
"""

SQL["fetch_coverage"] = f"""
WITH k AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey % 97 = 5 AS cut, o_orderkey % 10 = 9 AS s404,
         o_orderkey % 10 <> 9 AND o_orderkey % 50 = 7 AS nostatus
  FROM orders
)
-- a torn line is quarantined unless the envelope (no status) is shorter than the cut
SELECT id AS "ID", {_q(_t.DEFAULT_API_BASE)} || id AS endpoint,
  CASE WHEN cut AND NOT nostatus THEN 'not fetched'
       WHEN s404 OR nostatus THEN 'failed' ELSE 'ok' END AS fetch_status
FROM k
"""

SQL["csv_snapshot_roundtrip"] = f"""
WITH {CLEAN_PAGES}
SELECT CAST(page_id AS VARCHAR) AS page_id, array_to_string({_nodes('h')}, chr(10)) AS text FROM cleaned
"""

SQL["few_shot_context"] = f"""
WITH {SIMILAR},
texts AS (
  SELECT c_custkey AS case_id,
    CASE WHEN c_acctbal >= 0 THEN 'Account in segment ' || c_mktsegment END AS pre_conditions,
    CASE WHEN c_acctbal < 1000 THEN '' ELSE '1. Open the account page' || chr(10)
         || '2. Select nation ' || CAST(c_nationkey AS VARCHAR) END AS test_steps,
    CASE WHEN c_mktsegment = 'BUILDING' THEN ''
         ELSE 'Segment ' || c_mktsegment || ' is shown' END AS expected_result
  FROM customer
),
rem AS (
  SELECT event_id AS score_id,
    CASE WHEN event_type = 'error' THEN NULL WHEN value >= 5 THEN ''
         ELSE 'precondition value below 5' END AS preconditions_remarks,
    CASE WHEN event_type = 'error' THEN NULL WHEN value >= 10 THEN ''
         ELSE 'steps value below 10' END AS test_steps_remarks,
    CASE WHEN event_type = 'error' THEN NULL WHEN value >= 2 THEN ''
         ELSE 'expected value below 2' END AS expected_results_remarks,
    CASE WHEN event_type = 'purchase' THEN '' ELSE 'event ' || event_type END AS overall_remarks,
    CASE WHEN event_type = 'signup' THEN 'add the missing steps' END AS improvements
  FROM events
),
blocks AS (
  SELECT e.case_id, e.ordinal,
    concat_ws(chr(10),
      '### Example ' || CAST(e.ordinal AS VARCHAR) || ' — ' || CAST(e.example_id AS VARCHAR)
        || ' [' || upper(coalesce(nullif(e.verdict, ''), 'ERROR')) || ']  _(context: '
        || coalesce(nullif(c.capability, ''), nullif(c.product, ''), nullif(c.tribe, ''), '') || ')_',
      '**Title:** ' || coalesce(c.title, 'None'),
      '',
      '**Pre Conditions:**', coalesce(nullif(x.pre_conditions, ''), '(empty)'),
      '',
      '**Test Steps:**', coalesce(nullif(x.test_steps, ''), '(empty)'),
      '',
      '**Expected Result:**', coalesce(nullif(x.expected_result, ''), '(empty)'),
      '',
      '**Evaluation:**',
      '- Pre Conditions: ' || CASE WHEN coalesce(l.preconditions_passed, false) THEN '✓' ELSE '✗' END
        || coalesce(' — ' || nullif(r.preconditions_remarks, ''), ''),
      '- Test Steps: ' || CASE WHEN coalesce(l.test_steps_passed, false) THEN '✓' ELSE '✗' END
        || coalesce(' — ' || nullif(r.test_steps_remarks, ''), ''),
      '- Expected Results: ' || CASE WHEN coalesce(l.expected_results_passed, false) THEN '✓' ELSE '✗' END
        || coalesce(' — ' || nullif(r.expected_results_remarks, ''), ''),
      '- **Verdict: ' || coalesce(nullif(e.verdict, ''), 'ERROR') || '**',
      '- Overall Remarks: ' || nullif(r.overall_remarks, ''),
      '- Improvements: ' || nullif(r.improvements, ''),
      '') AS b
  FROM examples e
  JOIN cases c ON c.case_id = e.example_id
  JOIN texts x ON x.case_id = e.example_id
  JOIN latest1 l ON l.case_id = e.example_id
  JOIN rem r ON r.score_id = l.score_id
)
SELECT case_id,
  chr(10) || '## Reference Examples (similar validated cases — for calibration only)' || chr(10)
  || chr(10) || string_agg(b, chr(10) ORDER BY ordinal) || chr(10) || '---' || chr(10) AS context
FROM blocks GROUP BY case_id
"""
