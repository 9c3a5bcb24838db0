"""Scalar text functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.functions.html import py_strip  # noqa: F401  (re-exported)

# --- Fixed values: link layout and the evaluator reply contract. ---
DEFAULT_LINK_PATTERN = "/view/(\\p{Nd}+)"
DEFAULT_API_BASE = "https://cases.example.com/index.php?/api/v2/get_case/"
DEFAULT_VIEW_BASE = "https://cases.example.com/index.php?/cases/view/"
VERDICT_ENUM = ("Passed", "Needs Improvement", "Failed")
FENCED_JSON_RE = "(?s)```(?:json)?\\s*(\\{.*?\\})\\s*```"
BRACED_JSON_RE = "(?s)\\{.*\\}"
# --- end of fixed values ---

CRITERION = T.StructType([T.StructField("passed", T.BooleanType()),
                          T.StructField("remarks", T.StringType())])
RESULT_SCHEMA = T.StructType([
    T.StructField("test_case_id", T.StringType()),
    T.StructField("preconditions", CRITERION),
    T.StructField("test_steps", CRITERION),
    T.StructField("expected_results", CRITERION),
    T.StructField("verdict", T.StringType()),
    T.StructField("overall_remarks", T.StringType()),
    T.StructField("improvements", T.StringType()),
])



def extract_id(link: Column, pattern: str = DEFAULT_LINK_PATTERN) -> Column:
    """First capture of ``pattern`` in the link; no match -> NULL."""
    return F.nullif(F.regexp_extract(link, pattern, 1), F.lit(""))


def endpoint(record_id: Column, base: str = DEFAULT_API_BASE) -> Column:
    """API endpoint for an id (NULL id -> NULL endpoint)."""
    return F.concat(F.lit(base), record_id)


def digits_only(c: Column) -> Column:
    """keep decimal digits (Unicode ``Nd``, like Python's ``\\d``)."""
    return F.regexp_replace(c.cast("string"), "[^\\p{Nd}]", "")


def build_link(raw_id: Column, base: str = DEFAULT_VIEW_BASE) -> Column:
    """Link from an id such as ``C2615919``; '' when the id has no digits."""
    d = digits_only(raw_id)
    return F.when(F.coalesce(d, F.lit("")) != "", F.concat(F.lit(base), d)).otherwise(F.lit(""))


def case_label(case_id: Column) -> Column:
    """the ``C``-prefixed display id."""
    return F.concat(F.lit("C"), case_id.cast("string"))


def or_default(c: Column, default: str) -> Column:
    """``x or y`` -- NULL or empty text falls back to the default."""
    return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(default))


def file_timestamp(name: Column) -> Column:
    """``yyyyMMdd_HHmmss`` inside a file name -> timestamp; none -> NULL."""
    return F.try_to_timestamp(F.regexp_extract(name, "([0-9]{8}_[0-9]{6})", 1),
                              F.lit("yyyyMMdd_HHmmss"))


def flag_to_int(c: Column) -> Column:
    """boolean-ish flag -> 1 / 0 / NULL."""
    return c.cast("boolean").cast("int")


def extract_json(text: Column) -> Column:
    """the JSON object in a free-text reply -- a fenced block first, else the
    outermost braces; NULL when there is none."""
    fenced = F.nullif(F.regexp_extract(text, FENCED_JSON_RE, 1), F.lit(""))
    braced = F.nullif(F.regexp_extract(text, BRACED_JSON_RE, 0), F.lit(""))
    return F.coalesce(fenced, braced)


# --- Fixed values: text spellings a lax boolean field accepts (compared lower-cased). ---
LAX_TRUE = ("1", "on", "t", "true", "y", "yes")
LAX_FALSE = ("0", "off", "f", "false", "n", "no")
# --- end of fixed values ---
CRITERIA = ("preconditions", "test_steps", "expected_results")


_LEAVES = {**{f"{c}_passed": f"$.{c}.passed" for c in CRITERIA},
           **{f"{c}_remarks": f"$.{c}.remarks" for c in CRITERIA},
           "verdict": "$.verdict", "overall_remarks": "$.overall_remarks",
           "improvements": "$.improvements", "test_case_id": "$.test_case_id"}


def _lax_bool(leaf: Column, kind: Column) -> Column:
    """A lax boolean from a leaf and its JSON type: JSON true/false, the numbers 1/0, or
    a text spelling of ``LAX_TRUE`` / ``LAX_FALSE`` (any case); anything else -> NULL."""
    num = F.try_variant_get(leaf, "$", "double")
    txt = F.lower(F.try_variant_get(leaf, "$", "string"))
    return (F.when(kind == "BOOLEAN", F.try_variant_get(leaf, "$", "boolean"))
            .when((kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"),
                  F.when(num == 1, F.lit(True)).when(num == 0, F.lit(False)))
            .when(kind == "STRING", F.when(txt.isin(*LAX_TRUE), F.lit(True))
                  .when(txt.isin(*LAX_FALSE), F.lit(False))))


def _text(leaf: Column, kind: Column) -> Column:
    """A string field: the text only when the JSON value is a string, else NULL."""
    return F.when(kind == "STRING", F.try_variant_get(leaf, "$", "string"))


def parse_replies(df: DataFrame, reply_col: str, request_id_col: str, out: str = "r") -> DataFrame:
    """reply text -> typed evaluator result with an explicit validity check.

    The JSON object is parsed once into a VARIANT, so each field is checked against
    its JSON type, as the result contract does: a criterion needs an object with a
    ``passed`` flag (JSON boolean, 1/0, or a text spelling such as ``"yes"``) and a
    ``remarks`` string; ``verdict`` must be a string of the enum; id and texts must be
    strings. Missing keys take the contract defaults (verdict ``Failed``, texts ``''``,
    id = the request id). Any violation makes the reply invalid. Adds ``out`` =
    ``struct(valid, error, test_case_id, preconditions, test_steps, expected_results,
    verdict, overall_remarks, improvements)``.

    Staged projections -- extract, parse, pull the ten leaves, type them, convert -- so
    every step runs once per row (the optimizer keeps projections apart when merging
    them would repeat an expensive expression).
    """
    base = df.columns
    s1 = df.withColumn("__js", extract_json(F.col(reply_col)))
    s2 = s1.withColumn("__v", F.try_parse_json("__js"))
    # a missing key (or a non-object parent) gives SQL NULL; a JSON null gives type VOID
    s3 = s2.select(*base, "__js", "__v", *[F.try_variant_get("__v", path, "variant").alias(f"__l_{k}")
                                          for k, path in _LEAVES.items()])
    leaves = [f"__l_{k}" for k in _LEAVES]
    s4 = s3.select(*base, "__js", "__v", *leaves,
                   *[F.schema_of_variant(f"__l_{k}").alias(f"__t_{k}") for k in _LEAVES])
    leaf = lambda k: F.col(f"__l_{k}")
    kind = lambda k: F.col(f"__t_{k}")

    def defaulted(k: str, default: Column) -> Column:
        return F.when(leaf(k).isNotNull(), _text(leaf(k), kind(k))).otherwise(default)

    # converted values stay top-level columns: a struct here would be inlined into every
    # reader and its conversions repeated
    s5 = s4.select(
        *base, "__js", "__v",
        *[_lax_bool(leaf(f"{c}_passed"), kind(f"{c}_passed")).alias(f"__p_{c}") for c in CRITERIA],
        *[_text(leaf(f"{c}_remarks"), kind(f"{c}_remarks")).alias(f"__r_{c}") for c in CRITERIA],
        defaulted("verdict", F.lit("Failed")).alias("__verdict"),
        defaulted("overall_remarks", F.lit("")).alias("__overall"),
        defaulted("improvements", F.lit("")).alias("__impr"),
        defaulted("test_case_id", F.col(request_id_col).cast("string")).alias("__tcid"))
    crit_ok = [F.col(f"__p_{c}").isNotNull() & F.col(f"__r_{c}").isNotNull() for c in CRITERIA]
    valid = F.coalesce(
        F.col("__v").isNotNull() & F.col("__verdict").isin(*VERDICT_ENUM)
        & crit_ok[0] & crit_ok[1] & crit_ok[2] & F.col("__overall").isNotNull()
        & F.col("__impr").isNotNull() & F.col("__tcid").isNotNull(), F.lit(False))
    s6 = s5.withColumn("__valid", valid)
    error = (F.when(F.col("__js").isNull(), F.lit("no JSON object found in reply"))
             .when(~F.col("__valid"), F.lit("reply does not match the result contract")))
    return s6.select(*base, F.struct(
        F.col("__valid").alias("valid"), error.alias("error"), F.col("__tcid").alias("test_case_id"),
        *[F.struct(F.col(f"__p_{c}").alias("passed"), F.col(f"__r_{c}").alias("remarks")).alias(c)
          for c in CRITERIA], F.col("__verdict").alias("verdict"),
        F.col("__overall").alias("overall_remarks"), F.col("__impr").alias("improvements"),
    ).alias(out))


def prompt_lines(*lines: Column) -> Column:
    """newline-joined prompt text; NULL lines vanish (optional lines)."""
    return F.concat_ws("\n", *lines)
