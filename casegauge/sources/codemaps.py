"""Code dictionaries: integer ids -> labels.

The five small dictionaries drive the standards rules and are compiled into map
literals, so decoding is a constant lookup inside whole-stage codegen with no join.
The large retrieval dictionaries (tribe/product/capability: hundreds of entries, owned
by the deployment) are loaded from the JSON file into a long dimension table and joined
with a broadcast: their size is the size of the dictionary file, never of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: the id -> label dictionaries the standards are defined against. ---
AUTOMATABILITY = {
    1: "Automated",
    2: "Automatable",
    3: "Non-Automatable",
    4: "To be Determined",
    5: "For Migration",
}
AUTOMATION_STATUS = {
    1: "Not Started",
    2: "In Progress",
    3: "Blocked Test Data",
    4: "Blocked Incomplete Steps",
    5: "Blocked Access Issues",
    6: "Obsolete",
    7: "Blocked Feature Issue",
    8: "Blocked Others",
    9: "Reviewed = Passed DOR",
    10: "Completed",
    11: "None",
}
TESTING_TYPE = {
    1: "api",
    2: "api-and-database",
    3: "api-and-mobile",
    4: "api-and-logs-checking",
    5: "api-and-sms",
    6: "api-and-web",
    7: "database",
    8: "database-and-logs-checking",
    9: "database-and-sms",
    10: "logs-checking",
    11: "mobile",
    12: "mobile-and-database",
    13: "mobile-and-logs-checking",
    14: "mobile-and-sms",
    15: "sms",
    16: "sms-and-logs-checking",
    17: "web",
    18: "web-and-database",
    19: "web-and-logs-checking",
    20: "web-and-mobile",
    21: "web-and-sms",
}
STATUS = {
    2: "New",
    3: "Reviewed",
    4: "Obsolete",
    5: "Inactive",
    6: "Active",
}
TESTING_PHASE = {
    1: "BE Regression",
    2: "FE Regression",
    3: "FVT",
    4: "FE Sanity",
    5: "BE Sanity",
    6: "Pre-Test",
    7: "Post-Test",
    8: "Cleanpass Project",
    9: "Sprint Testing",
    10: "Sanity",
    11: "Smoke",
    12: "Regression",
}
# --- end of fixed values ---

SMALL_MAPS = {
    "AUTOMATABILITY_MAP": AUTOMATABILITY,
    "AUTOMATION_STATUS_MAP": AUTOMATION_STATUS,
    "TESTING_TYPE_MAP": TESTING_TYPE,
    "STATUS_MAP": STATUS,
    "TESTING_PHASE_MAP": TESTING_PHASE,
}

DIM_SCHEMA = T.StructType([
    T.StructField("section", T.StringType()),
    T.StructField("map_name", T.StringType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("label", T.StringType()),
])


def map_literal(mapping: dict[int, str]) -> Column:
    """A ``map<int,string>`` literal; a constant in the plan (no join, no shuffle)."""
    return F.create_map(*[x for k, v in sorted(mapping.items()) for x in (F.lit(k), F.lit(v))])


def decode(mapping: dict[int, str], code: Column) -> Column:
    """Id -> label; NULL or unknown id -> NULL (``try_element_at`` is ANSI-safe)."""
    return F.try_element_at(map_literal(mapping), code.cast("int"))


def decode_array(mapping: dict[int, str], codes: Column) -> Column:
    """Decode every element; an unknown id stands for itself as text."""
    m = map_literal(mapping)
    return F.transform(codes, lambda x: F.coalesce(F.try_element_at(m, x), x.cast("string")))


def ids_with_labels(mapping: dict[int, str], labels: set[str]) -> list[int]:
    """Allow-lists are stated as labels and resolved to ids once, on the driver."""
    return sorted(k for k, v in mapping.items() if v in labels)


def load_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Read the dictionary JSON into a long table ``(section, map_name, id, label)``.

    Keys are cast with ``try_cast`` so the ``_comment`` entries (and any other non-integer
    key) are dropped instead of failing the job (F13). Sections whose name starts with
    ``_`` are ignored. The file is read as one whole text (it is a single JSON document).
    """
    doc = spark.read.text(path, wholetext=True)
    as_map = "map<string,string>"  # nested objects stay as their JSON text, one level at a time
    sections = doc.select(F.explode(F.from_json("value", as_map)).alias("section", "maps_json"))
    maps = (sections.where(~F.col("section").startswith("_"))
            .select("section", F.explode(F.from_json("maps_json", as_map))
                    .alias("map_name", "entries_json"))
            .where(~F.col("map_name").startswith("_")))
    entries = maps.select("section", "map_name",
                          F.explode(F.from_json("entries_json", as_map)).alias("k", "label"))
    return (entries.select("section", "map_name", F.expr("try_cast(k AS INT)").alias("id"), "label")
            .where(F.col("id").isNotNull()))


def standards_maps(dim: DataFrame) -> dict[str, dict[int, str]]:
    """The five dictionaries of the standards as a loaded file states them; one that the file
    doesn't hold keeps its fixed values. A dictionary is one configuration file, read whole by
    ``load_dimension``, and becomes literals of the plan."""
    loaded: dict[str, dict[int, str]] = {}
    rows = dim.where((F.col("section") == "field_maps") & F.col("map_name").isin(*SMALL_MAPS))
    for r in rows.collect():
        loaded.setdefault(r["map_name"], {})[r["id"]] = r["label"]
    return {name: loaded.get(name, fixed) for name, fixed in SMALL_MAPS.items()}


def small_maps_dimension(spark: SparkSession) -> DataFrame:
    """The fixed dictionaries as the same long table (for joins, reverse lookup, tests)."""
    rows = [("field_maps", name, k, v) for name, m in SMALL_MAPS.items() for k, v in m.items()]
    return spark.createDataFrame(rows, DIM_SCHEMA)


def decode_with_dimension(df: DataFrame, code_col: str, dim: DataFrame, map_name: str,
                          out_col: str, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """J1 for the large dictionaries: left join against one map of the dimension.

    The dimension is a configuration file (hundreds of rows). It is broadcast only after
    its row count is checked against ``max_broadcast_rows`` -- then the fact side is never
    shuffled for a decode; a dictionary beyond the bound is joined by shuffle.
    """
    from casegauge.operators.joins import broadcast_if_small

    one = (dim.where(F.col("map_name") == map_name)
           .select(F.col("id").alias("__code"), F.col("label").alias(out_col)))
    side, _ = broadcast_if_small(one, max_broadcast_rows)
    return (df.join(side, df[code_col].cast("int") == F.col("__code"), "left")
            .drop("__code"))


def find_by_label(dim: DataFrame, map_name: str, label: str) -> DataFrame:
    """reverse lookup, case-insensitive, first id in dictionary order."""
    hit = dim.where((F.col("map_name") == map_name) & (F.lower("label") == label.lower()))
    return hit.agg(F.min("id").alias("id"))


# The record fields decoded through the retrieval dictionaries, and their map names.
RETRIEVAL_FIELDS = (("custom_case_tribe", "TRIBE_MAP", "Tribe"),
                    ("custom_product_prod", "PRODUCT_MAP", "Product"),
                    ("custom_capability", "CAPABILITY_MAP", "Capability"))


def decode_retrieval_fields(records: DataFrame, dim: DataFrame,
                            prefix: str = "__label_") -> DataFrame:
    """J1 for tribe / product / capability: one size-checked dimension join per field,
    adding ``{prefix}Tribe`` etc. (unknown or NULL id -> NULL, as the reference's
    ``MAP.get``). The dictionary is parsed once: its entries are checkpointed before the size
    checks and joins read them."""
    from casegauge.operators.joins import materialize

    dim = materialize(dim.where(F.col("map_name").isin(*[m for _, m, _ in RETRIEVAL_FIELDS])))
    out = records
    for code_col, map_name, label in RETRIEVAL_FIELDS:
        out = decode_with_dimension(out, code_col, dim, map_name, f"{prefix}{label}")
    return out
