"""Code dictionaries: JSON dimension load, broadcast decode, reverse lookup."""

import json
import os

from pyspark.sql import functions as F

from casegauge.session import scratch_path
from casegauge.sources import codemaps as cm


def test_load_dimension_drops_comments_and_decodes(spark):
    base = scratch_path(spark, "test-maps")
    os.makedirs(base, exist_ok=True)
    doc = {"field_maps": {"STATUS_MAP": {"2": "New", "6": "Active"}},
           "retrieval_fields": {"_comment": "ignored",
                                "TRIBE_MAP": {"_comment": "x", "7": "Payments", "8": "Lending"}}}
    with open(f"{base}/maps.json", "w") as fh:
        json.dump(doc, fh)
    dim = cm.load_dimension(spark, f"{base}/maps.json")
    rows = sorted(tuple(r) for r in dim.select("map_name", "id", "label").collect())
    assert rows == [("STATUS_MAP", 2, "New"), ("STATUS_MAP", 6, "Active"),
                    ("TRIBE_MAP", 7, "Payments"), ("TRIBE_MAP", 8, "Lending")]
    facts = spark.createDataFrame([(1, 7), (2, 99), (3, None)], "id long, tribe int")
    out = {r["id"]: r["tribe_label"] for r in
           cm.decode_with_dimension(facts, "tribe", dim, "TRIBE_MAP", "tribe_label").collect()}
    assert out == {1: "Payments", 2: None, 3: None}
    assert cm.find_by_label(dim, "TRIBE_MAP", "lending").first()["id"] == 8


def test_small_maps_match_literals(spark):
    dim = cm.small_maps_dimension(spark)
    assert dim.where(F.col("map_name") == "TESTING_TYPE_MAP").count() == 21
    df = spark.createDataFrame([(17,), (99,), (None,)], "c int")
    got = [r[0] for r in df.select(cm.decode(cm.TESTING_TYPE, F.col("c"))).collect()]
    assert got == ["web", None, None]
