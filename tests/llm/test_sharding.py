from casegauge.llm import sharding
from casegauge.llm.common import table
from tests.conftest import SF_SMALL


def test_shares_are_even_and_removal_moves_little():
    table_ = sharding.fill(sharding.SHARDS)
    counts = [table_.count(i) for i in range(len(sharding.SHARDS))]
    assert max(counts) - min(counts) <= 1 and sum(counts) == sharding.SLOTS
    fewer = sharding.SHARDS[:-1]
    after = sharding.fill(fewer)
    moved = sum(a != b for a, b in zip(table_, after) if a < len(fewer))
    assert moved < 0.1 * sharding.SLOTS


def test_turns_weigh_shards():
    t = sharding.fill(["a", "b"], 101, {"a": 3})
    assert abs(t.count(0) - 3 * t.count(1)) <= 4


def test_bad_tables_are_refused():
    for shards, slots in ((["a"], 100), ([], 101), (["a", "a"], 101), (["a"] * 2, 2)):
        try:
            sharding.fill(shards, slots)
        except ValueError:
            continue
        raise AssertionError((shards, slots))


def test_rows(spark, odd, none):
    rows, df = odd
    got = sharding.place(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert by.setdefault(r.doc_id, (r.slot, r.shard)) == (r.slot, r.shard)
        assert r.shard == sharding.fill(sharding.SHARDS)[r.slot]
    assert sharding.place(none).count() == 0
    docs = table(spark, SF_SMALL, "documents")
    flows = sharding.moved(docs, sharding.SHARDS, sharding.SHARDS[:-1]).collect()
    assert sum(r.rows for r in flows) == docs.count()
    plan = sharding.place(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
