import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from casegauge.llm import mixing
from casegauge.llm.common import Scratch, table
from tests.conftest import SF
from tests.llm.conftest import words


def rounds(sizes, weights, share=1.5, repeats=2):
    """The targets by plain rounds of resharing."""
    target = {s: 0.0 for s in sizes}
    fixed, left = set(), share * sum(sizes.values())
    while len(fixed) < len(sizes):
        w = sum(weights[s] for s in sizes if s not in fixed)
        now = {s: left * weights[s] / w for s in sizes if s not in fixed}
        over = [s for s in now if now[s] > repeats * sizes[s]]
        target.update(now)
        if not over:
            break
        for s in over:
            target[s] = repeats * sizes[s]
            left -= target[s]
            fixed.add(s)
    return target


def test_targets_equal_plain_rounds():
    rng = random.Random(1)
    for _ in range(200):
        sizes = {f"s{i}": rng.choice([0, rng.randrange(1000)]) for i in range(rng.randrange(1, 12))}
        weights = {s: rng.choice([5, 2, 1]) for s in sizes}
        got = mixing.targets(sizes, weights)
        want = rounds(sizes, weights)
        assert all(abs(float(got[s]) - want[s]) < 1e-6 for s in sizes)
        assert sum(got.values()) == Fraction(3, 2) * sum(sizes.values())


def test_flow_is_full_and_cheapest_on_small_networks():
    """Against trying every split of two patterns over two sources."""
    rng = random.Random(2)
    for _ in range(60):
        cap = [rng.randrange(6) for _ in range(3)]
        members = [[0], [1], [0, 1]]
        quota = [rng.randrange(8), rng.randrange(8)]
        flows = mixing.min_cost_flow(cap, members, quota)
        total = sum(sum(f.values()) for f in flows)
        cost = sum(4 ** k * n for f in flows for (k, _), n in f.items())
        best = None
        for shared0 in range(2 * cap[2] + 1):
            for shared1 in range(2 * cap[2] - shared0 + 1):
                for own0 in range(2 * cap[0] + 1):
                    for own1 in range(2 * cap[1] + 1):
                        if own0 + shared0 <= quota[0] and own1 + shared1 <= quota[1]:
                            used = [own0, own1, shared0 + shared1]
                            c = sum(min(u, n) + 4 * max(0, u - n) for u, n in zip(used, cap))
                            key = (-sum(used), c)
                            best = key if best is None else min(best, key)
        assert (-total, cost) == best


def test_documents_are_near_their_targets(spark):
    docs = table(spark, SF, "documents")
    rows = mixing.mixture(docs).collect()
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    assert len(rows) == len(texts)
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        text, source = texts[r.doc_id]
        assert r.size == len(words(text)) and r.taken in (0, r.size, 2 * r.size)
        sizes[source] += r.size
        taken[source] += r.taken
        target[source] = r.target
        largest[source] = max(largest[source], r.size)
    order = sorted(sizes)
    want = rounds(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6
        assert abs(taken[s] - target[s]) <= largest[s]
    assert all(r.source_size == sizes[texts[r.doc_id][1]] for r in rows)
    again = {r.doc_id: r.taken for r in mixing.mixture(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_expand_repeats_what_the_mix_takes(spark):
    docs = table(spark, SF, "documents")
    copies = {r.doc_id: r.copies for r in mixing.mixture(docs).collect() if r.copies}
    out = mixing.expand(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == copies


def test_overlapping_sources(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 30), rng.choice([["a"], ["b"], ["a", "b"], ["b", "a", "a"],
                                                         [], [None, "a"]])) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, sources array<string>")
    placed = mixing.placed(df, F.col("sources"), "doc_id", "text", 1)
    chosen, plan = mixing.mix(placed, lambda keys: dict.fromkeys(keys, 1))
    taken = defaultdict(int)
    for r in chosen.collect():
        assert set(r.taken_by) <= set(r.pattern) and len(r.taken_by) <= 2
        for s in r.taken_by:
            taken[s] += r.size
    flow = defaultdict(int)
    lines = plan["lines"].collect()
    for r in lines:
        for x in r.line:
            flow[x.source] += x.to_ - x.from_
    assert set(flow) == {"va", "vb", "n"}
    for s in flow:
        assert abs(taken[s] - flow[s]) <= 30 * len(lines) * 2
    assert_choice(placed, chosen, lines)


def assert_choice(placed, chosen, lines):
    """Every document's copies by brute force: a pattern's documents on one line, sorted; a copy
    goes to the source in whose stretch the middle word lies."""
    line = {tuple(r.pattern): r.line for r in lines}
    docs = defaultdict(list)
    for r in placed.collect():
        docs[tuple(r.pattern)].append((r.bucket, r.place, r.size, r.row))
    want = defaultdict(list)
    for pattern, rows in docs.items():
        at = 0
        for _, place, size, row in sorted(rows, key=lambda x: x[:3]):
            middle = 2 * at + size
            want[pattern, place, size].append(sorted(
                x.source for x in line.get(pattern, ()) if 2 * x.from_ <= middle < 2 * x.to_))
            at += size
    got = defaultdict(list)
    for r in chosen.collect():
        got[tuple(r.pattern), r.place, r.size].append(sorted(r.taken_by))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_the_flow_gives_every_stretch(spark):
    """In the table every source stands alone, and each one's network gives its line; the
    documents are those that brute force takes from the lines."""
    docs = table(spark, SF, "documents")
    placed = mixing.placed(docs, F.array("source"), "doc_id", "text", 5)
    chosen, plan = mixing.mix(placed, mixing.repeating((5, 2, 1)))
    sources = {r.source: r for r in plan["sources"].collect()}
    lines = plan["lines"].collect()
    assert {tuple(r.pattern) for r in lines} == {(k,) for k in sources}
    for r in lines:
        s = sources[r.pattern[0]]
        flow = mixing.min_cost_flow([s["size"]], [[0]], [s["quota"]])[0]
        assert [(x.k, x.to_ - x.from_) for x in r.line] == [(k, n) for (k, _), n in sorted(flow.items())]
        assert sum(x.to_ - x.from_ for x in r.line) == min(s["quota"], 2 * s["size"])
    assert_choice(placed, chosen, lines)


def test_sources_beyond_max_patterns(spark):
    """One source per document is no overlap: any number of sources is mixed, each through a
    network of its own; the limit holds for connected patterns."""
    rng = random.Random(7)
    rows = [(i, "w " * rng.randrange(1, 30), rng.choice([None, f"site{i % 3000}é{i % 7}"]))
            for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    placed = mixing.placed(df, F.array("source"), "doc_id", "text", 1)
    chosen, plan = mixing.mix(placed, mixing.repeating((5, 2, 1)), max_patterns=10)
    assert plan["lines"].count() == plan["sources"].count() > 2500
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        key = "n" if source is None else "v" + source
        sizes[key] += len(words(text))
        largest[key] = max(largest[key], len(words(text)))
    order = mixing.code_point_order(sizes)
    want = mixing.targets(sizes, mixing.repeating((5, 2, 1))(order))
    got = {r.source: r for r in plan["sources"].collect()}
    assert {k: r.size for k, r in got.items()} == sizes
    assert all(got[k].target == float(want[k]) and got[k].quota == round(want[k]) for k in sizes)
    for r in chosen.collect():
        assert set(r.taken_by) <= set(r.pattern)
        for s in r.taken_by:
            taken[s] += r.size
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)


def test_flows_by_group_equal_the_whole_network(spark):
    rng = random.Random(9)
    cases = []
    for _ in range(40):
        patterns = sorted({tuple(sorted(rng.sample("abcdefghij", rng.randint(1, 2))))
                           for _ in range(6)})
        sizes = [rng.randrange(20) for _ in patterns]
        keys = sorted({k for p in patterns for k in p})
        quotas = {k: rng.randrange(30) for k in keys}
        whole = mixing.min_cost_flow(sizes, [[keys.index(k) for k in p] for p in patterns],
                                     list(quotas.values()))
        cases.append((patterns, sizes, quotas, whole))
    # all cases at once: their sources are kept apart by a prefix, so the groups are too
    totals, sources = [], []
    for c, (patterns, sizes, quotas, _) in enumerate(cases):
        totals += [([f"{c:02d}{k}" for k in p], n) for p, n in zip(patterns, sizes)]
        sources += [(f"{c:02d}{k}", n) for k, n in quotas.items()]
    lines = mixing.lines_of(spark.createDataFrame(totals, "pattern array<string>, n bigint"),
                            spark.createDataFrame(sources, "source string, quota bigint"),
                            2, 6, Scratch(spark)).collect()
    cost, full, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in lines:
        ends = defaultdict(int)
        for x in r.line:
            assert x.source in r.pattern and x.from_ == ends[x.k]  # one after the other
            ends[x.k] = x.to_
            cost[int(x.source[:2])] += 4 ** x.k * (x.to_ - x.from_)
            full[int(x.source[:2])] += x.to_ - x.from_
            taken[x.source] += x.to_ - x.from_
    assert len(lines) == len(totals) and all(taken[k] <= n for k, n in sources)
    for c, (*_, whole) in enumerate(cases):
        assert cost[c] == sum(4 ** k * n for f in whole for (k, _), n in f.items())
        assert full[c] == sum(n for f in whole for n in f.values())


def test_connected_patterns_beyond_the_limit_are_refused(spark):
    chain = [([f"s{i}", f"s{i + 1}"], 5) for i in range(30)]
    args = (spark.createDataFrame(chain, "pattern array<string>, n bigint"),
            spark.createDataFrame([(f"s{i}", 4) for i in range(31)], "source string, quota bigint"), 2)
    with pytest.raises(ValueError, match="30 membership patterns"):
        mixing.lines_of(*args, 29, Scratch(spark))
    assert mixing.lines_of(*args, 30, Scratch(spark)).count() == 30


def test_odd_rows(odd, none):
    rows, df = odd
    got = mixing.mixture(df).collect()
    assert len(got) == len(rows)
    assert all(r.taken <= 2 * r.size for r in got)
    out = mixing.expand(df)
    assert out.columns == df.columns and out.count() == sum(r.copies for r in got)
    assert mixing.mixture(none).count() == mixing.expand(none).count() == 0
