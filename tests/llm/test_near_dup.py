import random

import numpy as np

from casegauge.llm import near_dup
from casegauge.llm.common import Scratch
from tests.llm.conftest import frame, words


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, k, percent=80):
    """(id -> set size, id -> smallest id reachable), comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = words(lower(t))
        sets.setdefault(i, []).append(
            {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in ids:
        for b in ids:
            if a < b and any(x and 100 * len(x & y) >= percent * len(x | y)
                             for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: {len(s) for s in sets[i]} for i in ids}, {i: find(i) for i in ids}


def corpus(n=160, hot=80):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(3, 120))) for _ in range(n)]
    base = rng.choices(vocabulary, k=150)
    for _ in range(hot):  # near copies: some linked with the first, some only with each other
        copy = list(base)
        for _ in range(rng.randrange(0, 8)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += rng.choices(texts, k=30)
    rng.shuffle(texts)
    return list(enumerate(texts))


def check(rows, got, k):
    sizes, component = brute(rows, k)
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles in sizes[r.doc_id]
        assert r.component_id == component[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_equals_all_pairs(spark):
    rows = corpus()
    for k in (4, 5):
        check(rows, near_dup.near_duplicates(frame(spark, rows), k=k).collect(), k)


def test_blocks_find_links_that_stars_miss(spark, monkeypatch):
    """A document that the hub doesn't reach is found through the block comparison, also
    when buckets are dealt into several blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    rows = corpus(30, 60)
    check(rows, near_dup.near_duplicates(frame(spark, rows), k=4).collect(), 4)


def test_odd_rows(odd, none):
    rows, df = odd
    got = near_dup.near_duplicates(df, k=4).collect()
    check([r[:2] for r in rows if r[0] is not None], [r for r in got if r.doc_id is not None], 4)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    kept = near_dup.keep_one(df, k=5)
    assert kept.columns == df.columns
    _, component = brute([r[:2] for r in rows if r[0] is not None], 5)
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted(
        [r[0] for r in rows if r[0] is None or component[r[0]] == r[0]], key=str)
    assert near_dup.near_duplicates(none).count() == near_dup.keep_one(none).count() == 0


def test_the_threshold_counts_itself():
    a, b = np.arange(90, dtype=np.uint64), np.arange(10, 100, dtype=np.uint64)
    assert near_dup.linked(a, b, 80) and not near_dup.linked(a, b + np.uint64(1), 80)


def test_posterior_bounds():
    """The bounds rise with the batches, and a pair at the threshold passes them nearly always."""
    least = near_dup.least_matches(80, 1e-6)
    assert list(least) == sorted(least)
    rng = np.random.default_rng(1)
    a = np.zeros((20_000, near_dup.HASHES), np.uint32)
    b = (rng.random(a.shape) > 0.8).astype(np.uint32)
    assert near_dup.plausible(a, b, least).mean() > 0.9999
    assert near_dup.plausible(a, (rng.random(a.shape) > 0.4).astype(np.uint32), least).mean() < 0.02


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(3, 3)]
    got = {r.id: r.component for r in near_dup.components(
        spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark)).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{x: 7 for x in range(200, 260)}}


def signed_group(n, seed=3):
    """Near copies of one text: ids, sets, signatures and band keys."""
    rng = random.Random(seed)
    base = [rng.randrange(10_000) for _ in range(120)]
    texts = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(0, 10)):
            copy[rng.randrange(len(copy))] = rng.randrange(10_000)
        texts.append(" ".join(map(str, copy)).encode())
    sets, _ = near_dup.shingle_sets(texts, 4)
    sigs = np.array([near_dup.signature(s) for s in sets], np.uint32)
    return sets, sigs, near_dup.band_keys(sigs)


def blocks_of(sets, sigs, keys, labels, side=40):
    """The blocks of every bucket, as _blocks deals them."""
    for band in range(near_dup.BANDS):
        for key in set(keys[:, band].tolist()):
            members = np.flatnonzero(keys[:, band] == key).tolist()
            counts = {x: sum(labels[m] == x for m in members) for x in {labels[m] for m in members}}
            main = max(counts, key=lambda x: (counts[x], x))
            rest = [m for m in members if labels[m] != main]
            if not rest:
                continue
            for c in range(0, len(members), side):
                for d in range(0, len(rest), side):
                    rows = [(m, False) for m in members[c:c + side]] \
                        + [(m, True) for m in rest[d:d + side]]
                    yield {"key": [key] * len(rows), "id": [m for m, _ in rows],
                           "label": [labels[m] for m, _ in rows],
                           "main": [labels[m] == main for m, _ in rows],
                           "rest": [r for _, r in rows],
                           "members": [sets[m].tobytes() for m, _ in rows]}, sigs[[m for m, _ in rows]]


def test_blocks_test_every_open_pair_once():
    """A hot group in components: each pair of different ones that shares a band is tested in
    exactly one block of one bucket, no pair within a component at all."""
    sets, sigs, keys = signed_group(400)
    rng = random.Random(5)
    labels = [0 if rng.random() < 0.5 else rng.randrange(1, 60) for _ in sets]
    seen = []
    for g, s in blocks_of(sets, sigs, keys, labels):
        i, j = near_dup.candidates(g, s, 80)
        seen += [tuple(sorted((g["id"][a], g["id"][b]))) for a, b in zip(i, j)]
    expected = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
                if labels[a] != labels[b] and (keys[a] == keys[b]).any()
                and 100 * min(len(sets[a]), len(sets[b])) >= 80 * max(len(sets[a]), len(sets[b]))}
    assert len(seen) == len(set(seen)) and set(seen) == expected
    assert len(seen) > 10_000


def test_matrix_products_equal_the_exact_test(monkeypatch):
    monkeypatch.setattr(near_dup, "MEMBERS", 64)
    monkeypatch.setattr(near_dup, "PAIRS", 100)
    sets, sigs, _ = signed_group(60)
    sets += [np.empty(0, np.uint64), np.arange(500, dtype=np.uint64), np.arange(450, dtype=np.uint64)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    plain = np.array([near_dup.linked(sets[a], sets[b], 80) if len(sets[a]) or len(sets[b]) else True
                      for a, b in zip(i, j)])
    some = np.array([len(sets[a]) + len(sets[b]) > 0 for a, b in zip(i, j)])
    assert (near_dup.linked_pairs(sets, i[some], j[some], 80) == plain[some]).all()
    least = near_dup.least_matches(80, 1e-6)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    assert set(near_dup.plausible_pairs(sigs, i, j, least)) == set(
        np.flatnonzero(near_dup.plausible(sigs[i], sigs[j], least)))


def test_time_of_a_hot_block_grows_with_its_pairs():
    """Twice the group, four times the pairs: no more than that per pair, and no Python loop over
    pairs (a million in seconds)."""
    import time
    least = near_dup.least_matches(80, 1e-6)
    took = []
    for n in (500, 1000):
        sets, sigs, keys = signed_group(n)
        labels = list(range(n))
        start, pairs = time.perf_counter(), 0
        for g, s in blocks_of(sets, sigs, keys, labels, near_dup.BLOCK):
            i, j = near_dup.candidates(g, s, 80)
            keep = near_dup.plausible_pairs(s, i, j, least)
            near_dup.linked_pairs([np.frombuffer(m, np.uint64) for m in g["members"]],
                                  i[keep], j[keep], 80)
            pairs += len(i)
        took.append((time.perf_counter() - start) / pairs)
    assert took[1] < 2.5 * took[0]


def test_blocks_are_bounded_in_bytes(spark, monkeypatch):
    """Long sets make more, smaller blocks; the result is the same."""
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 2000)
    rows = corpus(30, 60)
    check(rows, near_dup.near_duplicates(frame(spark, rows), k=4).collect(), 4)
