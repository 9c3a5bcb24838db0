import numpy as np
import pytest
from pyspark.sql import functions as F

from casegauge.llm import hnsw
from casegauge.llm.common import table
from tests.conftest import SF

SCHEMA = "vec_id bigint, embedding array<float>, vec string, dim string, shard string, members int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z", 1) for i, v in rows], SCHEMA)


def good(v):
    return v and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, queries, k=10):
    real = {(i, tuple(map(np.float32, v))) for i, v in rows if i is not None and good(v)}
    out = {}
    for i, v in queries:
        if i is None or not good(v):
            continue
        v = np.array(v, np.float32).astype(np.float64)
        near = {}
        for j, w in real:
            if j != i and len(w) == len(v):
                d = float(np.sqrt(((np.array(w, np.float64) - v) ** 2).sum()))
                near[j] = min(d, near.get(j, d))
        out[i] = sorted((d, j) for j, d in near.items())[:k]
    return out


def result(df, queries, **kw):
    out = {}
    for r in sorted(hnsw.nearest(df, queries, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({j for _, j in got.get(i, [])} & {j for _, j in w}) for i, w in want.items())
    return hits / max(1, sum(map(len, want.values())))


def test_recall_on_the_table(spark):
    df = table(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = result(df, df.where(F.col("vec_id") % 10 == 0))
    want = brute(rows, [r for r in rows if r[0] % 10 == 0])
    assert set(got) == set(want) and recall(got, want) >= 0.97
    exact = {(i, j): d for i, w in want.items() for d, j in w}
    assert all(abs(d - exact.get((i, j), d)) < 1e-12 for i, w in got.items() for d, j in w)


def test_shards_merge_and_copies_tie(spark):
    """Many shards, clusters, and a group of copies larger than a result."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.1 * rng.normal(size=16)).astype(np.float32).tolist())
            for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(300)]
    df = frame(spark, rows)
    ask = [r for r in rows if r[0] % 50 == 0]
    got = result(df, df.where(F.col("vec_id") % 50 == 0), shard=200)
    want = brute(rows, ask)
    assert recall(got, want) >= 0.98
    assert got[2050] == want[2050] == [(0.0, j) for j in (0, *range(2000, 2009))]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]),
            (4, [None, 1.0]), (200, [inf, 1.0]), (5, []), (300, [1.0, 2.0, 3.0]), (6, [2.0, -0.0]),
            (7, [2.0, 0.0]), (None, [1.0, 1.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 0.0]),
            (9, [5.0, 0.0])]
    df = frame(spark, rows)
    got = result(df, df.where("vec_id % 100 = 0"))
    assert got == {i: w for i, w in brute(rows, [r for r in rows if r[0] is not None
                                                 and r[0] % 100 == 0]).items() if w}
    none = frame(spark, [])
    assert hnsw.nearest(none, none).count() == 0
    assert hnsw.nearest(df, none).count() == 0


def clusters(n, m, spread, dim=32, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(m, dim))[np.arange(n) % m] + spread * rng.normal(size=(n, dim))


def graph_recall(v, asked, k=10):
    """Recall of one shard's graph against exact distances, and the share of nodes visited."""
    levels = hnsw.build(v, np.arange(len(v)))
    found, _, looked = hnsw.search(v, levels, v[asked], hnsw.EF)
    scale = np.abs(v - np.median(v, 0)).max()
    x = (v - np.median(v, 0)) / scale
    hits = 0
    for i, f in zip(asked, found):
        hits += len(set(np.argsort(((x - x[i]) ** 2).sum(1), kind="stable")[:k]) & set(f[:k]))
    return hits / (k * len(asked)), looked / len(asked) / len(v)


@pytest.mark.parametrize("change", [lambda x: x + 1e4, lambda x: x * 1e20, lambda x: x * 1e-25,
                                    lambda x: x * 1e200])
def test_offset_and_magnitude_don_t_matter(change):
    assert graph_recall(change(clusters(2000, 40, 0.3)), np.arange(0, 2000, 20))[0] >= 0.99


def test_an_outlier_doesn_t_matter():
    v = clusters(2000, 40, 0.3)
    v[7] *= 1e20
    assert graph_recall(v, np.arange(20, 2000, 20))[0] >= 0.99


@pytest.mark.parametrize("m", [10, 40, 100])
def test_tight_clusters_are_all_reached(m):
    assert graph_recall(clusters(4000, m, 0.01), np.arange(0, 4000, 20))[0] >= 0.95


def test_a_search_visits_a_small_part_of_a_large_shard():
    recall_, share = graph_recall(clusters(12_000, 300, 0.5), np.arange(0, 12_000, 100))
    assert recall_ >= 0.97 and share <= 0.2


def test_every_node_is_reached_from_the_top():
    v = clusters(1500, 60, 0.001)
    levels = hnsw.build(v, np.arange(len(v)))
    reached = set(levels[-1][0].tolist())
    for nodes, near in reversed(levels):
        row, waiting = dict(zip(nodes.tolist(), near.tolist())), list(reached)
        while waiting:
            for x in row[waiting.pop()]:
                if x >= 0 and x not in reached:
                    reached.add(x)
                    waiting.append(x)
    assert reached == set(range(len(v)))


def test_far_vectors_through_the_operator(spark):
    """The same table shifted and scaled: float values as stored, recall as before."""
    base = clusters(900, 30, 0.3, 16)
    for change in (lambda x: x + 1e4, lambda x: x * 1e20, lambda x: x * 1e-25):
        rows = [(i, change(v).astype(np.float32).tolist()) for i, v in enumerate(base)]
        df = frame(spark, rows)
        got = result(df, df.where(F.col("vec_id") % 50 == 0), shard=300)
        exact = {}
        x = np.array([v for _, v in rows], np.float64)
        for i in range(0, 900, 50):
            d = np.sqrt((((x - x[i]) / np.abs(x).max()) ** 2).sum(1))
            d[i] = np.inf
            exact[i] = [(0.0, int(j)) for j in np.argsort(d, kind="stable")[:10]]
        assert recall(got, exact) >= 0.97
