import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from casegauge.llm import vector_codes
from casegauge.llm.common import table
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<{}>, label int, code string, ints string, n bigint"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "c", "i", 1) for r in rows], SCHEMA.format(kind))


def brute(rows, entries=16, rounds=6):
    """The whole method in integers of any length, a loop per vector."""
    kept = [(i, [math.floor(Fraction(x) * 4096) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // 8
    parts = [slice(p * width, (p + 1) * width) for p in range(8)]
    books = [[r[1][p] for r in kept[:entries]] for p in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for k, p in enumerate(parts):
            members = {}
            for r in kept:
                members.setdefault(nearest(r[1][p], books[k])[1], []).append(r[1][p])
            books[k] = [[sum(c) // len(members[e]) for c in zip(*members[e])]
                        if e in members else c for e, c in enumerate(books[k])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], {}
    for i, v, label in kept:
        found = [nearest(v[p], books[k]) for k, p in enumerate(parts)]
        error = sum(d for d, _ in found)
        sums.setdefault(label, []).append(error)
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))

    def fits(x):
        return x if x < 1 << 63 else None
    sums = {label: None if None in map(fits, e) else fits(sum(e)) for label, e in sums.items()}
    return [(i, code, fits(error), sums[label], sha) for i, code, error, label in out]


def check(spark, rows, kind="float"):
    df = frame(spark, rows, kind)
    given = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = [tuple(r) for r in vector_codes.digest(df).collect()]
    assert sorted(got, key=str) == sorted(brute(given), key=str)
    return got


@pytest.fixture(scope="module")
def real(spark):
    return [(r.vec_id, r.embedding, r.label) for r in table(spark, SF_SMALL, "embeddings").collect()]


def test_equals_a_plain_loop(spark, real):
    assert len(check(spark, real)) == len(real)


@pytest.mark.parametrize("change", [lambda x: x + 1e4, lambda x: x * 1e6, lambda x: x * 1e20,
                                    lambda x: x * 1e-25])
def test_components_of_any_magnitude(spark, real, change):
    check(spark, [(i, [change(x) for x in v], label) for i, v, label in real[:150]])


def test_components_that_need_many_limbs(spark, real):
    check(spark, [(i, [x * 1e300 for x in v], label) for i, v, label in real[:60]], "double")


def test_odd_rows(spark):
    rng = random.Random(1)
    odd = [(None, [.5] * 16, None), (3, None, 1), (4, [float("nan")] * 16, 1),
           (5, [float("inf")] + [0.] * 15, 2), (5, [None] * 16, 2)]
    odd += [(rng.randrange(9), [rng.choice([0., .25, -.25, 1.]) for _ in range(16)],
             rng.choice([None, 1])) for _ in range(40)]
    check(spark, odd)
    check(spark, odd[:8])
    check(spark, [(1, [0.] * 16, 1)] * 20)
    assert check(spark, []) == []
    other = vector_codes.digest(frame(spark, [(1, [.5] * 16, 1), (2, [.5] * 8, 1), (3, [], 1)]))
    assert [r.vec_id for r in other.collect()] == [1]
    short = vector_codes.digest(frame(spark, [(i, [i / 2] * 11, 1) for i in range(20)]))
    assert short.count() == 20
    assert {(r.code, r.error) for r in vector_codes.digest(frame(spark, [(1, [], 1)])).collect()} \
        == {("00" * 8, 0)}


def test_limbs_are_exact():
    rng = np.random.default_rng(2)
    for width, top in ((8, 2 ** 12), (8, 2 ** 40), (1000, 2 ** 53)):
        bits = vector_codes.limb_bits(width)
        limbs = vector_codes.limbs_needed(top, bits)
        assert width * (2 ** bits) ** 2 < 2 ** 53
        x = np.floor(rng.uniform(-top, top, (50, width)))
        put_together = sum(part.astype(object) * (1 << bits * k)
                           for k, part in enumerate(vector_codes.split(x, bits, limbs)))
        assert [[int(v) for v in r] for r in put_together] == [[int(v) for v in r] for r in x]
        entries = [[int(v) for v in r] for r in x[:9]]
        book = vector_codes.Codebook(entries, bits, limbs)
        best, _ = book.nearest(vector_codes.split(x, bits, limbs))
        assert best.tolist() == [min((sum((int(a) - b) ** 2 for a, b in zip(r, c)), e)
                                     for e, c in enumerate(entries))[1] for r in x]
