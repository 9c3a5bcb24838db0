import hashlib
import random
import zlib

from pyspark.sql import functions as F

from casegauge.llm import merkle
from tests.llm.conftest import frame

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    values = [None if row[f] is None else str(row[f]) for f in FIELDS]
    return digest(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def path(tree, i, arity):
    out = []
    for level in tree[:-1]:
        run = level[i - i % arity:i - i % arity + arity]
        out.append((run[:i % arity], run[i % arity + 1:]))
        i //= arity
    return out


def brute(rows, arity=8):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {g: levels([leaf(r) for r in groups[g]], arity) for g in order}
    top = levels([trees[g][-1][0] for g in order], arity)
    out = []
    for place, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            proof = path(trees[g], i, arity) + path(top, place, arity)
            other = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                other["text"] = None if r["text"] is None else "".join(
                    c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            at = leaf(other)
            for left, right in proof:
                at = digest(*left, at, *right)
            root = top[-1][0]
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], root,
                        digest(*(h for a, b in proof for h in a + b)), at, at == root))
    return sorted(out, key=str)


def got(df, arity=8):
    return sorted(map(tuple, merkle.verification(df, arity=arity).collect()), key=str)


def corpus(spark, sizes):
    rng = random.Random(3)
    rows = [(i, rng.choice(["Some Text", "other", None, "É a"]), lang, rng.choice(["s", None]),
             rng.choice([4, None]))
            for i, lang in enumerate(x for lang, n in sizes for x in [lang] * n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, "
                                 "n_chars bigint")


def test_equals_the_tree_built_in_a_loop(spark):
    """A hot group, a run of one, exact powers of the arity, more groups than a run."""
    df = corpus(spark, [("en", 129), (None, 64), ("", 8), ("fr", 1), ("z", 9),
                        *((f"l{i}", 2) for i in range(6))]).repartition(5)
    expected = brute([r.asDict() for r in df.collect()])
    assert got(df) == expected
    assert 0 < sum(x[-1] for x in expected) < len(expected)


def test_binary_tree(spark):
    df = corpus(spark, [("en", 21), ("fr", 2), ("de", 1)])
    assert got(df, 2) == brute([r.asDict() for r in df.collect()], 2)


def test_odd_rows(spark, odd, none):
    _, df = odd
    assert got(df) == brute([r.asDict() for r in df.collect()])
    assert merkle.verification(none).collect() == []
    one = frame(spark, [(4, "One Row")])
    assert got(one) == brute([r.asDict() for r in one.collect()])


def test_a_proof_belongs_to_its_leaf(spark):
    """Another leaf, or one flipped sibling, doesn't fold to the root."""
    rows, root = merkle.manifest(corpus(spark, [("en", 30), ("fr", 11)]))
    other = F.unhex(F.sha2(F.lit("other").cast("binary"), 256))
    broken = F.transform("path", lambda run, i: F.when(i == 0, F.struct(
        run["r"].alias("l"), F.concat(run["l"], other).alias("r"))).otherwise(run))
    r = rows.agg(
        F.bool_and(F.lower(F.hex(merkle.fold(F.col("path"), F.col("leaf")))) == root).alias("own"),
        F.bool_or(F.lower(F.hex(merkle.fold(F.col("path"), other))) == root).alias("leaf"),
        F.bool_or(F.lower(F.hex(merkle.fold(broken, F.col("leaf")))) == root).alias("path")).first()
    assert r.own and not r.leaf and not r.path
