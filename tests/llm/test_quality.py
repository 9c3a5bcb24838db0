from collections import Counter

from casegauge.llm import quality
from tests.llm.conftest import frame, words


def brute(text):
    w = words(text)
    text = text or ""
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    m = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
         len(lines) - len(set(lines)), len(covered))
    failed = [m[0] < 10, 100 * m[4] > 20 * m[0], 100 * m[2] > 75 * m[0],
              m[3] >= 5 and 20 * m[3] > m[0], m[1] < 2 * m[0] or m[1] > 40 * m[0]]
    return (*m, sum(1 << i for i, f in enumerate(failed) if f))


def test_ledger_equals_brute_force_on_odd_rows(odd):
    rows, df = odd
    got = [tuple(r) for r in quality.ledger(df).collect()]
    assert sorted(got, key=str) == sorted([(i, *brute(t)) for i, t, _ in rows], key=str)


def test_overlapping_repeats(spark):
    texts = ["a a a a a a a", "a b c d e x a b c d e", "a b c d a b c d a b c d", "a b c d e"]
    got = {r.doc_id: r.n_repeat_words for r in
           quality.measure(frame(spark, list(enumerate(texts)))).collect()}
    assert got == {i: brute(t)[4] for i, t in enumerate(texts)} == {0: 7, 1: 10, 2: 12, 3: 0}


def test_policies_and_ablation_read_only_the_bits(odd):
    _, df = odd
    ledger = quality.ledger(df).cache()
    bits = [r.failed for r in ledger.collect()]
    for policy in quality.POLICIES:
        kept = [r.kept for r in quality.apply_policy(ledger, policy).collect()]
        assert sum(kept) == sum(b & policy.mask == 0 for b in bits)
    for r in quality.ablation(ledger).collect():
        policy = next(p for p in quality.POLICIES if p.version == r.policy)
        bit = quality.bit(r.rule)
        assert r.n_failed == sum(bool(b & bit) for b in bits)
        assert r.n_only == sum(b & policy.mask == bit for b in bits)
        assert r.n_rejected == sum(bool(b & policy.mask) for b in bits)


def test_keep_good_carries_rows_unchanged(odd, none):
    rows, df = odd
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    want = [(i, t) for i, t, _ in rows if brute(t)[5] == 0]
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted(want, key=str)
    assert quality.keep_good(none).count() == quality.ledger(none).count() == 0


def test_no_python_and_no_shuffle_in_the_plan(odd):
    plan = quality.ledger(odd[1])._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))
