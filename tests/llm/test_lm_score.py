from collections import Counter, defaultdict
from math import log

from casegauge.llm import lm_score
from casegauge.llm.common import Scratch, table
from tests.conftest import SF_SMALL


def brute(texts, target):
    """Interpolated Witten-Bell by its definition: per text (tokens, mean losses)."""
    n = lm_score.ORDER
    vocabulary = {c for t in texts for c in t or ""}

    def losses(training):
        seen = [defaultdict(Counter) for _ in range(n)]
        for t in training:
            padded = ["^"] * (n - 1) + list(t or "")
            for i in range(n - 1, len(padded)):
                for k in range(n):
                    seen[k][tuple(padded[i - k:i])][padded[i]] += 1

        def p(context, c, k):
            low = 1 / len(vocabulary) if k == 0 else p(context[1:], c, k - 1)
            here = seen[k].get(context)
            if not here:
                return low
            return (here[c] + len(here) * low) / (sum(here.values()) + len(here))

        def mean(t):
            padded = ["^"] * (n - 1) + list(t)
            return sum(-log(p(tuple(padded[i - n + 1:i]), padded[i], n - 1))
                       for i in range(n - 1, len(padded))) / len(t)
        return mean
    a, b = losses([texts[i] for i in target]), losses(texts)
    return [(len(t), a(t), b(t)) if t else (0, None, None) for t in texts]


TEXTS = ["abab abab", "the cat", None, "", "é👍é", "abab abab", "x", "the the the cat", "\x00\n"]


def check(rows, want):
    assert len(rows) == len(want)
    for r in rows:
        n, a, b = want[r.doc_id]
        assert r.n_tokens == n
        if n:
            assert abs(r.ce_target - a) < 1e-9 and abs(r.ce_background - b) < 1e-9
            assert abs(r.score - (a - b)) < 1e-9
        else:
            assert (r.ce_target, r.ce_background, r.score) == (None, None, 0.0)


def frames(spark, target):
    docs = spark.createDataFrame([(i, t, 1, "t", 5) for i, t in enumerate(TEXTS)],
                                 "doc_id bigint, text string, ctx int, target string, tok int")
    return docs, spark.createDataFrame([(i,) for i in target], "doc_id bigint")


def test_equals_the_definition(spark):
    for target in ([1, 7], [0], []):
        docs, ids = frames(spark, target)
        check(lm_score.cross_entropy_difference(docs, ids).collect(), brute(TEXTS, target))


def test_joined_path_equals_the_broadcast(spark):
    docs, ids = frames(spark, [1, 7])
    marked = docs.select("doc_id", "text", docs.doc_id.isin(1, 7).alias("target"))
    model = Scratch(spark).stage(lm_score.train(lm_score.count_grams(marked)), "model")
    check(lm_score.score(docs, model, max_rows=0).collect(), brute(TEXTS, [1, 7]))


def test_empty_tables_and_repeats(spark):
    docs, ids = frames(spark, [1])
    assert lm_score.cross_entropy_difference(docs.limit(0), ids).count() == 0
    twice = lm_score.cross_entropy_difference(docs.unionAll(docs), ids)
    assert twice.count() == 2 * len(TEXTS)


def test_good_documents_score_lower(spark):
    labels = table(spark, SF_SMALL, "labels")
    rows = lm_score.cross_entropy_difference(
        table(spark, SF_SMALL, "documents"), labels.where("quality = 1").select("doc_id"))
    means = {r.quality: r.m for r in rows.join(labels, "doc_id").groupBy("quality").agg(
        {"score": "avg"}).withColumnRenamed("avg(score)", "m").collect()}
    assert means[1] < means[0]
