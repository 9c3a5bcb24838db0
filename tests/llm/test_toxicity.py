import zlib

import numpy as np

from casegauge.llm import toxicity
from casegauge.llm.common import table
from tests.llm.conftest import frame

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model)
    rows = scored.join(labels.where("toxic is not null"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    test = [(r.score, r.toxic) for r in rows if r.held_out]
    bad = np.array([s for s, t in test if t == 1])
    fine = np.array([s for s, t in test if t == 0])
    assert (bad[:, None] > fine[None, :]).mean() > 0.95
    assert (bad >= 0.3).mean() > 0.9 and (fine >= 0.3).mean() < 0.06


def test_unseen_misspellings_score_by_their_grams():
    rng = np.random.default_rng(1)
    clean = ["".join(rng.choice(list("aeioulmnrst"), rng.integers(2, 8))) for _ in range(300)]
    texts, toxic = [], []
    for i in range(400):
        w = list(rng.choice(clean, 60))
        if i % 4 == 0:
            w[30] = ["horridbeast", "wickedfool"][i % 8 // 4]
        texts.append(" ".join(w))
        toxic.append(i % 4 == 0)
    model = toxicity.fit(texts, np.array(toxic))
    plain = " ".join(rng.choice(clean, 60))
    odd = plain + " horridbeasst " + plain
    assert model.score([odd])[0] > 0.5 > model.score([plain])[0]


def test_odd_rows(spark, odd, none):
    rows, df = odd
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, 0), (None, 1), (5, None)],
                                   "doc_id bigint, toxic int")
    got = toxicity.score(df, toxicity.train(df, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    blank = toxicity.train(none, labels.limit(0))
    assert toxicity.score(none, blank).count() == 0
    assert {r.predicted for r in toxicity.score(df, blank).collect()} == {0}


def test_slices_do_not_change_scores(spark):
    texts = ["one two three " * 20, "", "four", "x" * 5000]
    model = toxicity.Model(np.random.default_rng(1).normal(
        size=1 << toxicity.BUCKET_BITS).astype(np.float32), 0.1)
    assert np.allclose(model.score(texts), [model.score([t])[0] for t in texts])
    assert frame(spark, []).count() == 0


def test_a_repeated_id_gives_one_training_text(spark):
    rows = [(1, f"text {i}") for i in range(300)] + [(3, "other"), (4, "clean words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 0)], "doc_id bigint, toxic int")
    texts, toxic = toxicity.sample(docs, labels, "doc_id", "text", "toxic")
    assert len(texts) <= 3 and sorted(texts)[-1:] in (["text 0"], ["other"]) and len(toxic) == len(texts)
