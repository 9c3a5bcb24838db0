"""The registered queries: names, SQL, and the pipeline against brute force, stage by stage."""

import hashlib
from collections import Counter

import duckdb
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from casegauge.llm import bpe
from casegauge.llm.common import table
from casegauge.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tests.llm import test_mixing, test_near_dup, test_quality, test_secrets
from tests.llm.conftest import words


def test_every_operator_is_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
    assert [f for _, f in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5


def test_sql_agrees_on_the_smallest_tables(spark):
    from tools.check_oracle import _rows

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("op3_near_dup", "op5_quality", "op6_sharding", "op8_warc", "op12_vector_codes",
                 "op13_merkle"):
        df = entry.queries()[name](spark, SF_SMALL)
        res = con.execute(entry.oracle_sql()[name])
        cols = [c[0] for c in res.description]
        assert sorted(cols) == sorted(df.columns)
        assert _rows(df.columns, df.collect()) == _rows(cols, res.fetchall()), name


def test_pipeline_stages_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF_SMALL).cache())
    for df in out[:-1]:
        assert df.columns == docs.columns

    rows = [r for r in rows if test_quality.brute(r[1])[5] == 0]
    assert sorted((r.doc_id, r.text) for r in out[1].collect()) == sorted(r[:2] for r in rows)

    _, component = test_near_dup.brute([r[:2] for r in rows], 5)
    rows = [r for r in rows if component[r[0]] == r[0]]
    assert sorted(r.doc_id for r in out[2].collect()) == sorted(r[0] for r in rows)

    clean = {r.doc_id: r.text for r in out[3].collect()}
    assert set(clean) == {r[0] for r in rows}
    for i, text, _ in rows:
        assert (clean[i] == text) == (not test_secrets.brute(text))
        assert not test_secrets.brute(clean[i])

    sizes, largest = Counter(), Counter()
    for i, _, source in rows:
        n = len(words(clean[i]))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    target = test_mixing.rounds(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))})
    taken, copies = Counter(), Counter()
    for r in out[4].collect():
        assert r.text == clean[r.doc_id]
        taken[r.source] += len(words(r.text))
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 2
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)

    library = Tokenizer.from_file(bpe.vocabulary_path())
    final = out[5].collect()
    assert Counter(r.doc_id for r in final) == copies
    for r in final:
        ids = library.encode(clean[r.doc_id], add_special_tokens=False).ids
        assert list(memoryview(bytes(r.ids)).cast("I")) == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(clean[r.doc_id].encode()).hexdigest()


def test_pipeline_runs_as_registered(spark):
    df = entry.queries()["pipeline"](spark, SF_SMALL)
    assert df.count() > 0 and "ids" in df.columns
