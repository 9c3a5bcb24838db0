"""Driver contract: entry() runs, every oracle key is a query, names line up."""

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"criterion", "failed_cases"}


def test_every_query_has_oracle_sql():
    from casegauge.plans.catalogue import REGISTRY

    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert set(REGISTRY) <= set(sql)
    assert len(q) >= 40


def test_every_query_matches_its_oracle_on_the_smallest_tables(spark):
    """The driver's correctness gate, on sf0.001: rows, column names and values of every
    query equal its DuckDB SQL (order-insensitive)."""
    import duckdb

    from casegauge.sources.tables import TABLES
    from tools.check_oracle import _rows

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    bad = []
    for name, fn in entry.queries().items():
        if name not in entry.oracle_sql():
            continue
        df = fn(spark, SF_SMALL)
        srows, scols = df.collect(), df.columns
        res = con.execute(entry.oracle_sql()[name])
        dcols = [d[0] for d in res.description]
        if sorted(scols) != sorted(dcols) or _rows(scols, srows) != _rows(dcols, res.fetchall()):
            bad.append(name)
    assert bad == []


def test_every_query_plans_on_the_smallest_tables(spark):
    from casegauge.plans.catalogue import REGISTRY

    for name, fn in REGISTRY.items():
        if name.startswith("stream_"):
            continue
        df = fn(spark, SF_SMALL)
        assert df.columns, name
