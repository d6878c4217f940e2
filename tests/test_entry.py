"""Driver contract: entry, queries and oracles line up."""

import __spark_entry__ as E


def test_keys_consistent():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 40 and len(sql) >= 35
    assert all(callable(f) for f in q.values())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert set(df.columns) == {"p_partkey", "cluster", "dist"}
    assert 0 < len(rows) < 100
