"""Driver contract: entry point, registry and oracles line up."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "mtype", "delta", "value", "hash"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
