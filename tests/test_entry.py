"""Driver contract: entry smoke check and registry consistency."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["attribute", "elements", "min", "max", "mean", "std"]
    assert len(rows) == 5


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert all(name in o for name in q if not name.startswith("op") and name != "pipeline")
