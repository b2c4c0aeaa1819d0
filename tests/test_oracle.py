"""Spark queries vs their DuckDB oracle on the smallest supplied tables."""


def test_every_oracle_of_the_reports(spark):
    from tests.oracle_runner import compare
    from voxpop.plans import catalog
    catalog.load_all()
    bad = compare(spark, sorted(catalog.ORACLE), sf_dir="/root/testdata/sf0.001", verbose=False)
    assert bad == []


def test_every_query_has_a_callable_and_named_oracle():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and abs(sum(r["pct"] for r in rows) - 100) < 1e-6
