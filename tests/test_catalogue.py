"""Every catalogue query against its DuckDB twin on the smallest tables."""

import os

import duckdb
import pytest

from lodestone import catalogue

DATA = "/root/testdata/sf0.001"


def canonical(frame):
    rows = []
    for r in frame[sorted(frame.columns)].itertuples(index=False):
        rows.append(tuple("" if v is None or v != v else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r))
    return sorted(rows)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, DATA).toPandas()
    want = duck.execute(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_queries_without_sql_run(spark):
    for name in set(catalogue.queries()) - set(catalogue.oracle_sql()):
        assert catalogue.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
