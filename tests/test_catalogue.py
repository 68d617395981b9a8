"""Every query of the catalogue against its SQL on the smallest tables."""

import duckdb
import pytest

from cliploom.plans import catalogue
from cliploom.plans.bindings import TABLES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    said = lambda v: f"{v:.5f}" if isinstance(v, float) else repr(v)
    return sorted(tuple(said(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_its_sql(name, spark, sf, duck):
    df = catalogue.QUERIES[name](spark, sf)
    cursor = duck.execute(catalogue.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_query_without_sql_runs(name, spark, sf):
    assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_entry_points_agree(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
