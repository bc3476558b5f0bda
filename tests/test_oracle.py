"""Every registered query against its DuckDB twin on the smallest tables
(the driver repeats this at sf0.01); queries without SQL must run and return
a stable schema."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import digest
from zonecast.plans.tables import TABLES

from .conftest import SMALL

duckdb = pytest.importorskip("duckdb")

QUERIES = E.queries()
ORACLE = E.oracle_sql()
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "label" in df.columns


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(cols) > 0
        return
    rel = con.sql(ORACLE[name])
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    ocols = list(rel.columns)
    orows = rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == types
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]
