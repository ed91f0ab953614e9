"""Every registered query against its DuckDB oracle (sf0.001), compared like the driver does."""

import threading

import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import TABLES
from tools.oracle_check import SPARK_TO_DUCK, table_hash

from .conftest import SF_SMALL

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_callable():
    assert len(QUERIES) >= 90
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    # as the driver does: inside a view, with a time limit
    con.execute(f"CREATE OR REPLACE VIEW oracle AS {ORACLES[name]}")
    watch = threading.Timer(30, con.interrupt)
    watch.start()
    try:
        rel = con.execute("SELECT * FROM oracle")
    finally:
        watch.cancel()
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    assert stypes == {c: str(t) for c, t in zip(dcols, con.sql('SELECT * FROM oracle').types)}
    assert len(srows) == len(drows)
    assert table_hash(sdf.columns, srows)[0] == table_hash(dcols, drows)[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 1


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 150
    assert df.columns == ["c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment"]
