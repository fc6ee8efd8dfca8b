"""Every query with an oracle equals DuckDB's result on the same tables (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import digest

SQLS = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con(sf):
    from offerlens.sources.tables import TABLES
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, sf, con, name):
    sdf = QUERIES[name](spark, sf)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(SQLS[name])
    dcols = rel.columns
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    so = sorted(range(len(scols)), key=lambda i: scols[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    hs = digest([tuple(r[i] for i in so) for r in srows])[0]
    hd = digest([tuple(r[i] for i in do) for r in drows])[0]
    assert len(srows) == len(drows)
    assert hs == hd


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["contract_type", "salary_avg"]
    assert df.count() > 0
