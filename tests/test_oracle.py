"""Every registered query with an oracle: Spark result == DuckDB result (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, _kind, digest

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    s_kinds = {f.name: _kind(f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(SQL[name])
    d_kinds = {c: _kind(t) for c, t in zip(rel.columns, rel.types)}
    sp, dk = sdf.toPandas(), rel.df()
    assert len(sp) == len(dk)
    assert digest(sp, s_kinds) == digest(dk, d_kinds)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
