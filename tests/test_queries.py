"""Every registered query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__
from strandline.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def plain(x):
    if x is None or x != x:
        return None
    return round(float(x), 7) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def same(spark, f, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(sql)
    names = sorted(rel.columns)
    want = [dict(zip(rel.columns, r, strict=True)) for r in rel.fetchall()]
    df = f(spark, SF)
    assert sorted(df.columns) == names
    rows = lambda data: sorted([tuple(plain(r[n]) for n in names) for r in data], key=repr)
    assert rows(r.asDict() for r in df.collect()) == rows(want)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, name):
    same(spark, catalogue.QUERIES[name], catalogue.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 200
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
