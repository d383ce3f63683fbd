"""Every query with SQL against DuckDB on the smallest tables; the text queries have their own tests."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from meshloom.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def same(v):
    return None if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_against_sql(spark, db, name):
    df = __spark_entry__.queries()[name](spark, DATA)
    want = db.sql(__spark_entry__.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = [tuple(same(r[c]) for c in columns) for r in df.collect()]
    at = [want.columns.index(c) for c in columns]
    assert sorted(got, key=repr) == sorted((tuple(same(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_every_query_of_the_catalogue_has_sql():
    assert catalogue.QUERIES.keys() == catalogue.ORACLE_SQL.keys()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_filters_reach_the_scan(spark):
    plan = spark.read.parquet(f"{DATA}/supplier.parquet").where("s_acctbal BETWEEN 0 AND 10").select("s_suppkey")
    from meshloom.operators.mesh import in_box

    df = spark.read.parquet(f"{DATA}/supplier.parquet").withColumnsRenamed({"s_acctbal": "lat", "s_nationkey": "lon"}).where(in_box(0, 10, 0, 5)).select("s_suppkey")
    assert "GreaterThanOrEqual(s_acctbal,0.0)" in df._jdf.queryExecution().toString()
    assert plan.columns == df.columns
