"""Every query with SQL against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if not n.startswith("op") and n != "pipeline"))
def test_query(spark, duck, name):
    df = E.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(normal(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in E.oracle_sql():
        cursor = duck.execute(E.oracle_sql()[name])
        names = [c[0] for c in cursor.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert got == sorted((tuple(normal(r[i]) for i in at) for r in cursor.fetchall()), key=repr)


def test_entry(spark):
    assert E.entry(spark).count() > 0
