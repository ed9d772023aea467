"""Every registered query against its SQL, on the smallest given tables."""

import math
import os

import pytest

import __spark_entry__ as entry_point

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DIR}/{file}'")
    return con


def normal(records):
    def one(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return f"{v:.6f}" if isinstance(v, float) else str(v)

    return sorted(tuple(one(v) for v in r) for r in records)


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, duck, name):
    df = entry_point.queries()[name](spark, DIR)
    columns = sorted(df.columns)
    got = normal(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert got
    sql = entry_point.oracle_sql().get(name)
    if sql is None:
        return
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert sorted(d[0] for d in duck.execute(sql).description) == columns
    assert got == normal(duck.execute(f"SELECT {quoted} FROM ({sql}) q").fetchall())


def test_entry_is_lazy_and_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
