"""Every query with an oracle against DuckDB, at the smallest size."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def cells(rows):
    return sorted(tuple("" if v is None else repr(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith(("op", "pipeline"))))
def test_against_oracle(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = cells(df.select(*(f"`{c}`" for c in columns)).collect())
    want = cells(duck.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({entry.oracle_sql()[name]})").fetchall())
    assert got == want and got


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
