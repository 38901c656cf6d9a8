"""Every named query against its comparison SQL in DuckDB, on the smallest data."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
FOLDER = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test data is not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def canonical(names, records):
    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return [names[i] for i in order], sorted(tuple(repr(plain(r[i])) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, str(FOLDER))
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got[1]
        return
    cur = con.execute(sql)
    assert got == canonical([c[0] for c in cur.description], cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_comparison_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
