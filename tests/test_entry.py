import duckdb
import glob
import os

import __spark_entry__ as entry_point
import pytest

CORE = [n for n in entry_point.oracle_sql() if not n.startswith(("p2", "p3", "p4", "p5", "p6", "p7", "p8"))]


def norm(value):
    if isinstance(value, float):
        return None if value != value else round(value, 9)
    if getattr(value, "tzinfo", None) is not None:
        return value.replace(tzinfo=None)
    return value


@pytest.fixture(scope="module")
def tables(sf):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", CORE)
def test_query_equals_sql(spark, sf, tables, name):
    df = entry_point.queries()[name](spark, sf)
    names = sorted(df.columns)
    mine = sorted((tuple(norm(r[c]) for c in names) for r in df.collect()), key=repr)
    found = tables.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    theirs = sorted((tuple(norm(r[columns.index(c)]) for c in names) for r in found.fetchall()), key=repr)
    assert mine == theirs


def test_entry(spark, sf):
    assert entry_point.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
