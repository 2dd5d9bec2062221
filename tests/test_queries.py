"""Every registered query against its DuckDB SQL on the smallest data."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from compare import cell
from workloads import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([cell(r[i]) for i in order]) for r in rows)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["box_id", "site_id", "segment", "acctbal"] and df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, db, name):
    df = entry_point.queries()[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = db.execute(entry_point.oracle_sql()[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert got == want
