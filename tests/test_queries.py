"""Every registered query of the engine against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from plenaria.plans import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.6g}"
    return f"{float(x):.6g}" if type(x).__name__ == "Decimal" else str(x)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, db, name):
    got = registry.QUERIES[name](spark, FOLDER)
    asked = db.execute(registry.ORACLES[name])
    columns = sorted(c[0] for c in asked.description)
    assert sorted(got.columns) == columns
    at = [[c[0] for c in asked.description].index(c) for c in columns]
    want = sorted(tuple(plain(r[k]) for k in at) for r in asked.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got.collect()) == want


def test_most_queries_have_sql():
    assert set(registry.QUERIES) - set(registry.ORACLES) <= {"html_paragraphs"}
