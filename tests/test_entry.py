import os

import duckdb
import pytest

import __spark_entry__
from corroba.plans import queries as engine

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in sorted(os.listdir(FOLDER)):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{FOLDER}/{name}'")
    return con


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(engine.QUERIES))
def test_query(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in got.collect())
    if name in engine.SQL:
        want = duck.execute(engine.SQL[name])
        names = [d[0] for d in want.description]
        assert sorted(names) == columns
        assert rows == sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_sql_is_for_known_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
