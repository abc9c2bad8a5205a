"""Every registered query against its SQL on the smallest given tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerloom.catalog import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables are missing")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    return None if v is None else str(v)


def _sorted(rows):
    return sorted(rows, key=lambda r: [(c is not None, c or "") for c in r])


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    ours = [tuple(_cell(r[c]) for c in order) for r in df.collect()]
    theirs = [tuple(_cell(r[names.index(c)]) for c in order) for r in expected]
    assert _sorted(ours) == _sorted(theirs)


def test_every_ledger_query_has_sql():
    assert REGISTRY.keys() <= SQL.keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 12
