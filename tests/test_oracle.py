"""Every registered query against its DuckDB oracle on sf0.001 (the driver
does the same at sf0.01)."""

import re

import duckdb
import pytest

from helpers import SF_SMALL

import __spark_entry__ as entry

# The training-data queries (opN_..., pipeline) are a removable part with tests of their own.
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {k: v for k, v in entry.queries().items() if not OWN.match(k)}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if not OWN.match(k)}


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


def _sorted(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("events", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _sorted([tuple(_norm(r[c]) for c in cols) for r in df.collect()])
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = _sorted([tuple(_norm(r[i]) for i in idx) for r in res.fetchall()])
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "day", "arenalevel", "cnt_o", "cnt", "rate"]
    assert df.count() > 0
