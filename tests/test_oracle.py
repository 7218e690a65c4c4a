"""Every registered query with a SQL form gives DuckDB's rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, norm

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(norm(v) for v in r)) for r in df.select(*cols).collect())
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = sorted(repr(tuple(norm(r[i]) for i in order)) for r in cur.fetchall())
    assert got == want
