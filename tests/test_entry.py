"""Every query with SQL gives what DuckDB gives."""

import sys
from pathlib import Path

import duckdb
import pytest

from sparkfolio.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def _plain(rows):
    return sorted(tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in rows) if rows else []


@pytest.mark.skipif(not Path(DATA).exists(), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalog.SQL[name]})").fetchall()
    key = lambda r: tuple(map(str, r))
    got = [tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()]
    want = [tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in want]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_entry_without_llm(spark):
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries()) and set(catalog.SQL) <= set(e.oracle_sql())
    assert e.entry(spark).columns[0] == "user_id"
    assert sys.modules.get("sparkfolio.plans.catalog") is catalog
