"""Registered queries vs their DuckDB SQL on the smallest driver tables."""
import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF
from tools.check_oracle import TABLES, digest

SKIP = {"shingles"}   # large row count, covered at sf0.01 by tools/check_oracle.py


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SKIP))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["source", "n_docs", "first_seen", "position"]
