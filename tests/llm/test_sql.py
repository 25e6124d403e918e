"""Queries of corpus operators that SQL can express give the rows of that SQL."""

import duckdb
import pandas as pd
import pytest

from thalweg.llm import queries

SF = "/root/testdata/sf0.001"


def _plain(v):
    if v is None or pd.isna(v):
        return None
    return v if isinstance(v, (str, bool)) else round(float(v), 9) + 0.0


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in "documents pages conversations labels benchmark".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    columns = got.columns
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(map(_plain, r)) for r in got.collect()), key=key) == sorted((tuple(map(_plain, r)) for r in want), key=key)
