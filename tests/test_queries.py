"""Every registered query with SQL gives the rows of that SQL."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from thalweg.plans import registry

SF = "/root/testdata/sf0.001"


def _plain(v):
    if isinstance(v, (list, np.ndarray)):
        return str([_plain(x) for x in v])
    if v is None or pd.isna(v):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    return round(float(v), 9) + 0.0 if isinstance(v, (int, float, np.number)) else str(v)


def rows(frame, columns):
    return sorted([tuple(_plain(v) for v in r) for r in frame[columns].astype(object).to_numpy()], key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name not in registry.ORACLE_SQL:
        assert len(got)
        return
    want = duck.execute(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)
