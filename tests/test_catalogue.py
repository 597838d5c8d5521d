"""Every registered query with SQL gives the SQL's rows."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from plumbline.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    """One form for a value of either engine: pandas widens integers with nulls to floats."""
    if v is None or pd.isna(v):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return int(v) if v.is_integer() else round(v, 6)
    return v


def rows(df):
    names = sorted(df.columns)
    return sorted(repr([plain(v) for v in r]) for r in df[names].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(name, spark, sf, duck):
    got = catalogue.queries()[name](spark, sf).toPandas()
    if name in catalogue.oracle_sql():
        want = duck.execute(catalogue.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got.columns) > 0
