"""Every registered query of the landscape operators against the SQL that states its result, on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from marshlight.plans import registry
from marshlight.plans.fixtures import BASE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 5) + 0.0
        return int(v) if v.is_integer() else v
    return v


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(repr([plain(x) for x in r]) for r in df[cols].values.tolist())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name in registry.ORACLE:
        assert rows(got) == rows(duck.execute(registry.ORACLE[name]).df())
    else:
        assert len(got.columns)
