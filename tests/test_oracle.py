"""Every catalog query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _norm(df):
    df = df[sorted(df.columns)]
    out = []
    for r in df.itertuples(index=False):
        vals = []
        for v in r:
            if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and pd.isna(v)):
                vals.append("NULL")
            elif isinstance(v, float):
                vals.append(f"{v:.6g}")
            elif hasattr(v, "isoformat"):
                vals.append(pd.Timestamp(v).isoformat())
            else:
                vals.append(str(v))
        out.append("|".join(vals))
    return sorted(out)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{os.path.join(SF_SMALL, f)}'")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got) == _norm(want)


def test_every_query_runs(spark):
    for name, fn in E.queries().items():
        df = fn(spark, SF_SMALL)
        assert df.columns, name


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"]
    assert df.count() > 0
