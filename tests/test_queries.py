import os

import duckdb
import pandas as pd
import pytest

from inkplane.plans import queries as Q


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    c.execute("set TimeZone = 'UTC'")
    for name in os.listdir(sf_dir):
        c.execute(f"create view {name.removesuffix('.parquet')} as select * from '{sf_dir}/{name}'")
    return c


def plain(df, columns):
    df = df[columns].astype(object).where(df[columns].notna(), None)
    return df.sort_values(columns, key=lambda s: s.astype(str)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql_agrees(spark, sf_dir, con, name):
    want, got = con.execute(Q.oracle_sql()[name]).df(), Q.queries()[name](spark, sf_dir).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    pd.testing.assert_frame_equal(plain(want, columns), plain(got, columns), check_dtype=False, check_exact=True)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1410
    assert set(e.oracle_sql()) <= set(e.queries())
