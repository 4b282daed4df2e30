"""The registered queries against their SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from skyplan import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(df):
    def text(x):
        if not isinstance(x, list) and pd.isna(x):
            return "null"
        return repr(float(x)) if not isinstance(x, (str, list)) and hasattr(x, "__float__") else str(x)

    cols = sorted(df.columns)
    return sorted(tuple(text(x) for x in r) for r in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query(spark, con, name):
    a, b = plans.QUERIES[name](spark, SF).toPandas(), con.sql(plans.ORACLE_SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert plain(a) == plain(b)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_rows_only(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 150
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
