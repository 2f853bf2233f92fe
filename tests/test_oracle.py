"""Every query with checking SQL gives the same rows as that SQL."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from tests.conftest import SF_DIR

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(df):
    names = sorted(df.columns)
    cells = df[names].itertuples(index=False, name=None)
    return names, sorted(
        tuple("NULL" if pd.isna(x) else repr(x.item() if hasattr(x, "item") else x) for x in row) for row in cells
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    assert rows(QUERIES[name](spark, SF_DIR).toPandas()) == rows(duck.execute(ORACLES[name]).df())


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() == 24
