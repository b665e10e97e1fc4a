"""Every registered query of the engine against SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tickloom.plans import catalog

DIR = "/root/testdata/sf0.001"


def rows(df):
    names = sorted(df.columns)

    def cell(x):
        if x is None or (isinstance(x, float) and math.isnan(x)) or type(x).__name__ == "NAType":
            return ""
        return f"{float(x) + 0.0:.6f}" if not isinstance(x, str) else x

    return names, sorted(tuple(cell(x) for x in r) for r in df[names].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for t in ("customer", "supplier", "orders", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(set(catalog.oracle_sql()) - {"rolling_1s_by_hour", "feature_matrix_1s_by_hour"}))  # minutes long; test_operators has shorter series
def test_query_matches_sql(spark, sql, name):
    got, want = catalog.queries()[name](spark, DIR).toPandas(), sql.execute(catalog.oracle_sql()[name]).df()
    assert rows(got) == rows(want)
