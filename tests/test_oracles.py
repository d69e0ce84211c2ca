"""Every registered query against its DuckDB statement."""

import pytest

import __spark_entry__ as driver
from fixtures.compare import difference
from fixtures.registry import ORACLES, QUERIES

# Queries that are legitimately empty on the smallest data set.
MAY_BE_EMPTY = {"points_outside_dem", "depth_runs", "stream_runs", "stream_runs_rasters"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf, name):
    rows, problem = difference(spark, duck, sf, name)
    assert problem is None
    assert rows > 0 or name in MAY_BE_EMPTY


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["cell", "wse_cell_weighted_average", "elevation", "depth"]
    assert df.count() > 0
