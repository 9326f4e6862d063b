"""Each registered query gives what its SQL gives on DuckDB."""

import pytest
from oracle import compare, duck

from funnelbook.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    ok, message = compare(spark, con, name, sf)
    assert ok, message


def test_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["client", "start", "end"]
    assert df.count() > 0
