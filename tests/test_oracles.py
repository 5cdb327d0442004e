"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duckdb_with_views
from tickforge.plans import catalog

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con(small_dir):
    return duckdb_with_views(small_dir)


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, small_dir, con, name):
    sdf = catalog.QUERIES[name](spark, small_dir).toPandas()
    odf = con.execute(catalog.oracle_sql()[name]).df()
    assert len(sdf) > 0
    # Floats within 1e-9 relative: the fan-out view sums each tick n
    # times, the closed form multiplies once (last-bit differences only).
    assert compare(sdf, odf) is None


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["instrument_name", "currency", "bucket"]
    assert df.count() > 0
