"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

from emberlog.catalog import oracle_sql, queries
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"
NAMES = sorted(queries())


def test_every_query_has_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    assert compare(spark, SF, [name]) == []


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert "window_start" in df.columns
