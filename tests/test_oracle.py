"""Every registered query against DuckDB over the same tables."""

import pytest

import __spark_entry__ as entry_points
from chatlake.queries import ORACLE, QUERIES
from oracle import difference, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    frame = entry_points.queries()[name](spark, sf_dir)
    assert difference(frame, con, entry_points.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_gives_rows(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["example_index", "turn_index", "text", "split"]
    assert frame.count() > 0
