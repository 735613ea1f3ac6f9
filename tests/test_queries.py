"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry_points
from check import compare

SQL = entry_points.oracle_sql()
# The corpus operators have tests of their own in tests/llm.
QUERIES = {name: fn for name, fn in entry_points.queries().items() if name != "pipeline" and not re.match(r"op\d+_", name)}


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, sf_dir, name):
    ok, text = compare(spark, con, sf_dir, name, QUERIES[name], SQL[name])
    assert ok, text


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
