"""Every registered query that SQL can express, against DuckDB."""

import pytest
from oracle_check import compare

import __spark_entry__ as entry


# Some minutes of boosting; tests/oracle_check.py compares it, and test_models.py searches a small grid.
SLOW = {"random_search_results"}


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, sf_dir, name):
    outcome = compare(spark, sf_dir, name, entry.queries()[name], entry.oracle_sql()[name])
    assert outcome.startswith("ok"), outcome


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 4
