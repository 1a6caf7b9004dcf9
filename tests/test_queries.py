"""Every registered query against its SQL in another engine, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from flowloom.plans.checks import checks
from flowloom.plans.queries import QUERIES
from tools.compare import compare, connect

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, data, name):
    ok, note = compare(spark, con, data, name)
    assert ok, note
    assert "TYPES" not in note, note


def test_every_check_has_a_query():
    assert set(checks()) <= set(NAMES) <= set(entry.queries())


def test_every_query_has_sql():
    assert set(NAMES) == set(checks())


def test_flagship_runs(spark):
    labels = {row.label for row in entry.entry(spark).select("label").distinct().collect()}
    assert labels == {"HTTP", "SMTP"}
