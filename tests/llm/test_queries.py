"""The registered queries of this package against their SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from flowloom.llm.queries import QUERIES, SQL
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, con, data, name):
    ok, note = compare(spark, con, data, name)
    assert ok, note


def test_registered_once_for_each_number():
    assert [n for n in QUERIES if n.startswith("op")] == sorted(
        (n for n in QUERIES if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert len(QUERIES) == 11 and set(QUERIES) <= set(entry.queries())
