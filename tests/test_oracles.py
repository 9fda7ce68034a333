"""Every registered query against its SQL equivalent, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
#: The corpus operators are tested in a folder of their own.
OPTIONAL = {"pipeline"} | {name for name in entry.queries() if name.startswith("op")}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - OPTIONAL))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    assert differences(df, duck, entry.oracle_sql()[name]) is None


def test_registry_is_complete():
    assert set(entry.queries()) - set(entry.oracle_sql()) <= OPTIONAL
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 20
