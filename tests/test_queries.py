"""Every registered query against its SQL at the smallest scale."""

import check_queries
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check_queries.duck(SF_DIR)


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    count, difference = check_queries.compare(
        spark, duck, SF_DIR, entry.queries()[name], entry.oracle_sql().get(name)
    )
    assert not difference
