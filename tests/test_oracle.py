"""Every named query against its SQL oracle on the small tables."""

import compare
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert without <= set(entry.LLM_QUERIES)
    flagship = entry.entry(spark)
    assert flagship.columns[:2] == ["year_num", "month_num"] and flagship.count() > 0


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_QUERIES)))
def test_query(spark, con, name):
    assert compare.difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None
