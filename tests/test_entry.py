"""The driver contract, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["word", "n", "freq_pct", "cum_freq_pct"] and out.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.ORACLES) == set(entry.QUERIES)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_sql(spark, name):
    line, same, detail = compare(spark, connect(SF), SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert same, f"{line}\n{detail}"
