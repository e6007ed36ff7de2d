"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from slabwise.plans import QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
from compare import compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert name in contract.oracle_sql()
    assert compare(spark, SF_DIR, name) == []


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["unnamed0", "stdev"] and df.count() == 500
