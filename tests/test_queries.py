"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import differences

SF_DIR = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["minute_bucket", "icao24"] and df.count() > 0


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    if name in ORACLE:
        assert differences(df, ORACLE[name], SF_DIR) is None
    else:
        assert df.count() > 0
