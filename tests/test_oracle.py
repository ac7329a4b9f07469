"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_queries import compare  # noqa: E402
from snapstats.plans.registry import oracle_sql, queries  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, name):
    result = compare(spark, SMALL, name, queries()[name], oracle_sql().get(name))
    assert result.startswith("ok") and "differ" not in result, result


def test_entry(spark):
    import __spark_entry__
    df = __spark_entry__.entry(spark)
    assert df.count() == 50 and "view_count" in df.columns
