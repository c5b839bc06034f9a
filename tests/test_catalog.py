"""Every query gives the rows of its SQL."""

import pytest

from helpers import DATA, same_rows
from newsloom.plans.catalog import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    ours, theirs = same_rows(QUERIES[name](spark, DATA), SQL[name])
    assert ours == theirs


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
