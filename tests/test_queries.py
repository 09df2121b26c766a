"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from hackney.plans import PLANS
from tests.conftest import SF_DIR
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query_agrees_with_sql(spark, duck, name):
    sql = entry_points.oracle_sql()[name]
    assert difference(entry_points.queries()[name](spark, SF_DIR), sql, duck) is None


def test_entry_has_rows_and_a_stable_schema(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["window_start", "window_end", "total_fare", "tips_fare", "total_trip_total"]
    assert not result.isEmpty()
