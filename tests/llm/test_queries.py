"""The registered queries against their SQL, on whole tables."""

from __future__ import annotations

import pytest

from hackney.llm import queries
from tests.conftest import SF_DIR
from tests.oracle import connect, difference


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), queries.SQL[name], connect(SF_DIR)) is None
