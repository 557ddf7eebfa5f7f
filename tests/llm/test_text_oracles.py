"""Text queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest
from compare import connect, differences
from pricevault.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def test_a_query_for_each_operator():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [next(q for q in names if q.startswith(f"op{n}_")) for n in range(1, 14)]
    assert "pipeline" in names
