"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from checks import ORACLES, QUERIES
from compare import connect, differences


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
