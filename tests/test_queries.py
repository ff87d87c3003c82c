"""Every registered query against its SQL, and the contract of the entry module."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from foldmill.oracles import ORACLES
from foldmill.queries import QUERIES
from oracle import difference


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir) is None
