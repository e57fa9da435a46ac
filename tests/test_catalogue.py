"""Every query against DuckDB on the smallest tables, and the contract's shape."""

from __future__ import annotations

import pytest

import __spark_entry__
from tests.util import duck, same_rows
from tidemark.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_sql(spark, small, name):
    same_rows(catalogue.QUERIES[name](spark, small), duck(small, catalogue.ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, small, name):
    assert catalogue.QUERIES[name](spark, small).count() > 0


def test_contract(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_stream_equals_batch(spark, small):
    batch = catalogue.QUERIES["dedup_state_machine"](spark, small)
    stream = catalogue.QUERIES["dedup_stream"](spark, small)
    rows = lambda df: sorted(map(tuple, df.select("event_id", "verdict").collect()))
    assert rows(batch) == rows(stream)
