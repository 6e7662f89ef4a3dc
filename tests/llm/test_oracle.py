"""Queries that SQL can express, against DuckDB over whole tables."""

import pytest

import __spark_entry__ as E
from dockplan.llm.registry import ORACLE
from tests.oracle_check import compare, duck


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_against_oracle(spark, sample, key):
    assert E.oracle_sql()[key] == ORACLE[key]
    r = compare(spark, duck(sample), sample, key, E.queries()[key], ORACLE[key])
    assert r["match"], r
