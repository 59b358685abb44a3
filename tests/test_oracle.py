"""Every registered key with an SQL oracle matches DuckDB on the same parquet."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SMALL
from oracle_harness import compare

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, key):
    problems, n_spark, n_duck = compare(spark, key, QUERIES[key], ORACLE[key], SMALL)
    assert not problems, "\n".join(problems)


def test_every_oracle_key_is_registered():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "monthly_rank" in df.columns
