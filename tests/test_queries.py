"""Every query with SQL against its twin, on the smallest tables."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracle import compare, duckdb_tables

TEXT = re.compile(r"op\d+_|pipeline$")  # tested in tests/llm
LONG = {"gbt_scores", "search_trials", "attribution_top20"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_tables(sf_dir)


@pytest.mark.parametrize("name", [n for n in queries() if n not in LONG and not TEXT.match(n)])
def test_query_equals_its_sql(spark, connection, sf_dir, name):
    assert compare(spark, connection, name, sf_dir) == ""


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    own = {n for n in queries() if not TEXT.match(n)}
    assert own - set(oracle_sql()) == LONG | {"smote"}


def test_entry_has_a_stable_schema(spark):
    df = entry(spark)
    assert df.columns[:2] == ["day_of_week", "hour_of_day"] and df.count() > 0
