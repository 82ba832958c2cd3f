"""Registration, and the queries that SQL can express against DuckDB."""

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import ORACLE_DIR
from tests.oracle_check import compare, duck
from tillflow.llm import queries


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, key):
    r = compare(spark, key, ORACLE_DIR, duck(ORACLE_DIR))
    assert r["status"] == "match", r


def test_one_query_per_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry_mod.queries())
