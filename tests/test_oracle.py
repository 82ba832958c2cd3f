"""Every registered query against its DuckDB oracle (the driver's check)."""

import pytest

from tests.conftest import ORACLE_DIR

import __spark_entry__ as entry_mod
from tests.oracle_check import compare, duck
from tillflow.plans import ORACLE_SQL, QUERIES

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(ORACLE_DIR)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, ORACLE_DIR, con)
    assert r["status"] in ("match", "rows-only"), r


def test_every_query_but_shake_has_an_oracle():
    assert set(QUERIES) - set(ORACLE_SQL) == {"row_hash_shake"}
    assert set(QUERIES) <= set(entry_mod.queries())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["order_id", "product_id", "quantity"]
    assert df.count() > 0
