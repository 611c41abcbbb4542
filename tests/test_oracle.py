"""Every registered query against its DuckDB oracle on the smallest driver tables,
plus the driver contract of ``__spark_entry__``."""

import os

import pytest

from subledger.plans.registry import QUERIES

SF = os.environ.get("SUBLEDGER_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    from tests.oracle_compare import duck_connection
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    from tests.oracle_compare import compare
    r = compare(spark, duck, name, SF, verbose=True)
    assert r["status"] in ("match", "no-oracle"), r
    assert "types" not in r, r["types"]


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and df.columns
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 40
