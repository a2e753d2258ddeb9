"""Every registered query with an oracle equals its DuckDB SQL (sf0.001, whole tables)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, con, SF_SMALL, key)
    assert ok, msg


def test_every_query_has_oracle():
    assert set(E.ALL_QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 50
    assert df.columns == ["icd_code", "diagnosis_name", "total_cases", "unique_patients",
                          "active_cases"]


def test_run_ledger_rows(spark):
    rows = E.queries()["run_ledger"](spark, SF_SMALL).collect()
    assert len(rows) == 1 and rows[0]["status"] == "success" and rows[0]["stamped"]
