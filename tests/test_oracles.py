"""Differential test: every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from eventlake.plans.queries import ORACLES, QUERIES
from eventlake.session import release_scratch
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    release_scratch(spark)
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["rows"] == r["oracle_rows"]
    assert r["match"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "date_id", "customer_id", "product_id", "session_id",
                          "event_type", "ingestion_time"]
