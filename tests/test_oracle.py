"""Every catalog query against DuckDB. ORACLE_SF_DIR picks another data folder."""

import os

import pytest

import __spark_entry__ as contract
import compare
from daygrain.plans import catalog, oracle

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle.oracle_sql()
QUERIES = catalog.QUERIES
MODEL_ONLY = {"risk_report", "scenario_summary_trained", "model_coefficients", "risk_scores"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample data")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(SQL) == MODEL_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), duck, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
