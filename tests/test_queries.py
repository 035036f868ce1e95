"""Every registered query against its oracle, and the plans of the large ones."""

import os

import pytest

import __spark_entry__ as contract
from starledger.bindings.catalog import ORACLES, QUERIES
from starledger.bindings.compare import compare, oracle_connection
from starledger.plans.questions import QUESTIONS
from starledger.plans.views import VIEWS

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SHUFFLED = [
    *QUESTIONS, *VIEWS, "resolve_fk_card", "resolve_fk_date", "resolve_fk_product",
    "resolve_fk_store", "resolve_fk_user", "lookup_scalar_country", "inner_join_chain",
    "left_outer_chain", "link_currency_rate", "map_values", "cte_chain", "clean_rates",
    "derive_expr",
]


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_oracle(spark, oracle, name):
    assert compare(QUERIES[name](spark, SF_DIR), oracle, ORACLES.get(name)) is None


@pytest.mark.parametrize("name", SHUFFLED)
def test_shuffled_plan_matches_the_oracle(spark, oracle, large, name):
    assert compare(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name]) is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["clean_dates", "weight_to_kg", "clean_users", "clean_products", "clean_cards"])
def test_cleaning_stays_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["customer_sales_ranked_view", "store_sales_breakdown", "key_dense", "resolve_fk_date"])
def test_no_row_level_exchange_into_one_task(spark, large, name):
    """A single-partition exchange may carry a frequent-item buffer or one total, no rows."""
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    lines = plan(df).split("== Initial Plan ==")[-1].splitlines()
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = " ".join(lines[at + 1 : at + 3])
            assert "partial_" in below or "_rows" in below or "_part" in below, below


def test_scan_reads_only_named_columns(spark):
    df = QUERIES["q4_online_vs_offline"](spark, SF_DIR)
    scan = next(line for line in plan(df).splitlines() if "FileScan" in line)
    assert "l_extendedprice" not in scan and "l_shipdate" not in scan
