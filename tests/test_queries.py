"""Every registered query with SQL against the independent engine, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from conftest import SF
from oracle_check import compare, connect

from ledgerline.plans import catalog

QUICK = (
    "A01_csv_scan", "A03_csv_sink", "A05_dual_export", "A32_self_join_pairs", "B06_reconstruct_sessions", "C01_dim_date", "D02_fact_order_item", "D03_fact_session",
    "E01_funnel_stage", "F01_sales_monthly", "F06_cohort_retention", "G01_operations_monthly", "H02_plan_vs_actual_monthly",
    "H04_price_volume_mix", "K07_warehouse_gate", "L05_gini_by_country", "L15_basket_rules", "L19_kruskal_wallis",
    "N06_forecast_accuracy", "Q06_year_over_year", "R08_statement_listing", "R09_funnel_pivot", "R12_retention_matrix",
)
EVERY = sorted(k for k, q in catalog.all_queries().items() if q.sql is not None)
# All of them take several minutes: set LEDGERLINE_EVERY_QUERY=1.
KEYS = EVERY if os.environ.get("LEDGERLINE_EVERY_QUERY") else QUICK


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", KEYS)
def test_against_oracle(spark, con, key):
    status, detail = compare(entry.queries()[key](spark, SF), con, entry.oracle_sql()[key])
    assert status in ("EXACT", "CLOSE"), detail


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 200
