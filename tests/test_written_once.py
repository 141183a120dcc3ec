"""Results whose branches share tables that are written once."""

import datetime as dt
import re

import pytest

from ledgerline.plans import catalog, driver_tables
from ledgerline.plans.warehouse import _only

TABLES = {
    "region": [(0, "AFRICA"), (1, "AMERICA")],
    "nation": [(3, "NATION_3", 0), (9, "NATION_9", 1)],
    "customer": [
        (1, "a", 3, 100.0, "BUILDING"), (2, "b", 9, 5000.0, "MACHINERY"), (2, "b", 9, 5000.0, "MACHINERY"), (4, None, None, None, None),
    ],
    "supplier": [(1, "s", 3, 1.0)],
    "part": [(1, "p", "B1", "T1", 5, 900.0), (2, "q", "B2", None, 30, 20.0)],
    "orders": [
        (1, 1, "F", 10.0, dt.datetime(2000, 3, 5), "3-MEDIUM"), (2, 2, "O", 20.0, dt.datetime(2000, 4, 7), "1-URGENT"),
        (3, 7, "P", 30.0, dt.datetime(2001, 1, 2), "5-LOW"), (3, 2, "O", 30.0, dt.datetime(2001, 1, 3), "4-NOT SPECIFIED"),
    ],
    "lineitem": [
        (1, 1, 1, 1, 3.0, 500.0, 0.1, 0.0, "R", "F", dt.datetime(2000, 3, 9)), (1, 2, 1, 2, 1.0, 80.0, 0.0, 0.0, "N", "F", None),
        (1, 2, 1, 2, 1.0, 80.0, 0.0, 0.0, "N", "F", dt.datetime(2000, 3, 1)), (2, 1, 1, 1, 2.0, 70.0, 0.0, 0.0, "A", "O", dt.datetime(2000, 5, 1)),
        (3, 9, 1, 1, 2.0, 60.0, 0.0, 0.0, "N", "O", dt.datetime(2001, 2, 1)), (3, None, 1, 3, None, None, None, None, None, None, None),
        (8, 1, 1, 1, 2.0, 50.0, 0.0, 0.0, "N", "O", dt.datetime(2001, 2, 1)),
    ],
    "events": [
        (1, dt.datetime(2024, 1, 3), 1, "view", 1.0, None), (2, dt.datetime(2024, 1, 3), 1, "purchase", 1.0, None),
        (3, dt.datetime(2024, 1, 4), None, "signup", None, None),
    ],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, rows in TABLES.items():
        spark.createDataFrame(rows, driver_tables.SCHEMAS[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


PLAIN = {
    "K07_warehouse_gate": lambda w: w.test_results,
    "K08_commercial_gate": lambda w: w.plan_validation,
    "K08_06_actuals_tie_to_fact_order_item": lambda w: w.commercial_gate("actuals_tie_to_fact_order_item"),
    "K10_reconciliation_statement": lambda w: w.reconciliation_statement,
}


@pytest.mark.parametrize("key", PLAIN)
def test_lines_are_joined_once_and_give_the_same_rows(spark, folder, key):
    w = driver_tables.fresh(spark, folder)
    plain = driver_tables.fresh(spark, folder)
    found = catalog.all_queries()[key].on(w)
    assert not [f for f in found.inputFiles() if "/lineitem.parquet/" in f]
    wanted = PLAIN[key](plain).select(*found.columns)
    as_text = lambda df: sorted(map(str, df.selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in found.dtypes]).collect()))
    rows = as_text(found)
    assert rows == as_text(wanted)
    assert rows


def test_columns_left_out_are_null_and_unknown_ones_are_refused(spark):
    df = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    assert _only(df, ["k"]).schema.simpleString() == df.schema.simpleString()
    assert _only(df, ["k"]).collect() == [(1, None)]
    with pytest.raises(ValueError, match="no such columns: z"):
        _only(df, ["z"])


@pytest.mark.parametrize("key", ["K10_reconciliation_statement", "R08_statement_listing"])
def test_the_statement_joins_nothing_but_what_it_has_written(spark, folder, key):
    found = catalog.all_queries()[key].on(driver_tables.fresh(spark, folder))
    assert not re.search("Join (Inner|Left|Right|Full|Cross)", found._jdf.queryExecution().optimizedPlan().toString())
    assert not [f for f in found.inputFiles() if f"{folder}/" in f]


def test_columns_left_out_are_not_in_the_files(spark, folder):
    w = driver_tables.fresh(spark, folder)
    lines = w.written_once({"lines": ["l_partkey"]}).raw["lines"]
    items = w.written_once({"wide_order_item": ["order_id", "item_status"]}).wide_order_item
    for table, plain, kept in ((lines, w.raw["lines"], {"l_partkey"}), (items, w.wide_order_item, {"order_id", "item_status"})):
        assert set(spark.read.parquet(*table.inputFiles()).columns) == kept
        assert table.dtypes == plain.dtypes
        assert table.count() == plain.count()
        assert {c for r in table.collect() for c, v in r.asDict().items() if v is not None} == kept
