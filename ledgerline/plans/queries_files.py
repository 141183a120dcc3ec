"""Queries for the file operators: whole tables written to the shared folder and read again."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import gates, staging
from ..sources import files
from ..sources.schemas import COLUMNS
from .queries_quality import GATES, PARTS, every_gate
from .registry import register
from .session import checkpoint_folder
from .warehouse import SOURCES, Warehouse

EXPORTED = ("fact_order", "fact_session")
_COUNTS = "SELECT 'fact_order' AS table_name, COUNT(*) AS n_rows FROM w_orders UNION ALL SELECT 'fact_session', COUNT(*) FROM w_sessions"


def _folder(w: Warehouse) -> str:
    return f"{checkpoint_folder(w.raw['orders'].sparkSession)}/files-{uuid.uuid4().hex}"


def _as_text(w: Warehouse, table: str) -> DataFrame:
    """The source table as the contract's text columns."""
    return w.raw[table].select(*[F.col(c).cast("string") for c in COLUMNS[table].split()])


def _through_csv(w: Warehouse, table: str) -> DataFrame:
    path = f"{_folder(w)}/{table}.csv"
    files.write_csv(_as_text(w, table), path)
    return files.read_csv(w.raw[table].sparkSession, path, table)


def _contract(w: Warehouse) -> DataFrame:
    folder = _folder(w)
    for table in SOURCES:
        # what is read split by split, to find quoted line breaks, stays plain
        codec = "none" if table in files.MULTI_LINE else "gzip"
        files.write_csv(_as_text(w, table), f"{folder}/{table}.csv", codec)
    spark = w.raw["orders"].sparkSession
    read = files.open_warehouse(spark, folder).raw
    counted = [read[t].agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for t in SOURCES]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out


def _parquet(w: Warehouse) -> DataFrame:
    path = _folder(w)
    files.write_parquet(w.stg_orders, path)
    return w.raw["orders"].sparkSession.read.parquet(path)


def _exported(w: Warehouse) -> DataFrame:
    """Counts that the export reports, beside the lines of its CSV files."""
    folder, spark = _folder(w), w.raw["orders"].sparkSession
    counts = files.export_tables(w, folder, EXPORTED)
    out = None
    for table, n in counts.items():
        lines = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/csv/{table}")
        one = lines.agg(F.lit(table).alias("table_name"), F.lit(n).cast("long").alias("n_rows"), F.count(F.lit(1)).alias("csv_rows"))
        out = one if out is None else out.unionByName(one)
    return out


def _metadata(w: Warehouse) -> DataFrame:
    start = time.monotonic()
    folder, spark = _folder(w), w.raw["orders"].sparkSession
    counts = files.export_tables(w, folder, EXPORTED, formats=("parquet",))
    status = gates.gate_status(*every_gate(w))
    files.run_metadata(spark, f"{folder}/run", counts, status, time.monotonic() - start)
    record = spark.read.text(f"{folder}/run").select(
        F.from_json("value", "tables array<struct<table: string, rows: bigint>>, qa_status map<string, bigint>").alias("r")
    )
    tables = record.select(F.inline("r.tables").alias("name", "n"))
    return tables.unionByName(record.select(F.explode("r.qa_status").alias("name", "n")))


_SOURCE_PARTS = ("w_users", "w_products", "w_orders", "w_lines", "w_events", "w_stock", "w_centers", "w_master", "w_fx", "w_plan_raw")

register("A01_csv_scan", lambda w: staging.stage_products(_through_csv(w, "products")), "SELECT * FROM w_products", doubles=["unit_cost", "retail_price"])
register("A02_file_contract", _contract,
         " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {part}" for t, part in zip(SOURCES, _SOURCE_PARTS)))
register("A03_csv_sink", lambda w: staging.stage_orders(_through_csv(w, "orders")), "SELECT * FROM w_orders")
register("A04_parquet_sink", _parquet, "SELECT * FROM w_orders")
register("A05_dual_export", _exported, f"SELECT table_name, n_rows, n_rows AS csv_rows FROM ({_COUNTS})")
register("A06_run_metadata", _metadata,
         f"SELECT table_name AS name, n_rows AS n FROM ({_COUNTS}) UNION ALL SELECT status, COUNT(*) FROM ({GATES}) GROUP BY 1", parts=PARTS)
