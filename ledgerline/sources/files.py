"""Reading the source files, exporting tables, run metadata."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import checkpoint_folder
from ..plans.warehouse import SOURCES, Warehouse
from . import quoted
from .schemas import schema

# Source tables whose texts people type, so that a field may hold a line break.
MULTI_LINE = ("users", "products", "country_master", "plan_submissions")
# Tables of the two export sets and of the quality set.
MODEL_TABLES = (
    "dim_date", "dim_customer", "dim_product", "dim_distribution_center", "dim_session_traffic_source",
    "dim_acquisition_source", "fact_order", "fact_order_item", "fact_session", "fact_inventory", "funnel_stage_channel",
    "funnel_monthly_channel", "channel_quality", "acquisition_source_value", "cart_abandonment_segments", "sales_monthly",
    "customer_360", "cohort_retention", "product_performance_category", "product_performance_brand",
    "geography_performance_country", "delivery_performance_dc", "operations_monthly", "return_risk_segments",
    "inventory_performance", "dim_country", "dim_market", "dim_month", "fact_plan", "actual_country_month",
    "plan_vs_actual_monthly", "plan_vs_actual_region", "price_volume_mix", "commercial_scorecard",
)
ANALYSIS_TABLES = (
    "executive_snapshot", "channel_quality", "funnel_monthly_channel", "acquisition_source_value",
    "cart_abandonment_segments", "sales_monthly", "product_performance_category", "product_performance_brand",
    "geography_performance_country", "cohort_retention", "delivery_performance_dc", "operations_monthly",
    "return_risk_segments", "inventory_performance", "plan_vs_actual_monthly", "plan_vs_actual_region",
    "price_volume_mix", "commercial_scorecard",
)
QUALITY_TABLES = (
    "raw_test_results", "test_results", "plan_validation", "plan_rejects", "metric_reconciliation",
    "reconciliation_statement",
)
# Facts written by month, and the date key the month is taken from.
MONTHLY = {
    "wide_order_item": "order_date_key",
    "fact_order_item": "order_date_key",
    "fact_order": "order_date_key",
    "fact_session": "session_date_key",
    "fact_inventory": "inventory_created_date_key",
}
# Tables that others are built on; each step is planned on the files of the steps before it.
BUILD_STEPS = (
    ("dim_customer", "dim_product", "dim_date", "stg_sessions"),
    ("wide_order_item", "fact_session", "fact_order", "fact_inventory"),
    ("sales_monthly", "actual_country_month", "customer_360"),
    ("fact_plan", "price_volume_mix"),
    ("plan_vs_actual_monthly", "commercial_scorecard"),
)


class MissingSource(FileNotFoundError):
    """A file of the source contract is absent."""


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def missing_files(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    return [p for p in paths if not _exists(spark, p)]


def check_source_files(spark: SparkSession, folder: str, tables: Sequence[str] = SOURCES) -> list[str]:
    """Paths of the contract; raises before any job if one is missing."""
    paths = [f"{folder.rstrip('/')}/{t}.csv" for t in tables]
    absent = missing_files(spark, paths)
    if absent:
        raise MissingSource("missing source files: " + ", ".join(absent))
    return paths


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """RFC 4180: quotes are doubled inside quoted fields, an empty field is NULL.

    The header is checked against the contract, and a line with too few or too many
    fields fails the job. Quoted line breaks are allowed in the tables of
    ``MULTI_LINE``, whose records are found by counting quotes; large files are split.
    """
    if table in MULTI_LINE:
        return quoted.read(spark, path, schema(table))
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .schema(schema(table))
        .csv(path)
    )


def open_warehouse(spark: SparkSession, folder: str, comparisons=()) -> Warehouse:
    """A warehouse over a folder with one CSV per source table."""
    paths = check_source_files(spark, folder)
    raw = {t: (lambda t=t, p=p: read_csv(spark, p, t)) for t, p in zip(SOURCES, paths)}
    return Warehouse(raw, comparisons)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """RFC 4180 with a header; blanks around a value are kept, NULL is an empty field.

    A compressed file is read by one task; ``read_csv`` finds the codec by the file names.
    """
    (
        df.write.mode("overwrite")
        .option("compression", compression)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Zstandard parquet. Partitioned output is rebalanced first: a large month is
    split over several tasks and small months share one."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def _together(work: Callable[[str], None], names: Sequence[str], at_once: int) -> None:
    """Call ``work`` for each name, ``at_once`` at a time; the jobs of small tables then share the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(work, name) for name in names]:
            done.result()


def export_tables(
    warehouse: Warehouse,
    folder: str,
    names: Sequence[str],
    formats: Sequence[str] = ("parquet", "csv"),
    at_once: int = 1,
) -> dict[str, int]:
    """Write tables, ``at_once`` at a time, and return the row counts of what was written.

    With both formats the table is computed once: CSV is written from the parquet,
    whose footers hold the count.
    """
    planned = {name: warehouse.table(name) for name in names}
    counts: dict[str, int] = {}

    def write(name: str) -> None:
        df = planned[name]
        if "parquet" in formats:
            path = f"{folder}/parquet/{name}"
            write_parquet(df, path)
            df = df.sparkSession.read.parquet(path)
        if "csv" in formats:
            write_csv(df, f"{folder}/csv/{name}")
        counts[name] = df.count()

    _together(write, names, at_once)
    return {name: counts[name] for name in names}


def materialize(
    warehouse: Warehouse, names: Sequence[str], folder: str | None = None, at_once: int = 1
) -> dict[str, str]:
    """Write tables once and let everything built on them read the files.

    The default folder is the shared one the cluster names. Facts are laid out by
    month, so a date filter prunes directories. Each group of ``at_once`` names is
    written together and planned on the groups before it.
    """
    paths: dict[str, str] = {}
    for first in range(0, len(names), at_once):
        planned = {name: warehouse.table(name) for name in names[first : first + at_once]}
        for name, df in planned.items():
            paths[name] = f"{folder or f'{checkpoint_folder(df.sparkSession)}/tables'}/{name}"

        def write(name: str, planned=planned) -> None:
            df = planned[name]
            if name in MONTHLY:
                key = F.floor(F.col(MONTHLY[name]) / 100).cast("int")
                write_parquet(df.withColumn("month_key", key), paths[name], ["month_key"])
            else:
                write_parquet(df, paths[name])

        _together(write, list(planned), at_once)
        for name, df in planned.items():
            warehouse.use(name, df.sparkSession.read.parquet(paths[name]).select(*df.columns))
    return paths


def build(
    warehouse: Warehouse, folder: str, formats: Sequence[str] = ("parquet", "csv"), at_once: int = 4
) -> dict[str, int]:
    """The whole warehouse: shared tables once, then every model table and gate; row counts by table."""
    for step in BUILD_STEPS:
        materialize(warehouse, step, f"{folder}/shared", at_once=len(step))
    return export_tables(warehouse, folder, (*MODEL_TABLES, *QUALITY_TABLES), formats, at_once)


def run_metadata(
    spark: SparkSession,
    path: str,
    row_counts: Mapping[str, int],
    status: DataFrame,
    elapsed_seconds: float,
    sources: Sequence[str] = SOURCES,
) -> dict:
    """Row counts, gate status and run time of one build, as a one-row JSON."""
    record = {
        "source_files": list(sources),
        "tables": [{"table": t, "rows": int(n)} for t, n in row_counts.items()],
        "qa_status": {r["status"]: int(r["checks"]) for r in status.collect()},
        "elapsed_seconds": round(float(elapsed_seconds), 3),
    }
    spark.createDataFrame([(json.dumps(record),)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
    return record
