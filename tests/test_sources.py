"""CSV contract, exports and table materialisation."""

import csv
import glob
import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import types as T

from ledgerline.plans.driver_tables import bind
from ledgerline.plans.session import checkpoint_folder
from ledgerline.sources import files, quoted, schemas


def write_sources(tmp_path, skip=()):
    rows = {
        "users": ['1,A,B,a@b.c,34,f,CA,1 Street,,  ,España,1.5,2.5,Search,2024-01-01 10:00:00',
                  '2,C,D,c@d.e,x,M,,2 Street,9,Rome,Spain,,,,2024-01-02 10:00:00'],
        "products": ["1,4.5,Cat,Name,,10.0,Dept,S1,1"],
        "orders": ["7,1,Complete,F,2024-02-01 00:00:00,,2024-02-02 00:00:00,2024-02-03 12:00:00,1"],
        "order_items": ["70,7,1,1,700,Complete,2024-02-01 00:00:00,2024-02-02 00:00:00,2024-02-03 12:00:00,,10.0"],
        "events": ["1,1,1,s1,2024-02-01 00:00:00,1.2.3.4,Rome,,,Chrome,Email,/,Purchase",
                   "2,,2,  ,2024-02-01 00:00:05,1.2.3.4,Rome,,,Chrome,Email,/,home"],
        "inventory_events": ["700,1,2024-01-01 00:00:00,2024-02-01 00:00:00,4.5,Cat,Name,Brand,10.0,Dept,S1,1"],
        "distribution_centers": ["1, Main ,1.0,2.0"],
        "country_master": ["Spain,Spain,EMEA,Iberia,0,", "España,Spain,EMEA,Iberia,1,Local spelling"],
        "fx_budget_rates": ["EUR,Euro,1.08,Budget"],
        "plan_submissions": ["B1,España ,2024-02-01,eur,100.0,3"],
    }
    for table, lines in rows.items():
        if table not in skip:
            text = "\n".join([",".join(schemas.COLUMNS[table].split()), *lines]) + "\n"
            (tmp_path / f"{table}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(files.MissingSource, match="events.csv"):
        files.open_warehouse(spark, write_sources(tmp_path, skip=("events",)))


def test_csv_to_marts(spark, tmp_path):
    w = files.open_warehouse(spark, write_sources(tmp_path))
    users = {r.user_id: r for r in w.stg_users.collect()}
    assert (users[1].city, users[1].postal_code, users[1].country, users[1].gender, users[2].age) == (None, None, "España", "F", None)
    assert users[2].acquisition_source == "Unknown"
    assert not {"first_name", "email", "street_address"} & set(w.stg_users.columns)
    assert "ip_address" not in w.stg_events.columns
    assert w.stg_products.first().brand == "Unknown"
    assert w.stg_distribution_centers.first().distribution_center_name == "Main"
    assert w.stg_sessions.count() == 1 and w.stg_events.filter("session_id IS NULL").count() == 1
    item = w.fact_order_item.first()
    assert (item.ship_lead_days, item.delivery_lead_days, float(item.net_profit_value)) == (1.0, 1.5, 5.5)
    plan = w.fact_plan.first()
    assert (plan.canonical_country, float(plan.plan_net_sales_usd)) == ("Spain", 108.0)
    assert w.geography_performance_country.first().source_spellings == "España"
    assert {r.check_name for r in w.raw_test_results.filter("status = 'FAIL'").collect()} == {"events_session_id_present"}


def test_bad_identifier_fails(spark, tmp_path):
    folder = write_sources(tmp_path)
    (tmp_path / "distribution_centers.csv").write_text("id,name,latitude,longitude\nx,Main,1,2\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.open_warehouse(spark, folder).stg_distribution_centers.collect()


def test_export_counts_and_metadata(spark, warehouse, tmp_path):
    out = str(tmp_path / "export")
    counts = files.export_tables(warehouse, out, ["dim_country", "channel_quality"])
    assert counts["dim_country"] == 28
    assert spark.read.parquet(f"{out}/parquet/dim_country").count() == 28
    assert spark.read.option("header", True).csv(f"{out}/csv/dim_country").count() == 28
    assert all(".zstd." in p for p in glob.glob(f"{out}/parquet/dim_country/*.parquet"))
    status = spark.createDataFrame([("PASS", 3)], "status string, checks long")
    files.run_metadata(spark, f"{out}/meta", counts, status, 1.2345)
    (part,) = glob.glob(f"{out}/meta/part-*")
    assert json.load(open(part))["qa_status"] == {"PASS": 3}


def test_materialized_tables_give_the_same_marts(spark, warehouse, tmp_path):
    from ledgerline.plans import driver_tables

    fresh = driver_tables.fresh(spark, "/root/testdata/sf0.001")
    files.materialize(fresh, ["wide_order_item", "dim_date"], str(tmp_path / "gold"))
    assert os.path.isdir(tmp_path / "gold" / "wide_order_item" / "month_key=199701")
    key = lambda rows: sorted(map(tuple, rows))
    assert key(fresh.sales_monthly.collect()) == key(warehouse.sales_monthly.collect())


def test_build_writes_what_the_lazy_tables_give(spark, warehouse, tmp_path):
    from ledgerline.plans import driver_tables

    counts = files.build(driver_tables.fresh(spark, "/root/testdata/sf0.001"), str(tmp_path), formats=("parquet",))
    assert list(counts) == [*files.MODEL_TABLES, *files.QUALITY_TABLES]
    key = lambda df: sorted(map(str, df.collect()))
    for name in ("customer_360", "plan_vs_actual_region", "raw_test_results"):
        written = spark.read.parquet(f"{tmp_path}/parquet/{name}")
        assert key(written) == key(warehouse.table(name)), name
        assert counts[name] == written.count()


def test_checkpoint_folder(spark):
    class Named:
        """A session whose cluster names a folder."""

        conf = type("C", (), {"get": staticmethod(lambda key, default=None: "/shared/folder")})
        sparkContext = spark.sparkContext

    assert checkpoint_folder(Named) == "/shared/folder"
    own = checkpoint_folder(spark)  # unset here: one folder for the whole session
    assert own and own == checkpoint_folder(spark)


def test_warehouse_needs_every_source(spark):
    from ledgerline.plans.warehouse import Warehouse

    with pytest.raises(ValueError, match="events"):
        Warehouse({"users": spark.range(1)})
    assert bind(spark, "/root/testdata/sf0.001") is bind(spark, "/root/testdata/sf0.001/")


def test_csv_is_rfc_4180(spark, tmp_path):
    folder = write_sources(tmp_path)
    head = ",".join(schemas.COLUMNS["products"].split())
    lines = ['1,4.5,Cat,"Chino ""Slim"", 32 in",B,10.0,Dept,S1,1', '2,4.5,Cat,"two\nlines", C ,10.0,Dept,S2,1', "3,4.5,Cat,,,10.0,Dept,S3,1"]
    (tmp_path / "products.csv").write_text("\n".join([head, *lines]) + "\n", encoding="utf-8")
    rows = {r.id: r for r in files.read_csv(spark, f"{folder}/products.csv", "products").collect()}
    assert (rows["1"].name, rows["1"].brand, rows["1"].retail_price) == ('Chino "Slim", 32 in', "B", "10.0")
    assert (rows["2"].name, rows["2"].brand, rows["3"].name) == ("two\nlines", " C ", None)
    files.write_csv(files.read_csv(spark, f"{folder}/products.csv", "products"), f"{tmp_path}/out")
    again = {r.id: r for r in files.read_csv(spark, f"{tmp_path}/out", "products").collect()}
    assert again == rows
    text = "".join(open(f).read() for f in glob.glob(f"{tmp_path}/out/*.csv"))
    assert '"Chino ""Slim"", 32 in"' in text
    (tmp_path / "products.csv").write_text("\n".join([head, "1,4.5,Cat"]) + "\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        files.read_csv(spark, f"{folder}/products.csv", "products").select("id").collect()


def test_compressed_csv_reads_the_same(spark, tmp_path):
    rows = [("1", 'a "b", c', " x ", None, *[""] * 5)]
    columns = schemas.COLUMNS["orders"].split()
    df = spark.createDataFrame([r[: len(columns)] for r in rows], ", ".join(f"{c} STRING" for c in columns))
    for codec in ("none", "gzip"):
        files.write_csv(df, str(tmp_path / codec), codec)
    assert glob.glob(f"{tmp_path}/gzip/*.csv.gz") and not glob.glob(f"{tmp_path}/none/*.gz")
    plain, packed = (files.read_csv(spark, str(tmp_path / codec), "orders").collect() for codec in ("none", "gzip"))
    assert plain == packed and packed[0][1:4] == ('a "b", c', " x ", None)


def test_use_drops_plans_on_the_old_table(spark, tmp_path):
    w = bind(spark, "/root/testdata/sf0.001")
    w = type(w)(dict(w.raw), w.comparisons)
    old, untouched = w.sales_monthly, w.dim_customer
    files.materialize(w, ["wide_order_item"], folder=str(tmp_path))
    assert w.sales_monthly is not old and w.dim_customer is untouched
    assert any("wide_order_item" in f for f in w.sales_monthly.inputFiles())
    assert not any("lineitem" in f for f in w.customer_360.inputFiles())
    marked = w.wide_order_item
    files.materialize(w, ["stg_products"], folder=str(tmp_path / "b"))
    assert w.wide_order_item is marked  # a written table stays


def test_python_parts_run_from_another_folder(tmp_path):
    code = (
        "import sys; sys.path.insert(0, '/root/repo')\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "q = e.queries()\n"
        "for k in ('L18_chi_square_p_value', 'N04_holt_winters_log'): print(k, q[k](s, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


QUOTED = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "a", "b")])


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_quoted_breaks_across_splits(spark, tmp_path, small_splits, ending):
    rng = random.Random(3)
    rows = [(str(i), *("".join(rng.choice(["a", "bc", '"', ",", ending, " ", "é"]) for _ in range(rng.randint(0, 7))) for _ in "ab")) for i in range(600)]
    rows[300] = ("300", ("long" + ending) * 900, '"')  # one record over several splits
    folder = tmp_path / "in"
    folder.mkdir()
    for k in (0, 1):  # a folder of two files, each with its header
        with open(folder / f"{k}.csv", "w", encoding="utf-8", newline="") as f:
            writer = csv.writer(f, lineterminator=ending)
            writer.writerow(["id", "a", "b"])
            writer.writerows(rows[k::2])
    assert quoted._split_starts(quoted._lines(spark, str(folder))).count() > 12
    made = sorted(tuple(r) for r in quoted.read(spark, str(folder), QUOTED).collect())
    single = spark.read.options(header=True, enforceSchema=False, nullValue="", quote='"', escape='"', multiLine=True, mode="FAILFAST")
    assert made == sorted(tuple(r) for r in single.schema(QUOTED).csv(str(folder)).collect())
    assert made == sorted((i, a.replace(ending, "\n") or None, b.replace(ending, "\n") or None) for i, a, b in rows)


@pytest.mark.parametrize("text, message", [
    ("id,a,b\n1,2,3\n4,5\n", "MALFORMED_RECORD"),
    ("id,a,b\n1,2,3,4\n", "MALFORMED_RECORD"),
    ('id,a,b\n1,2,"3\n4,5,6\n', "not closed"),
    ("id,b,a\n1,2,3\n", "header does not conform"),
])
def test_quoted_files_that_break_the_contract(spark, tmp_path, text, message):
    (tmp_path / "x.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        quoted.read(spark, str(tmp_path / "x.csv"), QUOTED).select("id").collect()


def test_quoted_file_without_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('"id",A,b\n\n  \n')
    assert quoted.read(spark, str(tmp_path / "x.csv"), QUOTED).collect() == []
