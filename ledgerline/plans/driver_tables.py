"""Binds the TPC-H-like tables to the ten source tables of a warehouse.

Every source row is derived from the given parquet tables. Statuses, timelines
and plan defects follow from column values, so they cover all cases the
operators have to handle: early shipments, anonymous sessions, alias spellings,
blank, negative, padded and unmapped plan rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.planning import Comparison
from .warehouse import Derived, Warehouse

COMPARISONS = (
    Comparison("CY1997 vs CY1996", 1, dt.date(1996, 1, 1), dt.date(1996, 12, 31), dt.date(1997, 1, 1), dt.date(1997, 12, 31)),
    Comparison("YTD Jan-Apr 2001 vs 2000", 2, dt.date(2000, 1, 1), dt.date(2000, 4, 30), dt.date(2001, 1, 1), dt.date(2001, 4, 30)),
    Comparison("Apr 2001 vs Apr 2000", 3, dt.date(2000, 4, 1), dt.date(2000, 4, 30), dt.date(2001, 4, 1), dt.date(2001, 4, 30)),
)
FORECAST_END = dt.date(2001, 12, 1)
PLAN_FROM, PLAN_TO = dt.date(2000, 9, 1), dt.date(2001, 12, 1)
# Events are dated in January 2024; this moves them into the order history.
EVENT_SHIFT_DAYS = 8219

# Budget rates and the currency of each region.
FX = (
    ("USD", "US Dollar", "1.000000"),
    ("EUR", "Euro", "1.080000"),
    ("JPY", "Japanese Yen", "0.006700"),
    ("ZAR", "South African Rand", "0.054000"),
    ("AED", "UAE Dirham", "0.272300"),
)
REGION_CURRENCY = {"AMERICA": "USD", "EUROPE": "EUR", "ASIA": "JPY", "AFRICA": "ZAR", "MIDDLE EAST": "AED"}
# Fixed values: (alias spelling, nation, customer segment that uses the spelling).
ALIASES = (("NACION_3", "NATION_3", "BUILDING"), ("NASHI_7", "NATION_7", "MACHINERY"))


# Column types of the tables in use; naming them saves a schema job per read.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def country_spelling() -> str:
    cases = " ".join(f"WHEN n_name = '{n}' AND c_mktsegment = '{s}' THEN '{a}'" for a, n, s in ALIASES)
    return f"CASE {cases} ELSE n_name END"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _read(spark, sf_dir, "nation").join(
        _read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        _read(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "c_custkey AS id",
            "c_name AS first_name",
            "c_name AS last_name",
            "concat(c_name, '@example.com') AS email",
            "18 + CAST(floor((c_acctbal + 1000) / 200) AS INT) AS age",
            "CASE WHEN c_acctbal < 4500 THEN 'f' ELSE ' M' END AS gender",
            "r_name AS state",
            "c_name AS street_address",
            "CAST(c_nationkey AS STRING) AS postal_code",
            "n_name AS city",
            f"{country_spelling()} AS country",
            "c_nationkey * 1.5D AS latitude",
            "c_nationkey * -2.5D AS longitude",
            "c_mktsegment AS traffic_source",
            "TIMESTAMP_NTZ '1994-06-01 00:00:00' + make_dt_interval(c_nationkey) AS created_at",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id",
        "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.6 AS DECIMAL(18,4)) AS cost",
        "p_type AS category",
        "p_name AS name",
        "p_brand AS brand",
        "CAST(p_retailprice AS DECIMAL(18,4)) AS retail_price",
        "CASE WHEN p_size <= 25 THEN 'Small' ELSE 'Large' END AS department",
        "concat('SKU-', p_partkey) AS sku",
        "p_size AS distribution_center_id",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order timeline by priority class: urgent ships at once, low ships before it is created."""
    rank = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
    return (
        _read(spark, sf_dir, "orders")
        .selectExpr("*", f"{rank} AS pr")
        .selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS user_id",
            "CASE WHEN o_orderstatus = 'F' AND pr = 3 THEN 'Returned' WHEN o_orderstatus = 'F' THEN 'Complete' "
            "WHEN o_orderstatus = 'O' AND pr = 4 THEN 'Cancelled' WHEN o_orderstatus = 'O' THEN 'Shipped' "
            "ELSE 'Processing' END AS status",
            "CASE WHEN o_totalprice < 250000 THEN 'f' ELSE 'm' END AS gender",
            "o_orderdate AS created_at",
            "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + make_dt_interval(4 - pr, 0, pr * 17) END AS shipped_at",
            "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + make_dt_interval(4 - pr + pr, 0, pr * 41) END AS delivered_at",
            "CASE WHEN o_orderstatus = 'F' AND pr = 3 THEN o_orderdate + make_dt_interval(9, 0, 5) END AS returned_at",
            "pr AS num_of_item",
        )
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order's owner and date: what items and stock are made of."""
    head = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = _read(spark, sf_dir, "lineitem").join(head, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return joined.drop("o_orderkey", "l_tax")


def order_items(joined: DataFrame) -> DataFrame:
    """Lines as items. The id repeats, as the source's does."""
    return (
        joined.selectExpr(
            "*",
            "CASE WHEN l_returnflag <> 'A' THEN l_shipdate END AS ship",
            "CASE WHEN l_returnflag <> 'A' AND l_linestatus = 'F' THEN l_shipdate "
            "+ make_dt_interval(l_linenumber, 0, CAST(l_quantity AS INT) * 37) END AS deliver",
        )
        .selectExpr(
            "l_orderkey * 10 + l_linenumber AS id",
            "l_orderkey AS order_id",
            "o_custkey AS user_id",
            "l_partkey AS product_id",
            "l_orderkey * 10 + l_linenumber AS inventory_item_id",
            "CASE WHEN l_returnflag = 'R' THEN 'Returned' WHEN l_returnflag = 'A' THEN 'Cancelled' "
            "WHEN l_linestatus = 'F' THEN 'Complete' ELSE 'Shipped' END AS status",
            "o_orderdate AS created_at",
            "ship AS shipped_at",
            "deliver AS delivered_at",
            "CASE WHEN l_returnflag = 'R' THEN deliver + make_dt_interval(3) END AS returned_at",
            "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) "
            "AS sale_price",
            "CAST(l_suppkey AS INT) AS distribution_center_id",
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits: one session per user and day; sign-up events carry no user id."""
    owners = users(spark, sf_dir).selectExpr("id AS owner_id", "city", "state", "postal_code", "traffic_source")
    return (
        _read(spark, sf_dir, "events")
        .join(owners, F.col("user_id") == F.col("owner_id"), "left")
        .withColumn("at", F.col("ts") - F.make_dt_interval(F.lit(EVENT_SHIFT_DAYS)))
        .selectExpr(
            "event_id AS id",
            "CASE WHEN event_type <> 'signup' THEN user_id END AS user_id",
            "event_id AS sequence_number",
            "concat(user_id, '-', CAST(at AS DATE)) AS session_id",
            "at AS created_at",
            "'0.0.0.0' AS ip_address",
            "CASE WHEN event_type <> 'view' THEN city END AS city",
            "state",
            "postal_code",
            "concat('b', user_id % 5) AS browser",
            "traffic_source",
            "concat('/', event_type) AS uri",
            "CASE event_type WHEN 'view' THEN 'product' WHEN 'click' THEN 'cart' WHEN 'purchase' THEN 'purchase' "
            "WHEN 'error' THEN 'cancel' WHEN 'signup' THEN 'home' ELSE event_type END AS event_type",
        )
    )


def inventory_events(joined: DataFrame, products: DataFrame) -> DataFrame:
    """One stocked unit per line; sold when the line is finished."""
    goods = products.select(
        F.col("id").alias("part_id"), "cost", "category", "name", "brand", "retail_price", "department", "sku"
    )
    return (
        joined.join(goods, F.col("l_partkey") == F.col("part_id"), "inner")
        .selectExpr(
            "l_orderkey * 10 + l_linenumber AS id",
            "l_partkey AS product_id",
            "o_orderdate AS created_at",
            "CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS sold_at",
            "cost",
            "category AS product_category",
            "name AS product_name",
            "brand AS product_brand",
            "retail_price AS product_retail_price",
            "department AS product_department",
            "sku AS product_sku",
            "CAST(l_suppkey AS INT) AS product_distribution_center_id",
        )
    )


def distribution_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "s_nationkey * 1.5D AS latitude", "s_nationkey * -2.5D AS longitude"
    )


def country_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _read(spark, sf_dir, "nation").join(
        _read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    own = nations.selectExpr(
        "n_name AS source_country_value",
        "n_name AS canonical_country",
        "r_name AS region",
        "concat(r_name, ' ', n_regionkey) AS sub_region",
        "0 AS is_alias",
        "CAST(NULL AS STRING) AS alias_reason",
    )
    spelled = F.create_map(*[F.lit(x) for a, n, _ in ALIASES for x in (n, a)])
    alias = own.filter(F.col("canonical_country").isin([n for _, n, _ in ALIASES])).withColumns(
        {
            "source_country_value": spelled[F.col("canonical_country")],
            "is_alias": F.lit(1),
            "alias_reason": F.lit("Local spelling used by one customer segment"),
        }
    )
    none = spark.sql("SELECT 'Unknown', 'Unknown', 'Unassigned', 'Unassigned', 0, CAST(NULL AS STRING)")
    return own.unionByName(alias).union(none)


def fx_budget_rates(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{c}', '{n}', CAST({r} AS DECIMAL(18,6)), 'Budget rate')" for c, n, r in FX)
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(currency_code, currency_name, budget_rate_to_usd, rate_basis)"
    )


def plan_submissions(actuals: DataFrame, fx: DataFrame) -> DataFrame:
    """Last year's month plus ten percent in local currency, with defects."""
    spelled = " ".join(f"WHEN region = '{r}' THEN '{c}'" for r, c in REGION_CURRENCY.items())
    based = (
        actuals.withColumn("plan_month", F.add_months("month_start", 12))
        .filter(F.col("plan_month").between(F.lit(PLAN_FROM), F.lit(PLAN_TO)))
        .withColumn("ccy", F.expr(f"CASE {spelled} END"))
    )
    rates = fx.select(F.col("currency_code").alias("ccy"), F.col("budget_rate_to_usd").cast("double").alias("rate"))
    amount = "round(CAST(net_sales_value AS DOUBLE) * 1.1D / rate, 2)"
    return (
        based.join(rates, "ccy", "inner")
        .filter("NOT (canonical_country = 'NATION_9' AND plan_month IN (DATE'2001-03-01', DATE'2001-04-01'))")
        .selectExpr(
            "CASE WHEN plan_month < DATE'2001-01-01' THEN 'FY2000-PLAN-V1' ELSE 'FY2001-PLAN-V1' END AS submission_batch",
            "CASE WHEN canonical_country = 'NATION_12' THEN 'NATION_12 ' "
            "WHEN canonical_country = 'NATION_20' AND plan_month = DATE'2001-02-01' THEN 'NATION-20' "
            "WHEN canonical_country = 'NATION_3' AND plan_month < DATE'2001-01-01' THEN 'NACION_3' "
            "ELSE canonical_country END AS submitted_country",
            "plan_month",
            "CASE WHEN canonical_country = 'NATION_24' AND plan_month = DATE'2001-06-01' THEN 'XXX' "
            "WHEN canonical_country = 'NATION_1' THEN ' usd' ELSE ccy END AS currency_code",
            f"CAST(CASE WHEN canonical_country = 'NATION_5' AND month(plan_month) = 3 THEN NULL "
            f"WHEN canonical_country = 'NATION_8' AND plan_month = DATE'2001-05-01' THEN -{amount} "
            f"ELSE {amount} END AS DECIMAL(18,4)) AS plan_net_sales_local",
            "net_units * 11 DIV 10 AS plan_units",
        )
    )


_BOUND: dict[tuple[str, str], Warehouse] = {}


def bind(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse over one directory of driver tables.

    Kept per application, so that queries share plans (not data): building the
    expressions of a wide plan takes longer than many of the queries.
    """
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BOUND:
        _BOUND[key] = fresh(spark, sf_dir)
    return _BOUND[key]


def fresh(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse of its own, for callers that replace tables by written ones."""
    openers = (
        users, products, orders, lines, events, distribution_centers, country_master
    )
    raw = {f.__name__: (lambda f=f: f(spark, sf_dir)) for f in openers}
    raw["fx_budget_rates"] = lambda: fx_budget_rates(spark)
    raw["order_items"] = Derived(lambda w: order_items(w.raw["lines"]))
    raw["inventory_events"] = Derived(lambda w: inventory_events(w.raw["lines"], w.raw["products"]))
    raw["plan_submissions"] = Derived(lambda w: plan_submissions(w.actual_country_month, w.raw["fx_budget_rates"]))
    return Warehouse(raw, COMPARISONS)
