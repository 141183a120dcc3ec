"""Fact tables at order, item, session, unit and plan grain.

Facts join plainly to their dimensions. Spark broadcasts a dimension when its
size is under the threshold and otherwise shuffles both sides, where adaptive
execution splits a partition made large by one hot customer or product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import MONEY, UNKNOWN
from ..functions.measures import band, exact_sum, flag, ratio
from ..functions.times import (
    as_date,
    date_key,
    days_between,
    lead_days,
    seconds_between,
    timeline_is_valid,
)

CANCELLED, RETURNED, COMPLETE = "Cancelled", "Returned", "Complete"
# Stock age buckets.
AGE_BUCKET_EDGES = (31, 61, 91, 181)
AGE_BUCKETS = ("0-30 days", "31-60 days", "61-90 days", "91-180 days", "181+ days")
# Fixed values, in order of precedence: the reasons for which a plan row is quarantined.
REJECT_REASONS = (
    ("flag_unmapped_country", "Country not present in the country master"),
    ("flag_missing_fx_rate", "No budget FX rate for the submitted currency"),
    ("flag_blank_target", "Plan value is blank"),
    ("flag_negative_target", "Plan value is negative"),
)


def attach(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, columns: Sequence[str]) -> DataFrame:
    """Bring dimension attributes onto the fact; those already there are not joined again."""
    missing = [c for c in columns if c not in facts.columns]
    if not missing:
        return facts
    side = dim.select(F.col(dim_key).alias("_dim_key"), *missing)
    return facts.join(side, F.col(fact_key) == F.col("_dim_key"), "inner").drop("_dim_key")


def _timeline(created: str) -> list[Column]:
    c, s, d, r = (F.col(x) for x in (created, "shipped_at", "delivered_at", "returned_at"))
    return [
        lead_days(c, s).alias("ship_lead_days"),
        lead_days(s, d).alias("delivery_lead_days"),
        lead_days(c, d).alias("end_to_end_lead_days"),
        lead_days(d, r).alias("return_cycle_days"),
        timeline_is_valid(c, s, d, r).alias("valid_timeline_flag"),
    ]


def fact_order(orders: DataFrame, customers: DataFrame) -> DataFrame:
    status = F.col("order_status")
    owners = customers.select("user_id", "acquisition_source")
    return orders.join(owners, "user_id", "inner").select(
        "order_id",
        F.col("user_id").alias("customer_id"),
        "order_status",
        F.col("created_at").alias("order_created_at"),
        "shipped_at",
        "delivered_at",
        "returned_at",
        date_key(F.col("created_at")).alias("order_date_key"),
        "item_count",
        "acquisition_source",
        *_timeline("created_at"),
        flag(status == CANCELLED).alias("cancelled_order_flag"),
        flag(status == RETURNED).alias("returned_order_flag"),
        flag(status == COMPLETE).alias("completed_order_flag"),
    )


def fact_order_item(
    items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    product_columns: Sequence[str] = (),
    customer_columns: Sequence[str] = (),
) -> DataFrame:
    """Item fact. Every status other than Cancelled and Returned counts as net.

    ``product_columns`` and ``customer_columns`` ride along on the two joins
    this operator makes anyway, so that the marts need not repeat them. The
    centre is the product's.
    """
    product_side = products.select(
        "product_id",
        "unit_cost",
        F.col("distribution_center_id").alias("_product_center"),
        *product_columns,
    )
    customer_side = customers.select("user_id", "acquisition_source", *customer_columns)
    # customers first: their attributes are narrower to carry through the second shuffle
    wide = items.join(customer_side, "user_id", "inner").join(product_side, "product_id", "inner")
    price, margin = F.col("sale_price"), F.col("sale_price") - F.col("unit_cost")
    status, none = F.col("item_status"), F.lit(0).cast(MONEY)
    is_net = ~status.isin(CANCELLED, RETURNED)
    return wide.select(
        "order_item_id",
        "order_id",
        F.col("user_id").alias("customer_id"),
        "product_id",
        "inventory_item_id",
        F.col("_product_center").alias("distribution_center_id"),
        "acquisition_source",
        "item_status",
        F.col("created_at").alias("order_item_created_at"),
        "shipped_at",
        "delivered_at",
        "returned_at",
        date_key(F.col("created_at")).alias("order_date_key"),
        "sale_price",
        "unit_cost",
        margin.alias("gross_margin_value"),
        F.when(price > 0, ratio(margin, price)).alias("gross_margin_rate"),
        price.alias("gross_sales_value"),
        F.when(status == CANCELLED, price).otherwise(none).alias("cancelled_value"),
        F.when(status == RETURNED, price).otherwise(none).alias("returned_value"),
        F.when(is_net, price).otherwise(none).alias("net_sales_value"),
        F.when(is_net, margin).otherwise(none).alias("net_profit_value"),
        flag(status == CANCELLED).alias("cancelled_item_flag"),
        flag(status == RETURNED).alias("returned_item_flag"),
        flag(status.isin(COMPLETE, RETURNED)).alias("return_observation_eligible_flag"),
        *_timeline("created_at"),
        *product_columns,
        *customer_columns,
    )


def fact_session(sessions: DataFrame, customers: DataFrame) -> DataFrame:
    """Session fact; anonymous sessions stay, with country 'Unknown'."""
    start, end = F.col("session_start_at"), F.col("session_end_at")
    viewed, cart, bought = (F.col(c) == 1 for c in ("product_view_flag", "cart_flag", "purchase_flag"))
    homes = customers.select("user_id", F.col("country").alias("_country"))
    stage = (
        F.when(bought, "Purchase")
        .when(cart, "Cart")
        .when(viewed, "Product")
        .when(F.col("department_flag") == 1, "Department")
        .otherwise("Home")
    )
    return sessions.join(homes, "user_id", "left").select(
        "session_id",
        F.col("user_id").alias("customer_id"),
        "session_start_at",
        "session_end_at",
        date_key(start).alias("session_date_key"),
        "browser",
        "traffic_source",
        F.coalesce("_country", F.lit(UNKNOWN)).alias("country"),
        "event_count",
        "events_with_user_id",
        "event_identity_coverage_rate",
        flag(F.col("events_with_user_id") > 0).alias("identified_session_flag"),
        F.when(end >= start, seconds_between(start, end)).alias("session_duration_seconds"),
        "first_event_type",
        "final_event_type",
        "home_flag",
        "department_flag",
        "product_view_flag",
        "cart_flag",
        "purchase_flag",
        "cancel_event_flag",
        flag(cart & ~bought).alias("cart_abandoned_flag"),
        flag(viewed & ~cart & ~bought).alias("early_product_exit_flag"),
        stage.alias("highest_stage"),
    )


def latest_date(df: DataFrame, stamp: str) -> Column:
    """The newest date of a table as a scalar subquery, evaluated once."""
    return df.agg(F.max(stamp).cast("date")).scalar()


def fact_inventory(inventory: DataFrame, as_of: Column) -> DataFrame:
    """One row per unit. ``as_of`` is a date: a literal or a scalar subquery.

    The rule in use elsewhere is the newest event date, which is not the same
    as the newest item date used for customer recency.
    """
    sold = F.col("sold_at").isNotNull()
    dated = inventory.withColumn("_as_of", as_of)
    age = F.datediff("_as_of", as_date(F.col("created_at")))
    return dated.select(
        "inventory_item_id",
        "product_id",
        "distribution_center_id",
        F.col("created_at").alias("inventory_created_at"),
        "sold_at",
        date_key(F.col("created_at")).alias("inventory_created_date_key"),
        "unit_cost",
        "retail_price",
        flag(sold).alias("sold_flag"),
        F.when(F.col("sold_at") >= F.col("created_at"), days_between(F.col("created_at"), F.col("sold_at"))).alias(
            "days_to_sell"
        ),
        F.when(~sold, age).alias("unsold_age_days"),
        F.when(sold, "Sold")
        .otherwise(band(age, AGE_BUCKET_EDGES, AGE_BUCKETS, None))
        .alias("inventory_age_bucket"),
    )


def _rejected() -> Column:
    test = F.lit(False)
    for name, _ in REJECT_REASONS:
        test = test | (F.col(name) == 1)
    return test


def fact_plan(plan: DataFrame) -> DataFrame:
    """Accepted rows added up per market, month, currency and rate."""
    return (
        plan.filter(~_rejected())
        .groupBy(
            "canonical_country",
            "region",
            "sub_region",
            "plan_month",
            date_key(F.col("plan_month")).alias("plan_date_key"),
            "currency_code",
            "budget_rate_to_usd",
        )
        .agg(
            exact_sum("plan_net_sales_local").cast(MONEY).alias("plan_net_sales_local"),
            exact_sum("plan_net_sales_usd").cast(MONEY).alias("plan_net_sales_usd"),
            F.sum("plan_units").alias("plan_units"),
            F.max("submission_batch").alias("submission_batch"),
        )
    )


def plan_rejects(plan: DataFrame) -> DataFrame:
    """Quarantined rows with the first reason that applies."""
    reason = F.coalesce(*[F.when(F.col(name) == 1, F.lit(text)) for name, text in REJECT_REASONS])
    return plan.filter(_rejected()).select(
        "submission_batch",
        "submitted_country",
        "plan_month",
        "currency_code",
        "plan_net_sales_local",
        reason.alias("reject_reason"),
    )
