"""Typing, trimming and renaming of the source tables. No row is added or lost.

Names, e-mail, street address and IP are not selected, so personal data stops
at this layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import (
    MONEY,
    RATE,
    blank_to_null,
    maybe_double,
    maybe_int,
    maybe_long,
    maybe_money,
    must,
    or_unknown,
)
from ..functions.measures import flag

STAGES = ("home", "department", "product", "cart", "purchase", "cancel")


def _stamp(df: DataFrame, name: str) -> Column:
    """Source instants carry no zone and are read as UTC."""
    kind = df.schema[name].dataType.typeName()
    return F.col(name) if kind in ("timestamp_ntz", "timestamp") else F.col(name).cast("timestamp_ntz")


def stage_users(raw: DataFrame) -> DataFrame:
    return raw.select(
        must("id", "bigint").alias("user_id"),
        maybe_int(raw, "age").alias("age"),
        F.upper(F.trim(F.col("gender").cast("string"))).alias("gender"),
        *[blank_to_null(c).alias(c) for c in ("state", "postal_code", "city", "country")],
        maybe_double("latitude").alias("latitude"),
        maybe_double("longitude").alias("longitude"),
        or_unknown("traffic_source").alias("acquisition_source"),
        _stamp(raw, "created_at").alias("registered_at"),
    )


def stage_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        must("id", "bigint").alias("product_id"),
        maybe_money(raw, "cost").alias("unit_cost"),
        or_unknown("category").alias("category"),
        or_unknown("name").alias("product_name"),
        or_unknown("brand").alias("brand"),
        maybe_money(raw, "retail_price").alias("retail_price"),
        or_unknown("department").alias("department"),
        must("sku", "string").alias("sku"),
        must("distribution_center_id", "int").alias("distribution_center_id"),
    )


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        must("order_id", "bigint").alias("order_id"),
        must("user_id", "bigint").alias("user_id"),
        F.trim(must("status", "string")).alias("order_status"),
        F.upper(F.trim(must("gender", "string"))).alias("gender"),
        *[_stamp(raw, c).alias(c) for c in ("created_at", "returned_at", "shipped_at", "delivered_at")],
        must("num_of_item", "int").alias("item_count"),
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    extra = [c for c in ("distribution_center_id",) if c in raw.columns]
    return raw.select(
        must("id", "bigint").alias("order_item_id"),
        *[must(c, "bigint").alias(c) for c in ("order_id", "user_id", "product_id", "inventory_item_id")],
        F.trim(must("status", "string")).alias("item_status"),
        *[_stamp(raw, c).alias(c) for c in ("created_at", "shipped_at", "delivered_at", "returned_at")],
        maybe_money(raw, "sale_price").alias("sale_price"),
        *[must(c, "int").alias(c) for c in extra],
    )


def stage_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        must("id", "bigint").alias("event_id"),
        maybe_long(raw, "user_id").alias("user_id"),
        must("sequence_number", "bigint").alias("sequence_number"),
        blank_to_null("session_id").alias("session_id"),
        _stamp(raw, "created_at").alias("created_at"),
        *[blank_to_null(c).alias(c) for c in ("city", "state", "postal_code")],
        or_unknown("browser").alias("browser"),
        or_unknown("traffic_source").alias("traffic_source"),
        must("uri", "string").alias("uri"),
        F.lower(F.trim(must("event_type", "string"))).alias("event_type"),
    )


def stage_inventory(raw: DataFrame) -> DataFrame:
    return raw.select(
        must("id", "bigint").alias("inventory_item_id"),
        must("product_id", "bigint").alias("product_id"),
        _stamp(raw, "created_at").alias("created_at"),
        _stamp(raw, "sold_at").alias("sold_at"),
        maybe_money(raw, "cost").alias("unit_cost"),
        or_unknown("product_category").alias("category"),
        or_unknown("product_name").alias("product_name"),
        or_unknown("product_brand").alias("brand"),
        maybe_money(raw, "product_retail_price").alias("retail_price"),
        or_unknown("product_department").alias("department"),
        must("product_sku", "string").alias("sku"),
        must("product_distribution_center_id", "int").alias("distribution_center_id"),
    )


def stage_distribution_centers(raw: DataFrame) -> DataFrame:
    return raw.select(
        must("id", "int").alias("distribution_center_id"),
        F.trim(must("name", "string")).alias("distribution_center_name"),
        maybe_double("latitude").alias("latitude"),
        maybe_double("longitude").alias("longitude"),
    )


def reconstruct_sessions(events: DataFrame) -> DataFrame:
    """One row per session id, in one shuffle on the session id.

    First and last attributes follow the sequence number over the rows where
    the attribute is present. Partial aggregation runs before the shuffle, so a
    single huge session still arrives as one small row per map task.
    """
    seq = F.col("sequence_number")

    def earliest(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), seq)).alias(c)

    def reached(stage: str) -> Column:
        return F.max(flag(F.col("event_type") == stage))

    names = {"product": "product_view_flag", "cancel": "cancel_event_flag"}
    known_type = F.when(F.col("event_type").isNotNull(), seq)
    return (
        events.filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.max("user_id").alias("user_id"),
            F.count("*").cast("int").alias("event_count"),
            F.count("user_id").cast("int").alias("events_with_user_id"),
            (F.count("user_id").cast("double") / F.count("*")).alias("event_identity_coverage_rate"),
            F.min("created_at").alias("session_start_at"),
            F.max("created_at").alias("session_end_at"),
            *[earliest(c) for c in ("city", "state", "postal_code", "browser", "traffic_source")],
            F.min_by("event_type", known_type).alias("first_event_type"),
            F.max_by("event_type", known_type).alias("final_event_type"),
            *[reached(s).alias(names.get(s, f"{s}_flag")) for s in STAGES],
        )
    )


def country_lookup(dim_country: DataFrame) -> DataFrame:
    """The mapping table reduced to one row per spelling, safe to join on."""
    return dim_country.select("source_country_value", "canonical_country", "region", "sub_region").distinct()


def stage_plan(raw: DataFrame, dim_country: DataFrame, fx: DataFrame) -> DataFrame:
    """Map spellings to markets, convert at the budget rate, flag defects, keep every row."""
    local = maybe_money(raw, "plan_net_sales_local")
    trimmed = raw.select(
        "submission_batch",
        "submitted_country",
        F.trim("submitted_country").alias("submitted_country_trimmed"),
        F.col("plan_month").cast("date").alias("plan_month"),
        F.upper(F.trim("currency_code")).alias("currency_code"),
        local.alias("plan_net_sales_local"),
        F.col("plan_units").cast("bigint").alias("plan_units"),
    )
    spelling = country_lookup(dim_country).withColumnRenamed("source_country_value", "submitted_country_trimmed")
    rates = fx.select("currency_code", F.col("budget_rate_to_usd").cast(RATE).alias("budget_rate_to_usd"))
    joined = trimmed.join(spelling, "submitted_country_trimmed", "left").join(rates, "currency_code", "left")
    amount = F.col("plan_net_sales_local")
    return joined.select(
        "submission_batch",
        "submitted_country",
        "submitted_country_trimmed",
        "canonical_country",
        "region",
        "sub_region",
        "plan_month",
        "currency_code",
        "budget_rate_to_usd",
        "plan_net_sales_local",
        (amount * F.col("budget_rate_to_usd")).cast(MONEY).alias("plan_net_sales_usd"),
        "plan_units",
        flag(F.col("canonical_country").isNull()).alias("flag_unmapped_country"),
        flag(F.col("budget_rate_to_usd").isNull()).alias("flag_missing_fx_rate"),
        flag(amount.isNull()).alias("flag_blank_target"),
        flag(amount < 0).alias("flag_negative_target"),
        flag(F.col("submitted_country") != F.col("submitted_country_trimmed")).alias("flag_whitespace_in_key"),
    )
