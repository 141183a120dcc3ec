"""Delivery, return-risk and inventory marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casting import MONEY
from ..functions.measures import exact, flag, flag_sum, ratio
from .facts import attach
from .ranking import percentiles
from .revenue import by_calendar

LEADS = ("ship_lead_days", "delivery_lead_days", "end_to_end_lead_days")


def _lead_summary(items: DataFrame, by: Sequence[str]) -> DataFrame:
    """Lead times and rates from one scan: everything is read off counts per lead time."""
    wanted = {f"median_{c}": (c, 0.5) for c in LEADS} | {f"p90_{c}": (c, 0.9) for c in LEADS}
    totals = {
        "items": F.lit(1).cast("bigint"),
        "valid_timeline_items": F.col("valid_timeline_flag").cast("bigint"),
        "_returned": F.col("returned_item_flag").cast("bigint"),
        "_eligible": F.col("return_observation_eligible_flag").cast("bigint"),
        "_cancelled": F.col("cancelled_item_flag").cast("bigint"),
    }
    summary = percentiles(items, by, wanted, sums=totals, means={f"avg_{c}": c for c in LEADS})
    order = [f"{stat}_{c}" for c in LEADS for stat in ("avg", "median", "p90")]
    return summary.select(
        *by,
        "items",
        "valid_timeline_items",
        *order,
        ratio("_returned", "_eligible").alias("observed_return_rate"),
        ratio("_cancelled", "items").alias("cancellation_rate"),
    )


def operations_monthly(items: DataFrame, dates: DataFrame) -> DataFrame:
    return _lead_summary(by_calendar(items, dates, ["month_start"]), ["month_start"])


def delivery_performance(items: DataFrame, centers: DataFrame) -> DataFrame:
    """Lead times per centre; the centre's name is joined to the finished summary."""
    summary = _lead_summary(items, ["distribution_center_id"]).drop("cancellation_rate")
    named = centers.select("distribution_center_id", "distribution_center_name")
    return named.join(summary, "distribution_center_id", "inner")


def return_risk_segments(
    items: DataFrame, products: DataFrame, customers: DataFrame, min_eligible: int = 100
) -> DataFrame:
    """Return rates by category, country, age band and acquisition source.

    All four keys are grouped together once; the four reports are rolled up from
    that result because counts and values are additive.
    """
    kinds = {
        "Category": "category",
        "Country": "country",
        "Age Band": "age_band",
        "Acquisition Source": "acquisition_source",
    }
    wide = attach(items, products, "product_id", "product_id", ["category"])
    wide = attach(wide, customers, "customer_id", "user_id", ["country", "age_band"])
    fine = wide.groupBy(*kinds.values()).agg(
        F.count("*").alias("items"),
        flag_sum("return_observation_eligible_flag").alias("eligible_items"),
        flag_sum("returned_item_flag").alias("returned_items"),
        F.sum("returned_value").alias("returned_value"),
    )
    tagged = [
        F.struct(F.lit(kind).alias("segment_type"), F.col(c).alias("segment_value")) for kind, c in kinds.items()
    ]
    counts = ["items", "eligible_items", "returned_items"]
    return (
        fine.select(F.inline(F.array(*tagged)), *counts, "returned_value")
        .groupBy("segment_type", "segment_value")
        .agg(*[F.sum(c).alias(c) for c in counts], F.sum("returned_value").cast("double").alias("returned_value"))
        .filter(F.col("eligible_items") >= min_eligible)
        .withColumn("observed_return_rate", ratio("returned_items", "eligible_items"))
    )


def inventory_performance(inventory: DataFrame, products: DataFrame, centers: DataFrame) -> DataFrame:
    by = ["department", "category", "distribution_center_name"]
    wide = attach(inventory, products, "product_id", "product_id", ["department", "category"])
    wide = attach(wide, centers, "distribution_center_id", "distribution_center_id", ["distribution_center_name"])
    unsold = F.col("sold_flag") == 0
    none = F.lit(0).cast(MONEY)
    totals = {
        "inventory_units": F.lit(1).cast("bigint"),
        "sold_units": F.col("sold_flag").cast("bigint"),
        "aged_181_plus_units": flag(F.col("inventory_age_bucket") == "181+ days").cast("bigint"),
        "unsold_inventory_cost": F.when(unsold, exact("unit_cost")).otherwise(none),
        "unsold_inventory_retail_value": F.when(unsold, exact("retail_price")).otherwise(none),
    }
    wanted = {"median_days_to_sell": ("days_to_sell", 0.5), "p90_days_to_sell": ("days_to_sell", 0.9)}
    units, sold = F.col("inventory_units"), F.col("sold_units")
    return percentiles(wide, by, wanted, sums=totals).select(
        *by,
        "inventory_units",
        "sold_units",
        (units - sold).alias("unsold_units"),
        ratio(sold, units).alias("sell_through_rate"),
        "median_days_to_sell",
        "p90_days_to_sell",
        "aged_181_plus_units",
        F.col("unsold_inventory_cost").cast("double").alias("unsold_inventory_cost"),
        F.col("unsold_inventory_retail_value").cast("double").alias("unsold_inventory_retail_value"),
    )
