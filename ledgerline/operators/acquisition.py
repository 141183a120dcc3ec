"""Funnel, channel and acquisition marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import exact_sum, flag_sum, ratio
from ..functions.times import month_start

# The four funnel stages in order, and the column each one counts.
FUNNEL = (
    ("Sessions", None),
    ("Product Viewed", "product_view_flag"),
    ("Cart Reached", "cart_flag"),
    ("Purchase", "purchase_flag"),
)


def funnel_stage(sessions: DataFrame, by: str = "traffic_source") -> DataFrame:
    """Stage counts per channel with conversion from the first and the previous stage.

    One aggregate gives all four counts on one row, so the rates need no window.
    """
    counts = sessions.groupBy(by).agg(
        F.count("*").alias("n1"),
        *[flag_sum(c).alias(f"n{i}") for i, (_, c) in enumerate(FUNNEL, 1) if c],
    )
    steps = [
        F.struct(
            F.lit(i).alias("stage_order"),
            F.lit(label).alias("stage"),
            F.col(f"n{i}").alias("stage_sessions"),
            ratio(f"n{i}", "n1").alias("conversion_from_session_rate"),
            (ratio(f"n{i}", f"n{i - 1}") if i > 1 else F.lit(None).cast("double")).alias(
                "conversion_from_previous_stage_rate"
            ),
        )
        for i, (label, _) in enumerate(FUNNEL, 1)
    ]
    return counts.select(by, F.inline(F.array(*steps)))


def _session_totals():
    return [
        flag_sum("cart_flag").alias("cart_sessions"),
        flag_sum("purchase_flag").alias("purchase_sessions"),
        flag_sum("cart_abandoned_flag").alias("abandoned_cart_sessions"),
    ]


def funnel_monthly(sessions: DataFrame, by: str = "traffic_source") -> DataFrame:
    totals = sessions.groupBy(month_start(F.col("session_start_at")).alias("month_start"), by).agg(
        F.count("*").alias("sessions"),
        F.countDistinct("customer_id").alias("users"),
        flag_sum("product_view_flag").alias("product_view_sessions"),
        *_session_totals(),
        F.avg("event_count").alias("avg_events_per_session"),
        F.avg("session_duration_seconds").alias("avg_session_duration_seconds"),
        F.avg("event_identity_coverage_rate").alias("avg_event_identity_coverage_rate"),
    )
    return totals.withColumns(
        {
            "session_conversion_rate": ratio("purchase_sessions", "sessions"),
            "cart_abandonment_rate": ratio("abandoned_cart_sessions", "cart_sessions"),
        }
    )


def cart_abandonment_segments(sessions: DataFrame, min_sessions: int = 500) -> DataFrame:
    """Rates by channel, browser and country.

    The counts are additive, so the fact is read once at the three keys together
    and the small result is rolled up to each of them.
    """
    kinds = {"Traffic Source": "traffic_source", "Browser": "browser", "Country": "country"}
    fine = sessions.groupBy(*kinds.values()).agg(F.count("*").alias("sessions"), *_session_totals())
    tagged = [
        F.struct(F.lit(kind).alias("segment_type"), F.col(c).alias("segment_value")) for kind, c in kinds.items()
    ]
    measures = ["sessions", "cart_sessions", "abandoned_cart_sessions", "purchase_sessions"]
    return (
        fine.select(F.inline(F.array(*tagged)), *measures)
        .groupBy("segment_type", "segment_value")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .filter(F.col("sessions") >= min_sessions)
        .withColumns(
            {
                "cart_abandonment_rate": ratio("abandoned_cart_sessions", "cart_sessions"),
                "session_conversion_rate": ratio("purchase_sessions", "sessions"),
            }
        )
    )


def channel_quality(sessions: DataFrame) -> DataFrame:
    totals = sessions.groupBy("traffic_source").agg(
        F.count("*").alias("sessions"),
        F.countDistinct("customer_id").alias("users"),
        *_session_totals(),
        F.avg("event_count").alias("avg_events_per_session"),
        F.avg("event_identity_coverage_rate").alias("avg_event_identity_coverage_rate"),
    )
    return totals.withColumns(
        {
            "session_conversion_rate": ratio("purchase_sessions", "sessions"),
            "cart_abandonment_rate": ratio("abandoned_cart_sessions", "cart_sessions"),
        }
    )


def acquisition_source_value(items: DataFrame) -> DataFrame:
    totals = items.groupBy("acquisition_source").agg(
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        *[exact_sum(c).cast("double").alias(c) for c in ("gross_sales_value", "net_sales_value", "net_profit_value")],
    )
    return totals.withColumn("net_sales_per_customer", ratio("net_sales_value", "customers"))
