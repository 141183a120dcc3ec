"""Result sets behind the report pack and the figures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import exact_sum, flag_sum, money_sum, ratio
from .acquisition import FUNNEL


def scorecard_listing(scorecard: DataFrame) -> DataFrame:
    return scorecard.select(
        "kpi_order", "kpi_name", "reporting_month", "actual_value", "prior_month_value", "mom_variance_rate",
        "last_year_value", "yoy_variance_rate", "plan_value", "plan_achievement_rate", "plan_rag_status",
    ).orderBy("kpi_order")


def sales_trend(monthly: DataFrame, since: dt.date) -> DataFrame:
    kept = (F.col("is_complete_month") == 1) & (F.col("month_start") >= F.lit(since))
    return monthly.filter(kept).select("month_start", "net_sales_value", "net_profit_value").orderBy("month_start")


def region_by_year(region: DataFrame) -> DataFrame:
    return region.select(
        "region", F.year("plan_year").alias("plan_year"), "actual_net_sales_usd", "plan_net_sales_usd", "variance_usd",
        "achievement_rate", "months_without_plan",
    ).orderBy("plan_year", "region")


def market_achievement(monthly: DataFrame) -> DataFrame:
    """Like for like: only months with both an actual and a plan."""
    both = monthly.filter(
        "is_complete_month = 1 AND in_plan_horizon = 1 AND plan_net_sales_usd IS NOT NULL AND actual_net_sales_usd IS NOT NULL"
    )
    sums = both.groupBy("canonical_country", "region").agg(
        exact_sum("actual_net_sales_usd").alias("a"), exact_sum("plan_net_sales_usd").alias("p")
    )
    return sums.select(
        "canonical_country",
        "region",
        F.col("a").cast("double").alias("actual_usd"),
        F.col("p").cast("double").alias("plan_usd"),
        (F.col("a") - F.col("p")).cast("double").alias("variance_usd"),
        ratio("a", "p").alias("achievement"),
    ).orderBy("achievement")


def bridge_totals(bridge: DataFrame) -> DataFrame:
    sums = bridge.groupBy("comparison_order", "comparison_label").agg(
        *[money_sum(c).alias(c) for c in ("revenue_prior", "revenue_current", "total_variance")],
        *[F.sum(c).alias(c) for c in ("volume_effect", "mix_effect", "price_effect", "units_prior", "units_current")],
    )
    asp0, asp1 = ratio("revenue_prior", "units_prior"), ratio("revenue_current", "units_current")
    return sums.withColumns(
        {
            "asp_prior": F.round(asp0, 2),
            "asp_current": F.round(asp1, 2),
            "asp_change": F.round(asp1 / asp0 - 1, 4),
            "volume_share": F.round(ratio("volume_effect", "total_variance"), 4),
        }
    ).orderBy("comparison_order")


def bridge_detail(bridge: DataFrame, prefix: str = "YTD") -> DataFrame:
    return bridge.filter(F.col("comparison_label").startswith(prefix)).drop("comparison_order").orderBy(F.desc("total_variance"))


def waterfall(bridge: DataFrame, prefix: str = "YTD") -> DataFrame:
    """The steps from prior to current revenue, as one row."""
    return bridge.filter(F.col("comparison_label").startswith(prefix)).agg(
        money_sum("revenue_prior").alias("prior_revenue"),
        F.sum("volume_effect").alias("volume"),
        F.sum("mix_effect").alias("mix"),
        F.sum("price_effect").alias("price"),
        money_sum("revenue_current").alias("current_revenue"),
    )


def model_comparison(accuracy: DataFrame) -> DataFrame:
    return accuracy.select(
        "model", "mape", "mape_first_step", "mape_final_step", "worst_month_ape", "bias", "origins", "folds"
    ).orderBy("mape")


def outlook_listing(outlook: DataFrame) -> DataFrame:
    return outlook.select(
        "month_start", "basis", "expected_net_sales_usd", "plan_net_sales_usd", "gap_to_plan_usd", "expected_achievement_rate"
    ).orderBy("month_start")


def scenario_totals(scenarios: DataFrame) -> DataFrame:
    return scenarios.groupBy("scenario").agg(
        money_sum("forecast_net_sales_usd").alias("net_sales"),
        money_sum("forecast_net_profit_usd").alias("net_profit"),
        F.max("assumed_margin_rate").alias("assumed_margin"),
        F.max("volume_multiplier").alias("volume_multiplier"),
        F.max("narrative").alias("assumption"),
    ).orderBy(F.desc("net_sales"))


def gate_listing(gate: DataFrame) -> DataFrame:
    return gate.select(
        "check_name", "layer", "severity", "failure_count", "denominator", "status", "notes"
    ).orderBy(F.desc("status"), "check_name")


def statement_listing(statement: DataFrame) -> DataFrame:
    return statement.select(
        "stream", "step_order", "stage", "entity", "row_count", "value_usd", "row_delta", "expectation"
    ).orderBy("stream", "step_order")


def reject_listing(rejects: DataFrame) -> DataFrame:
    return rejects.select("submitted_country", "plan_month", "currency_code", "reject_reason").orderBy(
        "reject_reason", "submitted_country"
    )


def funnel_pivot(funnel: DataFrame, channels: Sequence[str] | None = None) -> DataFrame:
    """Stages by channel, a column for every channel there is, or for those given, 0 where one has no rows.

    Without a list the channels are looked up first; raises above
    ``spark.sql.pivotMaxValues`` of them.
    """
    known = list(channels) if channels is not None else None
    wide = funnel.groupBy("stage_order", "stage").pivot("traffic_source", known).agg(F.sum("stage_sessions"))
    return wide.na.fill(0).orderBy("stage_order")


def category_margin(performance: DataFrame, n: int = 8) -> DataFrame:
    return (
        performance.select("department", "category", "net_sales_value", "net_margin_rate", "items")
        .orderBy(F.desc("net_sales_value"))
        .limit(n)
    )


def center_leads(delivery: DataFrame) -> DataFrame:
    return delivery.select(
        "distribution_center_name", "median_end_to_end_lead_days", "p90_end_to_end_lead_days"
    ).orderBy("median_end_to_end_lead_days")


def retention_matrix(cohorts: DataFrame, months: int = 12, latest: int = 24) -> DataFrame:
    """Retention by months since first order for the latest cohorts."""
    near = cohorts.filter(F.col("months_since_first_order").between(0, months))
    newest = near.select("cohort_month").distinct().orderBy(F.desc("cohort_month")).limit(latest)
    spread = near.join(F.broadcast(newest), "cohort_month", "left_semi")  # at most `latest` rows
    wide = spread.groupBy("cohort_month").pivot("months_since_first_order", list(range(months + 1))).agg(F.max("retention_rate"))
    return wide.select("cohort_month", *[F.col(str(m)).alias(f"m{m}") for m in range(months + 1)]).orderBy("cohort_month")


def outlook_lines(outlook: DataFrame) -> DataFrame:
    """Actual, forecast and plan lines; the forecast starts at the last actual."""
    last = outlook.filter(F.col("actual_net_sales_usd").isNotNull()).agg(F.max("month_start")).scalar()
    return (
        outlook.withColumn("_last", last)
        .select(
            "month_start",
            "actual_net_sales_usd",
            F.when(F.col("month_start") == F.col("_last"), F.col("actual_net_sales_usd"))
            .otherwise(F.col("forecast_net_sales_usd"))
            .alias("forecast_net_sales_usd"),
            "plan_net_sales_usd",
        )
        .orderBy("month_start")
    )


def plan_status_counts(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("plan_status").agg(
        F.count("*").alias("months"),
        F.round(money_sum("actual_net_sales_usd"), 0).alias("actual_usd"),
        F.round(money_sum("plan_net_sales_usd"), 0).alias("plan_usd"),
    )
