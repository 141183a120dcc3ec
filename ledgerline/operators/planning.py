"""Plan consolidation, plan against actual, price-volume-mix and scorecard."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.casting import UNKNOWN
from ..functions.measures import exact, exact_sum, flag, flag_sum, money_sum, ratio
from ..functions.times import as_date, month_start, year_start
from .facts import CANCELLED, RETURNED, attach
from .revenue import by_calendar
from .staging import country_lookup

MARKET = ["canonical_country", "region", "sub_region"]


def _is_net(status: Column) -> Column:
    return ~status.isin(CANCELLED, RETURNED)


def actual_country_month(
    items: DataFrame, customers: DataFrame, countries: DataFrame, dates: DataFrame
) -> DataFrame:
    spelled = attach(items, customers, "customer_id", "user_id", ["country"])
    placed = attach(spelled, country_lookup(countries), "country", "source_country_value", MARKET)
    calendar = ["fiscal_year", "fiscal_quarter_label", "is_complete_month"]
    return (
        by_calendar(placed, dates, ["month_start", *calendar])
        .groupBy(*MARKET, "month_start", *calendar)
        .agg(
            *[exact_sum(c).alias(c) for c in ("gross_sales_value", "net_sales_value", "net_profit_value")],
            flag_sum(flag(_is_net(F.col("item_status")))).alias("net_units"),
            F.countDistinct("order_id").alias("orders"),
            F.countDistinct("customer_id").alias("customers"),
        )
    )


def plan_vs_actual_monthly(actuals: DataFrame, plan: DataFrame, amber: float = 0.95) -> DataFrame:
    """Market by month, with months known to only one side kept."""
    left = actuals.select(
        "canonical_country",
        "month_start",
        F.col("region").alias("_a_region"),
        exact("net_sales_value").alias("_actual"),
        F.col("net_units").alias("actual_units"),
        "is_complete_month",
    )
    right = plan.select(
        "canonical_country",
        F.col("plan_month").alias("month_start"),
        F.col("region").alias("_p_region"),
        exact("plan_net_sales_usd").alias("_plan"),
        "plan_units",
    )
    span = plan.agg(F.struct(F.min("plan_month").alias("lo"), F.max("plan_month").alias("hi"))).scalar()
    actual, target = F.col("_actual"), F.col("_plan")
    status = (
        F.when(target.isNull(), "Actual with no plan")
        .when(actual.isNull(), "Plan with no actual yet")
        .when(actual >= target, "On or above plan")
        .when(actual.cast("double") >= target.cast("double") * F.lit(amber), "Within 5% of plan")
        .otherwise("Below plan")
    )
    return (
        left.join(right, ["canonical_country", "month_start"], "outer")
        .withColumn("_span", span)
        .select(
            "canonical_country",
            F.coalesce("_a_region", "_p_region").alias("region"),
            "month_start",
            actual.cast("double").alias("actual_net_sales_usd"),
            "actual_units",
            target.cast("double").alias("plan_net_sales_usd"),
            "plan_units",
            (actual - target).cast("double").alias("variance_usd"),
            F.when(target > 0, ratio(actual - target, target)).alias("variance_rate"),
            F.when(target > 0, ratio(actual, target)).alias("achievement_rate"),
            F.coalesce("is_complete_month", F.lit(0)).alias("is_complete_month"),
            flag(F.col("month_start").between(F.col("_span.lo"), F.col("_span.hi"))).alias("in_plan_horizon"),
            status.alias("plan_status"),
        )
    )


def plan_vs_actual_region(monthly: DataFrame) -> DataFrame:
    """Region by calendar year over complete months inside the plan horizon."""
    kept = monthly.filter(
        F.col("actual_net_sales_usd").isNotNull()
        & (F.col("is_complete_month") == 1)
        & (F.col("in_plan_horizon") == 1)
    )
    totals = kept.groupBy("region", year_start(F.col("month_start")).alias("plan_year")).agg(
        exact_sum("actual_net_sales_usd").alias("_actual"),
        exact_sum("plan_net_sales_usd").alias("_plan"),
        F.count("*").alias("month_rows"),
        flag_sum(flag(F.col("plan_net_sales_usd").isNull())).alias("months_without_plan"),
    )
    return totals.select(
        "region",
        "plan_year",
        F.col("_actual").cast("double").alias("actual_net_sales_usd"),
        F.col("_plan").cast("double").alias("plan_net_sales_usd"),
        (F.col("_actual") - F.col("_plan")).cast("double").alias("variance_usd"),
        F.when(F.col("_plan") > 0, ratio("_actual", "_plan")).alias("achievement_rate"),
        "month_rows",
        "months_without_plan",
    )


@dataclass(frozen=True)
class Comparison:
    """Two inclusive date spans to compare."""

    label: str
    order: int
    prior_from: dt.date
    prior_to: dt.date
    current_from: dt.date
    current_to: dt.date


def price_volume_mix(
    items: DataFrame, products: DataFrame, comparisons: Sequence[Comparison], new_entrant: str = "none"
) -> DataFrame:
    """Volume, mix and price effects per comparison and category.

    Net items are first added up per day and category. That result is small
    (days x categories), so assigning days to the comparisons' spans costs
    nothing and the item table is read and shuffled once.

    A category without prior units has no prior price: its effects are 0 and the
    bridge does not tie. ``new_entrant="mix"`` books its revenue as mix instead.
    """
    if new_entrant not in ("none", "mix"):
        raise ValueError("new_entrant must be 'none' or 'mix'")
    wide = attach(items, products, "product_id", "product_id", ["department", "category"])
    daily = (
        wide.filter(_is_net(F.col("item_status")))
        .groupBy(as_date(F.col("order_item_created_at")).alias("day"), "department", "category")
        .agg(F.sum("net_sales_value").alias("revenue"), F.count("*").alias("units"))
    )
    day = F.col("day")
    spans = []
    for c in comparisons:
        prior = day.between(F.lit(c.prior_from), F.lit(c.prior_to))
        current = day.between(F.lit(c.current_from), F.lit(c.current_to))
        spans.append(
            F.struct(
                F.lit(c.label).alias("comparison_label"),
                F.lit(c.order).alias("comparison_order"),
                F.when(prior, "prior").when(current, "current").alias("side"),
            )
        )
    sided = daily.select("*", F.inline(F.array(*spans))).filter(F.col("side").isNotNull())
    zero = F.lit(0)

    def side(name: str, c: str) -> Column:
        return F.sum(F.when(F.col("side") == name, F.col(c)).otherwise(zero))

    per_category = sided.groupBy("comparison_label", "comparison_order", "department", "category").agg(
        side("prior", "units").alias("units_prior"),
        side("current", "units").alias("units_current"),
        side("prior", "revenue").alias("r0"),
        side("current", "revenue").alias("r1"),
    )
    whole = Window.partitionBy("comparison_label")
    u0, u1 = F.col("units_prior"), F.col("units_current")
    r0, r1 = F.col("r0").cast("double"), F.col("r1").cast("double")
    t0, t1 = F.col("t0"), F.col("t1")
    asp0, asp1 = F.when(u0 > 0, r0 / u0), F.when(u1 > 0, r1 / u1)
    share0, share1 = F.when(t0 > 0, u0 / t0), F.when(t1 > 0, u1 / t1)
    mix = t1 * (share1 - share0) * asp0
    if new_entrant == "mix":
        mix = F.when((u0 == 0) & (u1 > 0), r1).otherwise(mix)
    return (
        per_category.withColumns({"t0": F.sum("units_prior").over(whole), "t1": F.sum("units_current").over(whole)})
        .select(
            "comparison_label",
            "comparison_order",
            "department",
            "category",
            "units_prior",
            "units_current",
            r0.alias("revenue_prior"),
            r1.alias("revenue_current"),
            asp0.alias("asp_prior"),
            asp1.alias("asp_current"),
            (F.col("r1") - F.col("r0")).cast("double").alias("total_variance"),
            F.coalesce((t1 - t0) * share0 * asp0, F.lit(0.0)).alias("volume_effect"),
            F.coalesce(mix, F.lit(0.0)).alias("mix_effect"),
            F.coalesce(u1 * (asp1 - asp0), F.lit(0.0)).alias("price_effect"),
        )
    )


# Order, name, format, monthly column and plan column of each KPI.
SCORECARD = (
    (1, "Net Sales", "currency", "net_sales_value", "plan_net_sales_usd"),
    (2, "Net Profit", "currency", "net_profit_value", None),
    (3, "Net Margin Rate", "percent", "net_margin_rate", None),
    (4, "Units Sold", "number", "items", "plan_units"),
    (5, "Orders", "number", "orders", None),
    (6, "Active Customers", "number", "customers", None),
    (7, "Average Order Value", "currency", "average_order_value", None),
    (8, "Item Return Rate", "percent_inverse", "item_return_rate", None),
    (9, "Item Cancellation Rate", "percent_inverse", "item_cancellation_rate", None),
)


def rag_status(kind: Column, actual: Column, plan: Column, tolerance: float = 0.05) -> Column:
    """Green at or beyond plan, Amber within the tolerance; inverse KPIs count downwards."""
    inverse = kind == "percent_inverse"
    good = F.when(inverse, actual <= plan).otherwise(actual >= plan)
    near = F.when(inverse, actual <= plan * (1 + tolerance)).otherwise(actual >= plan * (1 - tolerance))
    return F.when(plan.isNull(), "No plan").when(good, "Green").when(near, "Amber").otherwise("Red")


def commercial_scorecard(monthly: DataFrame, plan: DataFrame) -> DataFrame:
    """The latest complete month against the month before, last year and plan.

    The month table (one row per calendar month) is folded into one array, so it
    is built once and its three months are picked by offset, without self-joins.
    """
    names = [c for _, _, _, c, _ in SCORECARD]
    months = monthly.agg(
        F.collect_list(
            F.struct("month_start", "is_complete_month", *[F.col(c).cast("double").alias(c) for c in names])
        ).alias("months")
    )
    done = F.transform(F.filter("months", lambda m: m["is_complete_month"] == 1), lambda m: m["month_start"])
    anchored = months.withColumn("reporting_month", F.array_max(done))
    slots = {"cur": 0, "pm": -1, "ly": -12}

    def month_at(offset: int) -> Column:
        wanted = F.add_months("reporting_month", offset)
        return F.get(F.filter("months", lambda m: m["month_start"] == wanted), F.lit(0))

    found = anchored.select("reporting_month", *[month_at(n).alias(k) for k, n in slots.items()])
    picked = found.select(
        "reporting_month", *[F.col(k)[c].alias(f"{k}_{c}") for k in slots for c in names]
    )
    targets = plan.groupBy("plan_month").agg(
        money_sum("plan_net_sales_usd").alias("plan_net_sales_usd"),
        F.sum("plan_units").cast("double").alias("plan_units"),
    )
    row = picked.join(targets, F.col("reporting_month") == F.col("plan_month"), "left")
    lines = [
        F.struct(
            F.lit(i).alias("kpi_order"),
            F.lit(name).alias("kpi_name"),
            F.lit(kind).alias("kpi_format"),
            F.col(f"cur_{c}").alias("actual_value"),
            F.col(f"pm_{c}").alias("prior_month_value"),
            F.col(f"ly_{c}").alias("last_year_value"),
            (F.col(p) if p else F.lit(None).cast("double")).alias("plan_value"),
        )
        for i, name, kind, c, p in SCORECARD
    ]
    a, m, y, p = (F.col(c) for c in ("actual_value", "prior_month_value", "last_year_value", "plan_value"))
    return row.select("reporting_month", F.inline(F.array(*lines))).select(
        "kpi_order",
        "kpi_name",
        "kpi_format",
        "reporting_month",
        "actual_value",
        "prior_month_value",
        "last_year_value",
        "plan_value",
        (a - m).alias("mom_variance"),
        (ratio(a, m) - 1).alias("mom_variance_rate"),
        (a - y).alias("yoy_variance"),
        (ratio(a, y) - 1).alias("yoy_variance_rate"),
        (a - p).alias("plan_variance"),
        ratio(a, p).alias("plan_achievement_rate"),
        rag_status(F.col("kpi_format"), a, p).alias("plan_rag_status"),
    )


def plan_target_baseline(
    actuals: DataFrame,
    growth_clip: tuple[float, float] = (1.0, 2.2),
    default: float = 1.15,
    peak: Mapping[int, float] | None = None,
    factors: Mapping[str, float] | None = None,
    horizon: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Plan targets: last year's month times growth, a market factor and a season.

    Growth is the ratio of the two calendar years before the plan year, held
    inside ``growth_clip``; without both years it is ``default``. Sales are
    rounded to hundreds and units are scaled alike. ``factors`` sets a multiplier
    for single markets (1.0 elsewhere).
    """
    peak = {11: 1.05, 12: 1.05} if peak is None else peak
    known = actuals.filter(F.col("canonical_country") != UNKNOWN)
    monthly = known.groupBy("canonical_country", "month_start").agg(
        exact_sum("net_sales_value").alias("base_sales"), F.sum("net_units").alias("base_units")
    )
    yearly = monthly.groupBy("canonical_country", F.year("month_start").alias("year")).agg(
        F.sum("base_sales").alias("year_sales")
    )
    before = yearly.select("canonical_country", (F.col("year") + 2).alias("plan_year"), F.col("year_sales").alias("y2"))
    last = yearly.select("canonical_country", (F.col("year") + 1).alias("plan_year"), F.col("year_sales").alias("y1"))
    growth = last.join(before, ["canonical_country", "plan_year"], "inner")
    low, high = growth_clip
    rate = F.when(F.col("y2") > 0, F.greatest(F.lit(low), F.least(F.lit(high), ratio("y1", "y2"))))
    plan_month = F.add_months("month_start", 12)
    season, market = F.lit(1.0), F.lit(1.0)
    for m, f in peak.items():
        season = F.when(F.month("plan_month") == m, F.lit(f)).otherwise(season)
    for c, f in (factors or {}).items():
        market = F.when(F.col("canonical_country") == c, F.lit(f)).otherwise(market)
    planned = monthly.select(
        "canonical_country",
        plan_month.alias("plan_month"),
        F.year(plan_month).alias("plan_year"),
        "base_sales",
        "base_units",
    )
    if horizon:
        planned = planned.filter(F.col("plan_month").between(F.lit(horizon[0]), F.lit(horizon[1])))
    return (
        planned.join(growth, ["canonical_country", "plan_year"], "left")
        .withColumn("growth", F.coalesce(rate, F.lit(default)))
        .withColumn("factor", F.col("growth") * market * season)
        .withColumn("usd", F.col("base_sales").cast("double") * F.col("factor"))
        .filter(F.col("usd") > 0)
        .select(
            "canonical_country",
            "plan_month",
            "growth",
            (F.bround(F.col("usd") / 100.0) * 100.0).alias("plan_net_sales_usd"),
            F.bround(F.col("base_units") * F.col("factor")).cast("bigint").alias("plan_units"),
        )
    )
