"""Named measures that hold under any filter and any grouping.

A base measure is an aggregate over one table; a derived one is a formula over
other measures. Each table needed is aggregated once at the requested grouping,
and the results are joined on the grouping keys, never table to table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.measures import exact_sum, flag_sum, money_sum, ratio
from ..functions.times import month_key
from .ranking import percentiles


@dataclass(frozen=True)
class Measure:
    name: str
    table: str | None = None
    agg: Callable[[], Column] | None = None
    needs: tuple[str, ...] = ()
    formula: Callable[[], Column] | None = None
    percentile: tuple[str, float] | None = None  # (value expression, p)


MEASURES: dict[str, Measure] = {}


def _base(table: str, **aggs: Callable[[], Column]) -> None:
    for name, agg in aggs.items():
        MEASURES[name] = Measure(name, table, agg)


def _derived(name: str, needs: Sequence[str], formula: Callable[[], Column]) -> None:
    MEASURES[name] = Measure(name, needs=tuple(needs), formula=formula)


def _share(name: str, top: str, bottom: str) -> None:
    _derived(name, (top, bottom), lambda: ratio(top, bottom))


def _percentile(table: str, name: str, value: str, p: float) -> None:
    MEASURES[name] = Measure(name, table, percentile=(value, p))


def _count_where(test: str) -> Callable[[], Column]:
    return lambda: F.count_if(F.expr(test))


_rows = lambda: F.count("*")
_one = lambda c: F.col(c) if isinstance(c, str) else c

# commercial
_base(
    "order_item",
    gross_sales=lambda: money_sum("gross_sales_value"),
    cancelled_value=lambda: money_sum("cancelled_value"),
    returned_value=lambda: money_sum("returned_value"),
    net_sales=lambda: money_sum("net_sales_value"),
    net_profit=lambda: money_sum("net_profit_value"),
    orders=lambda: F.countDistinct("order_id"),
    customers=lambda: F.countDistinct("customer_id"),
    items=_rows,
    returned_items=lambda: flag_sum("returned_item_flag"),
    return_eligible_items=lambda: flag_sum("return_observation_eligible_flag"),
    cancelled_items=lambda: flag_sum("cancelled_item_flag"),
    valid_timeline_items=_count_where("valid_timeline_flag = 1"),
    average_ship_lead_days=lambda: F.avg("ship_lead_days"),
    delivered_within_7_days=_count_where("valid_timeline_flag = 1 AND end_to_end_lead_days <= 7"),
)
_share("net_margin_pct", "net_profit", "net_sales")
_derived("sales_leakage_value", ("cancelled_value", "returned_value"),
         lambda: F.coalesce("cancelled_value", F.lit(0.0)) + F.coalesce("returned_value", F.lit(0.0)))
_share("sales_leakage_pct", "sales_leakage_value", "gross_sales")
_share("average_order_value", "net_sales", "orders")
_share("items_per_order", "items", "orders")
_share("net_sales_per_customer", "net_sales", "customers")
_share("observed_return_rate", "returned_items", "return_eligible_items")
_share("item_cancellation_rate", "cancelled_items", "items")
_share("valid_timeline_rate", "valid_timeline_items", "items")
_share("delivered_within_7_days_rate", "delivered_within_7_days", "valid_timeline_items")
for _n, _c in (("ship", "ship_lead_days"), ("delivery", "delivery_lead_days"), ("end_to_end", "end_to_end_lead_days")):
    _percentile("order_item", f"median_{_n}_lead_days", _c, 0.5)
_percentile("order_item", "p90_end_to_end_lead_days", "CASE WHEN valid_timeline_flag = 1 THEN end_to_end_lead_days END", 0.9)
# complete periods: the item rows carry the calendar's flag
_base("dated_order_item", net_sales_complete_periods=lambda: money_sum(F.when(F.col("is_complete_month") == 1, F.col("net_sales_value"))))

# funnel
_base(
    "session",
    sessions=_rows,
    identified_sessions=_count_where("identified_session_flag = 1"),
    product_view_sessions=_count_where("product_view_flag = 1"),
    cart_sessions=_count_where("cart_flag = 1"),
    purchase_sessions=_count_where("purchase_flag = 1"),
    abandoned_cart_sessions=_count_where("cart_abandoned_flag = 1"),
    average_events_per_session=lambda: F.avg("event_count"),
    average_session_minutes=lambda: F.avg("session_duration_seconds") / 60,
    average_event_identity_coverage=lambda: F.avg("event_identity_coverage_rate"),
)
_share("identified_session_rate", "identified_sessions", "sessions")
_share("session_conversion_rate", "purchase_sessions", "sessions")
_share("product_to_cart_rate", "cart_sessions", "product_view_sessions")
_share("cart_to_purchase_rate", "purchase_sessions", "cart_sessions")
_share("cart_abandonment_rate", "abandoned_cart_sessions", "cart_sessions")

# customers
_base(
    "customer_360",
    purchasing_customers=lambda: F.countDistinct("customer_id"),
    repeat_customers=lambda: F.countDistinct(F.when(F.col("repeat_customer_flag") == 1, F.col("customer_id"))),
)
_share("repeat_customer_rate", "repeat_customers", "purchasing_customers")

# inventory
_base(
    "inventory",
    inventory_units=_rows,
    sold_inventory_units=lambda: flag_sum("sold_flag"),
    unsold_inventory_cost=lambda: money_sum(F.when(F.col("sold_flag") == 0, F.col("unit_cost"))),
    aged_181_inventory_units=_count_where("inventory_age_bucket = '181+ days'"),
)
_derived("unsold_inventory_units", ("inventory_units", "sold_inventory_units"),
         lambda: F.col("inventory_units") - F.col("sold_inventory_units"))
_share("sell_through_rate", "sold_inventory_units", "inventory_units")
_percentile("inventory", "median_days_to_sell", "days_to_sell", 0.5)

# calendar
_base(
    "date",
    latest_data_date=lambda: F.max("calendar_date"),
    partial_period_label=lambda: F.when(F.max("is_complete_month") == 0, "Partial period included").otherwise("Complete periods"),
    selected_date_range=lambda: F.concat(
        F.date_format(F.min("calendar_date"), "dd MMM yyyy"), F.lit(" - "), F.date_format(F.max("calendar_date"), "dd MMM yyyy")
    ),
)

# plan
_base("plan", plan_net_sales=lambda: money_sum("plan_net_sales_usd"), plan_units=lambda: F.sum("plan_units"))
_share("plan_achievement_pct", "net_sales", "plan_net_sales")
_derived("plan_variance", ("net_sales", "plan_net_sales"),
         lambda: F.coalesce("net_sales", F.lit(0.0)) - F.coalesce("plan_net_sales", F.lit(0.0)))
_share("plan_variance_pct", "plan_variance", "plan_net_sales")
_derived(
    "plan_status", ("plan_net_sales", "plan_achievement_pct"),
    lambda: F.when(F.col("plan_net_sales").isNull(), "No plan")
    .when(F.col("plan_achievement_pct") >= 1, "On or above plan")
    .when(F.col("plan_achievement_pct") >= 0.95, "Within 5% of plan")
    .otherwise("Below plan"),
)
_base(
    "plan_vs_actual",
    markets_below_plan=lambda: F.countDistinct(
        F.when(
            (F.col("achievement_rate") < 1) & (F.col("is_complete_month") == 1) & (F.col("in_plan_horizon") == 1),
            F.col("canonical_country"),
        )
    ),
)

# bridge
_base(
    "bridge",
    volume_effect=lambda: F.sum("volume_effect"),
    mix_effect=lambda: F.sum("mix_effect"),
    price_effect=lambda: F.sum("price_effect"),
    total_variance=lambda: money_sum("total_variance"),
    prior_asp=lambda: ratio(exact_sum("revenue_prior"), F.sum("units_prior")),
    current_asp=lambda: ratio(exact_sum("revenue_current"), F.sum("units_current")),
)
_derived("bridge_residual", ("volume_effect", "mix_effect", "price_effect", "total_variance"),
         lambda: F.col("volume_effect") + F.col("mix_effect") + F.col("price_effect") - F.col("total_variance"))
_share("volume_share_of_variance", "volume_effect", "total_variance")
_derived("asp_change_pct", ("prior_asp", "current_asp"), lambda: ratio(F.col("current_asp") - F.col("prior_asp"), F.col("prior_asp")))

# forecast
_base("forecast_monthly", forecast_net_sales=lambda: money_sum("forecast_net_sales_usd"))
_base(
    "forecast_vs_plan",
    expected_net_sales=lambda: money_sum("expected_net_sales_usd"),
    expected_achievement_pct=lambda: ratio(exact_sum("expected_net_sales_usd"), exact_sum("plan_net_sales_usd")),
    gap_to_plan=lambda: money_sum("gap_to_plan_usd"),
)
_base("forecast_accuracy", backtest_mape=lambda: F.min("mape"), champion_model=lambda: F.min_by("model", "mape"))
_base(
    "forecast_scenarios",
    scenario_net_sales=lambda: money_sum("forecast_net_sales_usd"),
    scenario_net_profit=lambda: money_sum("forecast_net_profit_usd"),
)
_derived("scenario_vs_plan", ("scenario_net_sales", "plan_net_sales"),
         lambda: F.coalesce("scenario_net_sales", F.lit(0.0)) - F.coalesce("plan_net_sales", F.lit(0.0)))

# quality
_base("plan_validation", blocking_test_failures=_count_where("status = 'FAIL'"))
_base("plan_rejects", quarantined_plan_rows=_rows)
_base("plan_rows", accepted_plan_rows=_rows)
_derived(
    "plan_rows_accepted_pct", ("accepted_plan_rows", "quarantined_plan_rows"),
    lambda: ratio(F.col("accepted_plan_rows"), F.col("accepted_plan_rows") + F.col("quarantined_plan_rows")),
)


def adjusted_forecast(volume_adjustment: float) -> Callable[[], Column]:
    """What-if: the forecast under a volume change."""
    return lambda: F.col("forecast_net_sales") * F.lit(1 + volume_adjustment)


def with_adjustment(volume_adjustment: float) -> dict[str, Measure]:
    """The two what-if measures for one volume change, to pass as ``extra``."""
    return {
        "adjusted_forecast": Measure("adjusted_forecast", needs=("forecast_net_sales",), formula=adjusted_forecast(volume_adjustment)),
        "adjusted_achievement_pct": Measure(
            "adjusted_achievement_pct", needs=("adjusted_forecast", "plan_net_sales"),
            formula=lambda: ratio("adjusted_forecast", "plan_net_sales"),
        ),
    }


def within_days(sla: float) -> dict[str, Measure]:
    """Share of valid timelines delivered within a given number of days, and its complement."""
    test = f"valid_timeline_flag = 1 AND end_to_end_lead_days <= {float(sla)}"
    known = "valid_timeline_flag = 1 AND end_to_end_lead_days IS NOT NULL"
    return {
        "within_sla_items": Measure("within_sla_items", "order_item", _count_where(test)),
        "delivered_valid_items": Measure("delivered_valid_items", "order_item", _count_where(known)),
        "sla_breach_rate": Measure(
            "sla_breach_rate", needs=("within_sla_items", "delivered_valid_items"),
            formula=lambda: 1 - ratio("within_sla_items", "delivered_valid_items"),
        ),
    }


def evaluate(
    tables: Mapping[str, DataFrame],
    names: Sequence[str],
    by: Sequence[str] = (),
    where: Column | None = None,
    extra: Mapping[str, Measure] | None = None,
) -> DataFrame:
    """Measures at one grouping.

    ``where`` and ``by`` use columns that every table involved has. Keys that
    only some tables hold give NULL for the others' measures.
    """
    known = MEASURES | dict(extra or {})
    order: list[str] = []

    def visit(name: str) -> None:
        for n in known[name].needs:
            visit(n)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    by = list(by)
    sources: dict[str, list[Measure]] = {}
    for name in order:
        m = known[name]
        if m.table:
            sources.setdefault(m.table, []).append(m)
    parts = []
    for table, measures in sources.items():
        rows = tables[table] if where is None else tables[table].filter(where)
        aggs = [m.agg().alias(m.name) for m in measures if m.agg]
        if aggs:
            parts.append(rows.groupBy(*by).agg(*aggs))
        spread = {m.name: m.percentile for m in measures if m.percentile}
        if spread:
            values = sorted({v for v, _ in spread.values()})
            slots = {v: f"_v{i}" for i, v in enumerate(values)}
            wide = rows.select(*by, *[F.expr(v).alias(s) for v, s in slots.items()])
            parts.append(percentiles(wide, by, {n: (slots[v], p) for n, (v, p) in spread.items()}))
    out = parts[0]
    for part in parts[1:]:
        out = _drill_across(out, part, by)
    for name in order:
        if known[name].formula:
            out = out.withColumn(name, known[name].formula())
    return out.select(*by, *names)


def _drill_across(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    if not by:
        packed = right.select(F.struct(*right.columns).alias("_r")).scalar()
        return left.withColumn("_r", packed).select(*left.columns, "_r.*")
    renamed = right.select(*[F.col(c).alias(f"_k_{c}") for c in by], *[c for c in right.columns if c not in by])
    test = F.lit(True)
    for c in by:
        test = test & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    joined = left.join(renamed, test, "outer")
    keys = [F.coalesce(F.col(c), F.col(f"_k_{c}")).alias(c) for c in by]
    return joined.select(*keys, *[c for c in left.columns + right.columns if c not in by])


def over_time(monthly: DataFrame, months: DataFrame, value: str) -> DataFrame:
    """Previous month and year, year to date and rolling twelve months.

    Every calendar month takes part, so a month without sales still shifts and
    accumulates. Windows run over one row per calendar month.
    """
    spine = months.select("month_start", "year").distinct()
    values = monthly.groupBy("month_start").agg(F.sum(value).alias("v"))
    base = spine.join(values, "month_start", "left").withColumn(
        "ix", F.year("month_start") * 12 + F.month("month_start")
    )
    year = Window.partitionBy("year").orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    line = Window.partitionBy().orderBy("ix")
    back = lambda c, n: F.max(c).over(line.rangeBetween(-n, -n))
    shifted = (
        base.withColumn("ytd", F.sum("v").over(year))
        .withColumns(
            {
                "pm": back("v", 1),
                "py": back("v", 12),
                "pytd": back("ytd", 12),
                "rolling": F.sum("v").over(line.rangeBetween(-11, 0)),
            }
        )
    )
    change = lambda a, b: F.when(F.col(a).isNotNull() | F.col(b).isNotNull(), F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))
    d = lambda c: (F.col(c) if isinstance(c, str) else c).cast("double")
    return shifted.select(
        "month_start",
        d("v").alias(value),
        d("pm").alias(f"{value}_previous_month"),
        d(change("v", "pm")).alias(f"{value}_mom_change"),
        ratio(change("v", "pm"), F.col("pm")).alias(f"{value}_mom_pct"),
        d("py").alias(f"{value}_previous_year"),
        d(change("v", "py")).alias(f"{value}_yoy_change"),
        ratio(change("v", "py"), F.col("py")).alias(f"{value}_yoy_pct"),
        d("ytd").alias(f"{value}_ytd"),
        d("pytd").alias(f"{value}_pytd"),
        d("rolling").alias(f"{value}_rolling_12m"),
    )


def year_month_sort(dates: DataFrame) -> DataFrame:
    return dates.withColumn("year_month_sort", month_key(F.col("calendar_date")))


def timeline_quality(items: DataFrame) -> DataFrame:
    return items.withColumn(
        "timeline_quality", F.when(F.col("valid_timeline_flag") == 1, "Valid").otherwise("Invalid source sequence")
    )
