"""Queries for measures and report result sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import forecasting, metrics, reporting, segmentation
from .oracle import ratio
from .queries_analytics import FORECAST_PARTS, _backtest, _monthly, _outlook, _series
from .queries_quality import PARTS as QUALITY_PARTS
from .queries_quality import STATEMENT_SQL, statement, validation
from .registry import register

ALL_PARTS = FORECAST_PARTS | QUALITY_PARTS


def _tables(w):
    """Tables of the measures with the grouping columns they share, opened on use."""

    class Lazy(dict):
        def __missing__(self, key):
            build = {
                "order_item": lambda: w.wide_order_item.withColumn("month_start", F.trunc(F.col("order_item_created_at").cast("date"), "MM")),
                "dated_order_item": lambda: w.wide_order_item.join(
                    w.dim_date.select(F.col("date_key").alias("order_date_key"), "is_complete_month", "month_start"), "order_date_key"
                ),
                "session": lambda: w.fact_session,
                "customer_360": lambda: w.customer_360,
                "inventory": lambda: w.fact_inventory,
                "date": lambda: w.dim_date,
                "plan": lambda: w.fact_plan.withColumn("month_start", F.col("plan_month")),
                "market_sales": lambda: w.actual_country_month,
                "plan_vs_actual": lambda: w.plan_vs_actual_monthly,
                "bridge": lambda: w.price_volume_mix,
                "forecast_monthly": lambda: _monthly(w),
                "forecast_vs_plan": lambda: _outlook(w),
                "forecast_accuracy": lambda: forecasting.forecast_accuracy(_backtest(w)),
                "forecast_scenarios": lambda: forecasting.forecast_scenarios(_monthly(w), _series(w)),
                "plan_validation": lambda: w.plan_validation,
                "plan_rejects": lambda: w.plan_rejects,
                "plan_rows": lambda: w.fact_plan,
            }
            self[key] = build[key]()
            return self[key]

    return Lazy()


def _measure(key, names, sql, by=(), where=None, extra=None, **kw):
    def build(w):
        tables = _tables(w)
        if "canonical_country" in by:  # drill across the market dimension
            tables["order_item"] = w.actual_country_month
        return metrics.evaluate(tables, names, by, where() if where else None, extra)

    register(key, build, sql, parts=ALL_PARTS, **kw)


def _s(c: str, name: str) -> str:
    return f"SUM({c})::DOUBLE AS {name}"


_by_country = ["country"]
_measure("Q01_sales_measures", ["gross_sales", "cancelled_value", "returned_value", "net_sales", "net_profit"],
         f"SELECT acquisition_source, category, {_s('gross_sales_value', 'gross_sales')}, {_s('cancelled_value', 'cancelled_value')}, "
         f"{_s('returned_value', 'returned_value')}, {_s('net_sales_value', 'net_sales')}, {_s('net_profit_value', 'net_profit')} FROM w_items GROUP BY ALL",
         by=["acquisition_source", "category"])
_measure("Q02_margin_and_leakage", ["net_margin_pct", "sales_leakage_value", "sales_leakage_pct"],
         f"""SELECT country, {ratio('SUM(net_profit_value)', 'SUM(net_sales_value)')} AS net_margin_pct, c + r AS sales_leakage_value,
               (c + r) / NULLIF(SUM(gross_sales_value)::DOUBLE, 0) AS sales_leakage_pct
             FROM (SELECT *, SUM(cancelled_value) OVER k AS c0, SUM(returned_value) OVER k AS r0, c0::DOUBLE AS c, r0::DOUBLE AS r
                   FROM w_items WINDOW k AS (PARTITION BY country)) GROUP BY country, c, r""", by=_by_country)
_measure("Q03_volume_measures", ["orders", "customers", "items", "average_order_value", "items_per_order", "net_sales_per_customer"],
         f"""SELECT age_band, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers, COUNT(*) AS items,
               {ratio('SUM(net_sales_value)', 'COUNT(DISTINCT order_id)')} AS average_order_value,
               {ratio('COUNT(*)', 'COUNT(DISTINCT order_id)')} AS items_per_order,
               {ratio('SUM(net_sales_value)', 'COUNT(DISTINCT customer_id)')} AS net_sales_per_customer FROM w_items GROUP BY age_band""",
         by=["age_band"])
_measure("Q04_complete_periods", ["net_sales_complete_periods"],
         "SELECT country, SUM(net_sales_value) FILTER (is_complete_month = 1)::DOUBLE AS net_sales_complete_periods FROM w_dated_items GROUP BY country",
         by=_by_country)

_NET_TIME = """
  SELECT m.month_start, m.yr, m.yr * 12 + m.mon AS ix, s.v FROM (SELECT DISTINCT month_start, yr, mon FROM w_days) m
  LEFT JOIN (SELECT month_start, SUM({v}) AS v FROM {t} GROUP BY 1) s ON s.month_start = m.month_start"""


def _time(value: str, source: str, expr: str) -> str:
    return f"""
    WITH b AS ({_NET_TIME.format(v=expr, t=source)}),
      y AS (SELECT a.*, (SELECT SUM(v) FROM b WHERE b.yr = a.yr AND b.ix <= a.ix) AS ytd,
              (SELECT SUM(v) FROM b WHERE b.ix BETWEEN a.ix - 11 AND a.ix) AS roll FROM b a)
    SELECT a.month_start, a.v::DOUBLE AS {value}, p.v::DOUBLE AS {value}_previous_month,
      CASE WHEN a.v IS NULL AND p.v IS NULL THEN NULL ELSE (COALESCE(a.v, 0) - COALESCE(p.v, 0))::DOUBLE END AS {value}_mom_change,
      {ratio('COALESCE(a.v, 0) - COALESCE(p.v, 0)', 'p.v')} AS {value}_mom_pct, l.v::DOUBLE AS {value}_previous_year,
      CASE WHEN a.v IS NULL AND l.v IS NULL THEN NULL ELSE (COALESCE(a.v, 0) - COALESCE(l.v, 0))::DOUBLE END AS {value}_yoy_change,
      {ratio('COALESCE(a.v, 0) - COALESCE(l.v, 0)', 'l.v')} AS {value}_yoy_pct, a.ytd::DOUBLE AS {value}_ytd,
      l.ytd::DOUBLE AS {value}_pytd, a.roll::DOUBLE AS {value}_rolling_12m
    FROM y a LEFT JOIN y p ON p.ix = a.ix - 1 LEFT JOIN y l ON l.ix = a.ix - 12"""


def _net_over_time(w):
    by_month = w.wide_order_item.groupBy(F.trunc(F.col("order_item_created_at").cast("date"), "MM").alias("month_start")).agg(
        F.sum("net_sales_value").alias("net_sales")
    )
    return metrics.over_time(by_month, w.dim_month, "net_sales")


_net_sql = _time("net_sales", "w_items", "net_sales_value")
for _key, _cols in (
    ("Q05_month_over_month", ["net_sales", "net_sales_previous_month", "net_sales_mom_change", "net_sales_mom_pct"]),
    ("Q06_year_over_year", ["net_sales", "net_sales_previous_year", "net_sales_yoy_change", "net_sales_yoy_pct"]),
    ("Q07_year_to_date", ["net_sales_ytd", "net_sales_pytd"]),
    ("Q08_rolling_12_months", ["net_sales_rolling_12m"]),
):
    register(_key, lambda w, c=_cols: _net_over_time(w).select("month_start", *c),
             f"SELECT month_start, {', '.join(_cols)} FROM ({_net_sql})")
register(
    "Q06_orders_year_over_year",
    lambda w: metrics.over_time(w.sales_monthly, w.dim_month, "orders").select("month_start", "orders", "orders_previous_year", "orders_yoy_pct"),
    f"SELECT month_start, orders, orders_previous_year, orders_yoy_pct FROM ({_time('orders', 'w_sales', 'orders')})",
)
_measure("Q09_session_counts", ["sessions", "identified_sessions", "product_view_sessions", "cart_sessions", "purchase_sessions", "abandoned_cart_sessions"],
         """SELECT browser, COUNT(*) AS sessions, COUNT(*) FILTER (events_with_user_id > 0) AS identified_sessions,
              COUNT(*) FILTER (product_view_flag = 1) AS product_view_sessions, COUNT(*) FILTER (cart_flag = 1) AS cart_sessions,
              COUNT(*) FILTER (purchase_flag = 1) AS purchase_sessions, COUNT(*) FILTER (cart_flag = 1 AND purchase_flag = 0) AS abandoned_cart_sessions
            FROM w_visits GROUP BY browser""", by=["browser"])
_measure("Q10_session_rates", ["identified_session_rate", "session_conversion_rate", "product_to_cart_rate", "cart_to_purchase_rate", "cart_abandonment_rate",
                               "average_events_per_session", "average_session_minutes", "average_event_identity_coverage"],
         f"""SELECT traffic_source, AVG(identified_session_flag) AS identified_session_rate, {ratio('SUM(purchase_flag)', 'COUNT(*)')} AS session_conversion_rate,
              {ratio('SUM(cart_flag)', 'SUM(product_view_flag)')} AS product_to_cart_rate, {ratio('SUM(purchase_flag)', 'SUM(cart_flag)')} AS cart_to_purchase_rate,
              {ratio('SUM(cart_abandoned_flag)', 'SUM(cart_flag)')} AS cart_abandonment_rate, AVG(event_count) AS average_events_per_session,
              AVG(session_duration_seconds) / 60 AS average_session_minutes, AVG(event_identity_coverage_rate) AS average_event_identity_coverage
            FROM w_visits GROUP BY traffic_source""", by=["traffic_source"],
         rounded=["identified_session_rate", "average_events_per_session", "average_session_minutes", "average_event_identity_coverage"])
_measure("Q11_customer_measures", ["purchasing_customers", "repeat_customers", "repeat_customer_rate"],
         f"""SELECT country, COUNT(*) AS purchasing_customers, COUNT(*) FILTER (order_count > 1) AS repeat_customers,
              {ratio('COUNT(*) FILTER (order_count > 1)', 'COUNT(*)')} AS repeat_customer_rate FROM w_c360 GROUP BY country""", by=_by_country)
_measure("Q12_return_measures", ["returned_items", "return_eligible_items", "observed_return_rate", "cancelled_items", "item_cancellation_rate"],
         f"""SELECT department, CAST(SUM(returned_item_flag) AS BIGINT) AS returned_items,
              CAST(SUM(return_observation_eligible_flag) AS BIGINT) AS return_eligible_items,
              {ratio('SUM(returned_item_flag)', 'SUM(return_observation_eligible_flag)')} AS observed_return_rate,
              CAST(SUM(cancelled_item_flag) AS BIGINT) AS cancelled_items, {ratio('SUM(cancelled_item_flag)', 'COUNT(*)')} AS item_cancellation_rate
            FROM w_items GROUP BY department""", by=["department"])
_measure("Q13_timeline_measures", ["valid_timeline_items", "valid_timeline_rate", "average_ship_lead_days", "median_ship_lead_days",
                                   "median_delivery_lead_days", "median_end_to_end_lead_days"],
         f"""SELECT distribution_center_id, COUNT(*) FILTER (valid_timeline_flag = 1) AS valid_timeline_items,
              {ratio('SUM(valid_timeline_flag)', 'COUNT(*)')} AS valid_timeline_rate, AVG(ship_lead_days) AS average_ship_lead_days,
              median(ship_lead_days) AS median_ship_lead_days, median(delivery_lead_days) AS median_delivery_lead_days,
              median(end_to_end_lead_days) AS median_end_to_end_lead_days FROM w_items GROUP BY 1""", by=["distribution_center_id"],
         rounded=["average_ship_lead_days", "median_ship_lead_days", "median_delivery_lead_days", "median_end_to_end_lead_days"])
_measure("Q14_p90_end_to_end", ["p90_end_to_end_lead_days"],
         """SELECT department, quantile_cont(end_to_end_lead_days, 0.9) FILTER (valid_timeline_flag = 1) AS p90_end_to_end_lead_days
            FROM w_items GROUP BY department""", by=["department"], rounded=["p90_end_to_end_lead_days"])
_measure("Q15_delivered_within_7_days", ["delivered_within_7_days", "delivered_within_7_days_rate"],
         f"""SELECT country, COUNT(*) FILTER (valid_timeline_flag = 1 AND end_to_end_lead_days <= 7) AS delivered_within_7_days,
              {ratio('COUNT(*) FILTER (valid_timeline_flag = 1 AND end_to_end_lead_days <= 7)', 'SUM(valid_timeline_flag)')} AS delivered_within_7_days_rate
            FROM w_items GROUP BY country""", by=_by_country)
_measure("Q15_sla_what_if", ["within_sla_items", "sla_breach_rate"],
         f"""SELECT country, a AS within_sla_items, 1 - {ratio('a', 'b')} AS sla_breach_rate FROM (
              SELECT country, COUNT(*) FILTER (valid_timeline_flag = 1 AND end_to_end_lead_days <= 400) AS a,
                COUNT(end_to_end_lead_days) FILTER (valid_timeline_flag = 1) AS b FROM w_items GROUP BY country)""",
         by=_by_country, extra=metrics.within_days(400))
_measure("Q16_inventory_measures", ["inventory_units", "sold_inventory_units", "unsold_inventory_units", "sell_through_rate", "unsold_inventory_cost",
                                    "aged_181_inventory_units", "median_days_to_sell"],
         f"""SELECT distribution_center_id, COUNT(*) AS inventory_units, COUNT(sold_at) AS sold_inventory_units, COUNT(*) - COUNT(sold_at) AS unsold_inventory_units,
              {ratio('COUNT(sold_at)', 'COUNT(*)')} AS sell_through_rate, (SUM(unit_cost) FILTER (sold_at IS NULL))::DOUBLE AS unsold_inventory_cost,
              COUNT(*) FILTER (inventory_age_bucket = '181+ days') AS aged_181_inventory_units, median(days_to_sell)::DOUBLE AS median_days_to_sell
            FROM w_units GROUP BY 1""", by=["distribution_center_id"])
_measure("Q17_date_labels", ["latest_data_date", "partial_period_label", "selected_date_range"],
         """SELECT yr AS year, MAX(d) AS latest_data_date, CASE WHEN MAX(is_complete_month) = 1 THEN 'Complete periods' ELSE 'Partial period included' END
              AS partial_period_label, strftime(MIN(d), '%d %b %Y') || ' - ' || strftime(MAX(d), '%d %b %Y') AS selected_date_range FROM w_days GROUP BY yr""",
         by=["year"])
register("Q18_calculated_columns",
         lambda w: metrics.timeline_quality(w.wide_order_item).groupBy(
             "timeline_quality").agg(F.count("*").alias("items")).unionByName(
             metrics.year_month_sort(w.dim_date).groupBy(F.col("year_month_sort").cast("string").alias("timeline_quality")).agg(F.count("*").alias("items"))),
         """SELECT CASE valid_timeline_flag WHEN 1 THEN 'Valid' ELSE 'Invalid source sequence' END AS timeline_quality, COUNT(*) AS items FROM w_items GROUP BY 1
            UNION ALL SELECT strftime(d, '%Y%m'), COUNT(*) FROM w_days GROUP BY 1""")
_measure("Q19_plan_measures", ["net_sales", "plan_net_sales", "plan_units", "plan_achievement_pct", "plan_variance", "plan_variance_pct", "plan_status"],
         f"""SELECT canonical_country, month_start, a AS net_sales, p AS plan_net_sales, u AS plan_units, a / NULLIF(p, 0) AS plan_achievement_pct,
              COALESCE(a, 0) - COALESCE(p, 0) AS plan_variance, (COALESCE(a, 0) - COALESCE(p, 0)) / NULLIF(p, 0) AS plan_variance_pct,
              CASE WHEN p IS NULL THEN 'No plan' WHEN a / NULLIF(p, 0) >= 1 THEN 'On or above plan' WHEN a / NULLIF(p, 0) >= 0.95 THEN 'Within 5% of plan'
                ELSE 'Below plan' END AS plan_status
            FROM (SELECT COALESCE(m.canonical_country, t.canonical_country) AS canonical_country, COALESCE(m.month_start, t.plan_month) AS month_start,
                    net_sales_value::DOUBLE AS a, plan_net_sales_usd::DOUBLE AS p, t.plan_units AS u
                  FROM w_market_months m FULL JOIN w_targets t ON t.canonical_country = m.canonical_country AND t.plan_month = m.month_start)""",
         by=["canonical_country", "month_start"], rounded=["plan_variance"], digits=4)
_measure("Q20_markets_below_plan", ["markets_below_plan"],
         """SELECT region, COUNT(DISTINCT canonical_country) FILTER (achievement_rate < 1 AND is_complete_month = 1 AND in_plan_horizon = 1)
              AS markets_below_plan FROM w_pva GROUP BY region""", by=["region"])
_measure("Q21_bridge_measures", ["volume_effect", "mix_effect", "price_effect", "total_variance", "bridge_residual", "volume_share_of_variance",
                                 "prior_asp", "current_asp", "asp_change_pct"],
         f"""SELECT *, volume_effect + mix_effect + price_effect - total_variance AS bridge_residual, volume_effect / NULLIF(total_variance, 0)
              AS volume_share_of_variance, (current_asp - prior_asp) / NULLIF(prior_asp, 0) AS asp_change_pct
            FROM (SELECT comparison_label, SUM(volume_effect) AS volume_effect, SUM(mix_effect) AS mix_effect, SUM(price_effect) AS price_effect,
              SUM(CAST(total_variance AS DECIMAL(18,4)))::DOUBLE AS total_variance, {ratio('SUM(CAST(revenue_prior AS DECIMAL(18,4)))', 'SUM(units_prior)')} AS prior_asp,
              {ratio('SUM(CAST(revenue_current AS DECIMAL(18,4)))', 'SUM(units_current)')} AS current_asp FROM w_pvm GROUP BY comparison_label)""",
         by=["comparison_label"], rounded=["volume_effect", "mix_effect", "price_effect", "bridge_residual", "volume_share_of_variance"], digits=3)
_money = lambda c: f"SUM(CAST({c} AS DECIMAL(18,4)))::DOUBLE"
_measure("Q22_forecast_measures", ["forecast_net_sales", "expected_net_sales", "expected_achievement_pct", "gap_to_plan", "backtest_mape", "champion_model"],
         f"""SELECT (SELECT {_money('forecast_net_sales_usd')} FROM w_best) AS forecast_net_sales, {_money('expected_net_sales_usd')} AS expected_net_sales,
              {ratio(_money('expected_net_sales_usd'), _money('plan_net_sales_usd'))} AS expected_achievement_pct, {_money('gap_to_plan_usd')} AS gap_to_plan,
              (SELECT MIN(mape) FROM w_accuracy) AS backtest_mape, (SELECT arg_min(model, mape) FROM w_accuracy) AS champion_model FROM w_outlook""",
         rounded=["backtest_mape", "forecast_net_sales", "expected_net_sales", "gap_to_plan"], digits=3)
_measure("Q23_scenario_measures", ["scenario_net_sales", "scenario_net_profit"],
         f"SELECT scenario, {_money('forecast_net_sales_usd')} AS scenario_net_sales, {_money('forecast_net_profit_usd')} AS scenario_net_profit FROM w_scenarios GROUP BY 1",
         by=["scenario"], rounded=["scenario_net_sales", "scenario_net_profit"], digits=3)
_measure("Q23_adjusted_forecast", ["adjusted_forecast", "adjusted_achievement_pct", "scenario_vs_plan"],
         f"""SELECT f * 1.05 AS adjusted_forecast, f * 1.05 / p AS adjusted_achievement_pct, s - p AS scenario_vs_plan FROM (
              SELECT (SELECT {_money('forecast_net_sales_usd')} FROM w_best) AS f, (SELECT SUM(plan_net_sales_usd)::DOUBLE FROM w_targets) AS p,
                (SELECT {_money('forecast_net_sales_usd')} FROM w_scenarios) AS s)""",
         extra=metrics.with_adjustment(0.05), rounded=["adjusted_forecast", "adjusted_achievement_pct", "scenario_vs_plan"], digits=3)
_measure("Q24_quality_measures", ["blocking_test_failures", "quarantined_plan_rows", "plan_rows_accepted_pct"],
         f"""SELECT (SELECT COUNT(*) FROM w_commercial_gate WHERE status = 'FAIL') AS blocking_test_failures, r AS quarantined_plan_rows,
              {ratio('a', 'a + r')} AS plan_rows_accepted_pct FROM (SELECT (SELECT COUNT(*) FROM w_rejects) AS r, (SELECT COUNT(*) FROM w_targets) AS a)""")

# --- report result sets ------------------------------------------------------

_report = lambda key, build, sql=None, **kw: register(key, build, sql, parts=ALL_PARTS, **kw)
_effects = ["volume_effect", "mix_effect", "price_effect"]
# The channels of the driver data, for the SQL side; the pivot itself takes those it finds.
CHANNELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_report("R01_scorecard_listing", lambda w: reporting.scorecard_listing(w.commercial_scorecard),
        "SELECT * EXCLUDE (kpi_format, mom_variance, yoy_variance, plan_variance) FROM w_score ORDER BY kpi_order")
_report("R02_sales_trend", lambda w: reporting.sales_trend(w.sales_monthly, dt.date(2000, 1, 1)),
        "SELECT month_start, net_sales_value, net_profit_value FROM w_sales WHERE is_complete_month = 1 AND month_start >= DATE '2000-01-01'")
_report("R03_region_by_year", lambda w: reporting.region_by_year(w.plan_vs_actual_region),
        "SELECT * EXCLUDE month_rows REPLACE (year(plan_year)::INTEGER AS plan_year) FROM w_region_years")
_report("R04_market_achievement", lambda w: reporting.market_achievement(w.plan_vs_actual_monthly),
        f"""SELECT canonical_country, region, SUM(a)::DOUBLE AS actual_usd, SUM(p)::DOUBLE AS plan_usd, (SUM(a) - SUM(p))::DOUBLE AS variance_usd,
              {ratio('SUM(a)', 'SUM(p)')} AS achievement
            FROM (SELECT *, CAST(actual_net_sales_usd AS DECIMAL(18,4)) AS a, CAST(plan_net_sales_usd AS DECIMAL(18,4)) AS p FROM w_pva
                  WHERE is_complete_month = 1 AND in_plan_horizon = 1 AND plan_net_sales_usd IS NOT NULL AND actual_net_sales_usd IS NOT NULL)
            GROUP BY ALL""")
_report("R05_bridge_totals", lambda w: reporting.bridge_totals(w.price_volume_mix),
        """SELECT *, round(revenue_prior / units_prior, 2) AS asp_prior, round(revenue_current / units_current, 2) AS asp_current,
             round(revenue_current / units_current / (revenue_prior / units_prior) - 1, 4) AS asp_change, round(volume_effect / total_variance, 4) AS volume_share
           FROM (SELECT comparison_order, comparison_label, SUM(CAST(revenue_prior AS DECIMAL(18,4)))::DOUBLE AS revenue_prior,
             SUM(CAST(revenue_current AS DECIMAL(18,4)))::DOUBLE AS revenue_current, SUM(CAST(total_variance AS DECIMAL(18,4)))::DOUBLE AS total_variance,
             SUM(volume_effect) AS volume_effect, SUM(mix_effect) AS mix_effect, SUM(price_effect) AS price_effect,
             CAST(SUM(units_prior) AS BIGINT) AS units_prior, CAST(SUM(units_current) AS BIGINT) AS units_current FROM w_pvm GROUP BY 1, 2)""",
        rounded=_effects, digits=3)
_report("R05_bridge_detail", lambda w: reporting.bridge_detail(w.price_volume_mix),
        "SELECT * EXCLUDE comparison_order FROM w_pvm WHERE comparison_label LIKE 'YTD%'", rounded=_effects, digits=3)
_report("R06_waterfall", lambda w: reporting.waterfall(w.price_volume_mix),
        """SELECT SUM(CAST(revenue_prior AS DECIMAL(18,4)))::DOUBLE AS prior_revenue, SUM(volume_effect) AS volume, SUM(mix_effect) AS mix,
             SUM(price_effect) AS price, SUM(CAST(revenue_current AS DECIMAL(18,4)))::DOUBLE AS current_revenue FROM w_pvm WHERE comparison_label LIKE 'YTD%'""",
        rounded=["volume", "mix", "price"], digits=3)
_report("R07_model_comparison", lambda w: reporting.model_comparison(forecasting.forecast_accuracy(_backtest(w))),
        "SELECT * EXCLUDE horizon FROM w_accuracy", rounded=["mape", "mape_first_step", "mape_final_step", "worst_month_ape", "bias"])
_report("R07_outlook", lambda w: reporting.outlook_listing(_outlook(w)),
        "SELECT * EXCLUDE (actual_net_sales_usd, forecast_net_sales_usd) FROM w_outlook", rounded=["expected_net_sales_usd", "gap_to_plan_usd"], digits=4)
_report("R07_scenario_totals", lambda w: reporting.scenario_totals(forecasting.forecast_scenarios(_monthly(w), _series(w))),
        f"""SELECT scenario, {_money('forecast_net_sales_usd')} AS net_sales, {_money('forecast_net_profit_usd')} AS net_profit,
              MAX(assumed_margin_rate) AS assumed_margin, MAX(volume_multiplier) AS volume_multiplier, MAX(narrative) AS assumption FROM w_scenarios GROUP BY 1""",
        rounded=["net_sales", "net_profit", "assumed_margin"], digits=3)
_report("R07_scenario_totals_all_models",
        lambda w: reporting.scenario_totals(forecasting.forecast_scenarios(_monthly(w, forecasting.MODELS), _series(w))))
_report("R08_validation_listing", lambda w: reporting.gate_listing(validation(w)), "SELECT * EXCLUDE failure_rate FROM w_commercial_gate")
_report("R08_statement_listing", lambda w: reporting.statement_listing(statement(w)),
        f"SELECT * EXCLUDE value_delta FROM ({STATEMENT_SQL})")
_report("R08_reject_listing", lambda w: reporting.reject_listing(w.plan_rejects),
        "SELECT submitted_country, plan_month, currency_code, reject_reason FROM w_rejects")
_report("R09_funnel_pivot", lambda w: reporting.funnel_pivot(w.funnel_stage_channel, CHANNELS),
        f"""SELECT k AS stage_order, s AS stage, {", ".join(f"CAST(COALESCE(SUM(reached) FILTER (traffic_source = '{c}'), 0) AS BIGINT) AS \"{c}\"" for c in CHANNELS)}
           FROM (SELECT k, s, traffic_source, CASE k WHEN 1 THEN 1 WHEN 2 THEN product_view_flag WHEN 3 THEN cart_flag ELSE purchase_flag END AS reached
             FROM w_visits, (VALUES (1, 'Sessions'), (2, 'Product Viewed'), (3, 'Cart Reached'), (4, 'Purchase')) v(k, s)) GROUP BY 1, 2""")
_report("R10_category_margin", lambda w: reporting.category_margin(w.product_performance_category),
        f"""SELECT department, category, SUM(net_sales_value)::DOUBLE AS net_sales_value, {ratio('SUM(net_profit_value)', 'SUM(net_sales_value)')} AS net_margin_rate,
              COUNT(*) AS items FROM w_items GROUP BY ALL ORDER BY net_sales_value DESC LIMIT 8""")
_report("R11_center_leads", lambda w: reporting.center_leads(w.delivery_performance_dc),
        """SELECT distribution_center_name, median(end_to_end_lead_days) AS median_end_to_end_lead_days, quantile_cont(end_to_end_lead_days, 0.9) AS p90_end_to_end_lead_days
           FROM w_items i JOIN w_centers c ON c.distribution_center_id = i.distribution_center_id GROUP BY i.distribution_center_id, 1""",
        rounded=["median_end_to_end_lead_days", "p90_end_to_end_lead_days"])
_report("R12_retention_matrix", lambda w: reporting.retention_matrix(w.cohort_retention),
        "SELECT cohort_month, " + ", ".join(f"MAX(retention_rate) FILTER (months_since_first_order = {m}) AS m{m}" for m in range(13)) +
        """ FROM w_cohorts WHERE months_since_first_order <= 12 GROUP BY 1 ORDER BY 1 DESC LIMIT 24""")
_report("R13_outlook_lines", lambda w: reporting.outlook_lines(_outlook(w)),
        """SELECT month_start, actual_net_sales_usd, CASE WHEN month_start = (SELECT MAX(month_start) FROM w_outlook WHERE actual_net_sales_usd IS NOT NULL)
             THEN actual_net_sales_usd ELSE forecast_net_sales_usd END AS forecast_net_sales_usd, plan_net_sales_usd FROM w_outlook""",
        rounded=["forecast_net_sales_usd"], digits=4)
_report("R14_plan_status_counts", lambda w: reporting.plan_status_counts(w.plan_vs_actual_monthly),
        f"""SELECT plan_status, COUNT(*) AS months, round({_money('actual_net_sales_usd')}, 0) AS actual_usd, round({_money('plan_net_sales_usd')}, 0) AS plan_usd
            FROM w_pva GROUP BY 1""")
_report("R15_rfm_shares", lambda w: segmentation.segment_shares(segmentation.rfm_segment(segmentation.rfm_features(w.customer_360))[1]))
