"""Queries for staging, dimensions, facts and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.measures import band
from ..functions.times import lead_days, timeline_is_valid
from ..operators import acquisition, dimensions, facts, planning
from .oracle import lead, ratio, ymd
from .registry import register

# --- staging -----------------------------------------------------------------

register("B01_stage_users", lambda w: w.stg_users, "SELECT * FROM w_users")
register("B02_stage_products", lambda w: w.stg_products, "SELECT * FROM w_products",
         doubles=["unit_cost", "retail_price"])
register("B03_stage_orders", lambda w: w.stg_orders, "SELECT * FROM w_orders")
register("B04_stage_order_items", lambda w: w.stg_order_items, "SELECT * FROM w_lines", doubles=["sale_price"])
register("B05_stage_events", lambda w: w.stg_events, "SELECT * FROM w_events")
register("B06_reconstruct_sessions", lambda w: w.stg_sessions, "SELECT * FROM w_sessions")
register("B07_stage_inventory", lambda w: w.stg_inventory_events, "SELECT * FROM w_stock",
         doubles=["unit_cost", "retail_price"])
register("B08_stage_distribution_centers", lambda w: w.stg_distribution_centers, "SELECT * FROM w_centers")
register("B09_stage_plan", lambda w: w.stg_plan_submissions, "SELECT * FROM w_plan",
         doubles=["budget_rate_to_usd", "plan_net_sales_local", "plan_net_sales_usd"])

# --- dimensions --------------------------------------------------------------

register(
    "C01_dim_date",
    lambda w: w.dim_date,
    """
    SELECT date_key, d AS calendar_date, yr AS year, quarter(d)::INTEGER AS quarter_number,
      'Q' || quarter(d) AS quarter_label, mon AS month_number, monthname(d) AS month_name,
      strftime(d, '%b %Y') AS month_year, month_start, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start,
      CAST(date_trunc('year', d) AS DATE) AS year_start, weekofyear(d)::INTEGER AS iso_week_number,
      isodow(d)::INTEGER AS iso_day_of_week, dayname(d) AS day_name, (isodow(d) > 5)::INTEGER AS is_weekend,
      is_complete_month, fiscal_year, 'FY' || fiscal_year AS fiscal_year_label, fmon AS fiscal_month_number,
      ((fmon - 1) // 3 + 1)::INTEGER AS fiscal_quarter_number, 'FQ' || ((fmon - 1) // 3 + 1) AS fiscal_quarter_label,
      make_date(fiscal_year - 1, 10, 1) AS fiscal_year_start
    FROM w_days""",
)
register("C02_date_bounds", lambda w: w.date_bounds, "SELECT * FROM w_bounds")
register(
    "C03_dim_customer",
    lambda w: w.dim_customer,
    f"""
    SELECT user_id, age, age_band, gender, COALESCE(country, 'Unknown') AS country, COALESCE(state, 'Unknown') AS state,
      COALESCE(city, 'Unknown') AS city, postal_code, latitude, longitude, acquisition_source, registered_at,
      {ymd('registered_at')} AS registered_date_key
    FROM w_customers""",
)
register(
    "C04_dim_product",
    lambda w: w.dim_product,
    f"""
    SELECT product_id, category, product_name, brand, department, sku, distribution_center_id, unit_cost, retail_price,
      retail_price - unit_cost AS unit_margin,
      CASE WHEN retail_price > 0 THEN {ratio('retail_price - unit_cost', 'retail_price')} END AS unit_margin_rate,
      CASE WHEN retail_price < 25 THEN 'Under $25' WHEN retail_price < 50 THEN '$25-$49'
        WHEN retail_price < 100 THEN '$50-$99' WHEN retail_price < 200 THEN '$100-$199' ELSE '$200+' END AS price_band
    FROM w_products""",
    doubles=["unit_cost", "retail_price", "unit_margin"],
)
register("C05_dim_distribution_center", lambda w: w.dim_distribution_center, "SELECT * FROM w_centers")
register(
    "C06_dim_session_traffic_source",
    lambda w: w.dim_session_traffic_source,
    """SELECT CAST(rank() OVER (ORDER BY traffic_source) AS INTEGER) AS session_traffic_source_key, traffic_source
       FROM w_sessions GROUP BY traffic_source""",
)
register(
    "C07_dim_acquisition_source",
    lambda w: w.dim_acquisition_source,
    """SELECT CAST(rank() OVER (ORDER BY acquisition_source) AS INTEGER) AS acquisition_source_key, acquisition_source
       FROM w_users GROUP BY acquisition_source""",
)
register(
    "C08_dim_country",
    lambda w: w.dim_country,
    """SELECT CAST(rank() OVER (ORDER BY canonical_country, source_country_value) AS INTEGER) AS country_key, *
       FROM w_master""",
)
register(
    "C09_dim_market",
    lambda w: w.dim_market,
    """SELECT CAST(rank() OVER (ORDER BY canonical_country) AS INTEGER) AS market_key, canonical_country, region,
         sub_region, COUNT(*) AS source_spellings_mapped
       FROM w_master WHERE canonical_country <> 'Unknown' GROUP BY canonical_country, region, sub_region""",
)
register(
    "C10_dim_month",
    lambda w: w.dim_month,
    """SELECT month_start, yr * 100 + mon AS month_key, yr AS year, mon AS month_number,
         monthname(month_start) AS month_name, strftime(month_start, '%b %Y') AS month_year,
         'Q' || quarter(month_start) AS quarter_label, fiscal_year, 'FY' || fiscal_year AS fiscal_year_label,
         'FQ' || ((fmon - 1) // 3 + 1) AS fiscal_quarter_label, fmon AS fiscal_month_number, is_complete_month
       FROM w_days GROUP BY ALL""",
)
register(
    "C11_band",
    lambda w: w.stg_products.groupBy(
        band(F.col("distribution_center_id"), (11, 21, 31, 41), ("1-10", "11-20", "21-30", "31-40", "41+"), "Unknown").alias("size_band")
    ).agg(F.count("*").alias("products"), F.min("distribution_center_id").alias("smallest")),
    """SELECT CASE WHEN p_size IS NULL THEN 'Unknown' WHEN p_size > 40 THEN '41+' WHEN p_size > 30 THEN '31-40'
         WHEN p_size > 20 THEN '21-30' WHEN p_size > 10 THEN '11-20' ELSE '1-10' END AS size_band,
         COUNT(*) AS products, MIN(p_size) AS smallest FROM part GROUP BY 1""",
)

# --- facts -------------------------------------------------------------------

register(
    "D01_fact_order",
    lambda w: w.fact_order,
    f"""
    SELECT order_id, o.user_id AS customer_id, order_status, created_at AS order_created_at, shipped_at, delivered_at,
      returned_at, {ymd('created_at')} AS order_date_key, item_count, acquisition_source,
      {lead('created_at', 'shipped_at')} AS ship_lead_days, {lead('shipped_at', 'delivered_at')} AS delivery_lead_days,
      {lead('created_at', 'delivered_at')} AS end_to_end_lead_days,
      {lead('delivered_at', 'returned_at')} AS return_cycle_days,
      CASE WHEN shipped_at < created_at OR delivered_at < shipped_at OR returned_at < delivered_at
        OR (delivered_at IS NOT NULL AND shipped_at IS NULL) OR (returned_at IS NOT NULL AND delivered_at IS NULL)
        THEN 0 ELSE 1 END AS valid_timeline_flag,
      (order_status = 'Cancelled')::INTEGER AS cancelled_order_flag,
      (order_status = 'Returned')::INTEGER AS returned_order_flag,
      (order_status = 'Complete')::INTEGER AS completed_order_flag
    FROM w_orders o JOIN w_customers c ON c.user_id = o.user_id""",
)
register(
    "D02_fact_order_item",
    lambda w: w.fact_order_item,
    "SELECT * EXCLUDE (country, age_band, category, department, brand, month_start, net_unit) FROM w_items",
    doubles=["sale_price", "unit_cost", "gross_margin_value", "gross_sales_value", "cancelled_value",
             "returned_value", "net_sales_value", "net_profit_value"],
)
register("D03_fact_session", lambda w: w.fact_session, "SELECT * FROM w_visits")
register("D04_fact_inventory", lambda w: w.fact_inventory, "SELECT * FROM w_units", doubles=["unit_cost", "retail_price"])
register(
    "D05_lead_days",
    lambda w: w.stg_order_items.groupBy(
        lead_days(F.col("created_at"), F.col("delivered_at")).alias("end_to_end_lead_days")
    ).agg(F.count("*").alias("items")),
    f"SELECT {lead('created_at', 'delivered_at')} AS end_to_end_lead_days, COUNT(*) AS items FROM w_lines GROUP BY 1",
)
register(
    "D06_valid_timeline",
    lambda w: w.stg_order_items.groupBy(
        "item_status",
        timeline_is_valid(*[F.col(c) for c in ("created_at", "shipped_at", "delivered_at", "returned_at")]).alias("valid"),
    ).agg(F.count("*").alias("items")),
    "SELECT item_status, valid_timeline_flag AS valid, COUNT(*) AS items FROM w_items GROUP BY 1, 2",
)
register("D07_fact_plan", lambda w: w.fact_plan, "SELECT * FROM w_targets",
         doubles=["budget_rate_to_usd", "plan_net_sales_local", "plan_net_sales_usd"])
register("D08_plan_rejects", lambda w: w.plan_rejects, "SELECT * FROM w_rejects", doubles=["plan_net_sales_local"])

# --- acquisition and funnel --------------------------------------------------

register(
    "E01_funnel_stage",
    lambda w: w.funnel_stage_channel,
    f"""
    SELECT traffic_source, k AS stage_order, s AS stage, n AS stage_sessions, {ratio('n', 'total')} AS conversion_from_session_rate,
      {ratio('n', 'before')} AS conversion_from_previous_stage_rate
    FROM (SELECT *, MAX(n) FILTER (k = 1) OVER (PARTITION BY traffic_source) AS total,
            LAG(n) OVER (PARTITION BY traffic_source ORDER BY k) AS before
          FROM (SELECT traffic_source, k, s, CAST(SUM(CASE k WHEN 1 THEN 1 WHEN 2 THEN product_view_flag
                  WHEN 3 THEN cart_flag ELSE purchase_flag END) AS BIGINT) AS n
                FROM w_visits, (VALUES (1, 'Sessions'), (2, 'Product Viewed'), (3, 'Cart Reached'), (4, 'Purchase')) v(k, s)
                GROUP BY ALL))""",
)
_visit_sums = """CAST(SUM(cart_flag) AS BIGINT) AS cart_sessions, CAST(SUM(purchase_flag) AS BIGINT) AS purchase_sessions,
      CAST(SUM(cart_abandoned_flag) AS BIGINT) AS abandoned_cart_sessions"""
_visit_rates = f"""{ratio('SUM(purchase_flag)', 'COUNT(*)')} AS session_conversion_rate,
      {ratio('SUM(cart_abandoned_flag)', 'SUM(cart_flag)')} AS cart_abandonment_rate"""
register(
    "E02_funnel_monthly",
    lambda w: w.funnel_monthly_channel,
    f"""
    SELECT CAST(date_trunc('month', session_start_at) AS DATE) AS month_start, traffic_source, COUNT(*) AS sessions,
      COUNT(DISTINCT customer_id) AS users, CAST(SUM(product_view_flag) AS BIGINT) AS product_view_sessions,
      {_visit_sums}, {_visit_rates}, AVG(event_count) AS avg_events_per_session,
      AVG(session_duration_seconds) AS avg_session_duration_seconds,
      AVG(event_identity_coverage_rate) AS avg_event_identity_coverage_rate
    FROM w_visits GROUP BY 1, 2""",
    rounded=["avg_events_per_session", "avg_session_duration_seconds", "avg_event_identity_coverage_rate"],
)
register(
    "E03_cart_abandonment_segments",
    lambda w: w.cart_abandonment_segments,
    f"""
    SELECT CASE g WHEN 3 THEN 'Traffic Source' WHEN 5 THEN 'Browser' ELSE 'Country' END AS segment_type,
      COALESCE(traffic_source, browser, country) AS segment_value, * EXCLUDE (g, traffic_source, browser, country)
    FROM (SELECT grouping(traffic_source, browser, country) AS g, traffic_source, browser, country, COUNT(*) AS sessions,
            {_visit_sums}, {_visit_rates}
          FROM w_visits GROUP BY GROUPING SETS ((traffic_source), (browser), (country)) HAVING COUNT(*) >= 500)""",
)
register(
    "E03_cart_abandonment_segments_min20",
    lambda w: acquisition.cart_abandonment_segments(w.fact_session, min_sessions=20),
    f"""
    SELECT CASE g WHEN 3 THEN 'Traffic Source' WHEN 5 THEN 'Browser' ELSE 'Country' END AS segment_type,
      COALESCE(traffic_source, browser, country) AS segment_value, * EXCLUDE (g, traffic_source, browser, country)
    FROM (SELECT grouping(traffic_source, browser, country) AS g, traffic_source, browser, country, COUNT(*) AS sessions,
            {_visit_sums}, {_visit_rates}
          FROM w_visits GROUP BY GROUPING SETS ((traffic_source), (browser), (country)) HAVING COUNT(*) >= 20)""",
)
register(
    "E04_channel_quality",
    lambda w: w.channel_quality,
    f"""
    SELECT traffic_source, COUNT(*) AS sessions, COUNT(DISTINCT customer_id) AS users, {_visit_sums},
      AVG(event_count) AS avg_events_per_session, AVG(event_identity_coverage_rate) AS avg_event_identity_coverage_rate,
      {_visit_rates}
    FROM w_visits GROUP BY traffic_source""",
    rounded=["avg_events_per_session", "avg_event_identity_coverage_rate"],
)
register(
    "E05_acquisition_source_value",
    lambda w: w.acquisition_source_value,
    f"""
    SELECT acquisition_source, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers,
      SUM(gross_sales_value)::DOUBLE AS gross_sales_value, SUM(net_sales_value)::DOUBLE AS net_sales_value,
      SUM(net_profit_value)::DOUBLE AS net_profit_value,
      {ratio('SUM(net_sales_value)', 'COUNT(DISTINCT customer_id)')} AS net_sales_per_customer
    FROM w_items GROUP BY acquisition_source""",
)

# --- revenue, product, customer ----------------------------------------------

register("F01_sales_monthly", lambda w: w.sales_monthly, "SELECT * FROM w_sales")
_product_cols = f"""COUNT(DISTINCT product_id) AS products, COUNT(DISTINCT order_id) AS orders,
      COUNT(*) AS items, SUM(net_sales_value)::DOUBLE AS net_sales_value, SUM(net_profit_value)::DOUBLE AS net_profit_value,
      {ratio('SUM(net_profit_value)', 'SUM(net_sales_value)')} AS net_margin_rate,
      {ratio('SUM(returned_item_flag)', 'SUM(return_observation_eligible_flag)')} AS observed_return_rate"""
register(
    "F02_product_performance",
    lambda w: w.product_performance_category,
    f"""
    SELECT department, category, COUNT(DISTINCT customer_id) AS customers, SUM(gross_sales_value)::DOUBLE AS gross_sales_value,
      CAST(SUM(returned_item_flag) AS BIGINT) AS returned_items,
      {ratio('SUM(cancelled_item_flag)', 'COUNT(*)')} AS cancellation_rate, {_product_cols}
    FROM w_items GROUP BY department, category""",
)
register(
    "F03_product_performance_brand",
    lambda w: w.product_performance_brand,
    f"SELECT brand, COUNT(DISTINCT category) AS categories, {_product_cols} FROM w_items GROUP BY brand",
)
register(
    "F04_geography_performance",
    lambda w: w.geography_performance_country,
    f"""
    SELECT canonical_country AS country, region, sub_region, COUNT(DISTINCT order_id) AS orders,
      COUNT(DISTINCT customer_id) AS customers, COUNT(*) AS items, SUM(net_sales_value)::DOUBLE AS net_sales_value,
      SUM(net_profit_value)::DOUBLE AS net_profit_value,
      {ratio('SUM(net_sales_value)', 'COUNT(DISTINCT order_id)')} AS average_order_value,
      {ratio('SUM(returned_item_flag)', 'SUM(return_observation_eligible_flag)')} AS observed_return_rate,
      string_agg(DISTINCT country, ' | ' ORDER BY country) AS source_spellings
    FROM w_items JOIN w_spellings ON source_country_value = country GROUP BY ALL""",
)
register("F05_customer_360", lambda w: w.customer_360, "SELECT * FROM w_c360",
         doubles=["gross_sales_value", "net_sales_value", "net_profit_value"])
register("F06_cohort_retention", lambda w: w.cohort_retention, "SELECT * FROM w_cohorts")
register(
    "F07_executive_snapshot",
    lambda w: w.executive_snapshot,
    f"""
    WITH i AS (SELECT MAX(order_item_created_at) AS t, SUM(gross_sales_value)::DOUBLE AS g, SUM(net_sales_value)::DOUBLE AS n,
        SUM(net_profit_value)::DOUBLE AS p, COUNT(DISTINCT order_id) AS o, COUNT(DISTINCT customer_id) AS c,
        {ratio('SUM(returned_item_flag)', 'SUM(return_observation_eligible_flag)')} AS r,
        {ratio('SUM(cancelled_item_flag)', 'COUNT(*)')} AS x FROM w_items),
      v AS (SELECT COUNT(*) AS s, {ratio('SUM(purchase_flag)', 'COUNT(*)')} AS k,
        {ratio('SUM(cart_abandoned_flag)', 'SUM(cart_flag)')} AS a FROM w_visits),
      q AS (SELECT {ratio('SUM(repeat_customer_flag)', 'COUNT(*)')} AS z FROM w_c360)
    SELECT 'Data as of' AS metric_name, CAST(t AS VARCHAR) AS metric_value, NULL::DOUBLE AS numeric_value FROM i
    UNION ALL SELECT name, printf('$%,.2f', round(val, 2)), val FROM i,
      LATERAL (VALUES ('Gross Sales', g), ('Net Sales', n), ('Net Profit', p)) m(name, val)
    UNION ALL SELECT name, printf('%,d', val), val::DOUBLE FROM i, LATERAL (VALUES ('Orders', o), ('Customers', c)) m(name, val)
    UNION ALL SELECT 'Sessions', printf('%,d', s), s::DOUBLE FROM v
    UNION ALL SELECT name, printf('%.2f%%', round(val * 100, 2)), val FROM i, v, q,
      LATERAL (VALUES ('Observed Return Rate', r), ('Item Cancellation Rate', x), ('Session Conversion Rate', k),
        ('Cart Abandonment Rate', a), ('Repeat Customer Rate', z)) m(name, val)""",
)

# --- operations and inventory ------------------------------------------------

_leads = ",\n      ".join(
    f"AVG({c}) AS avg_{c}, quantile_cont({c}, 0.5) AS median_{c}, quantile_cont({c}, 0.9) AS p90_{c}"
    for c in ("ship_lead_days", "delivery_lead_days", "end_to_end_lead_days")
)
_lead_names = [
    f"{s}_{c}" for c in ("ship_lead_days", "delivery_lead_days", "end_to_end_lead_days") for s in ("avg", "median", "p90")
]
_ops = f"""COUNT(*) AS items, CAST(SUM(valid_timeline_flag) AS BIGINT) AS valid_timeline_items, {_leads},
      {ratio('SUM(returned_item_flag)', 'SUM(return_observation_eligible_flag)')} AS observed_return_rate"""
register(
    "G01_operations_monthly",
    lambda w: w.operations_monthly,
    f"SELECT month_start, {_ops}, {ratio('SUM(cancelled_item_flag)', 'COUNT(*)')} AS cancellation_rate "
    "FROM w_dated_items GROUP BY month_start",
    rounded=_lead_names,
)
register(
    "G02_delivery_performance",
    lambda w: w.delivery_performance_dc,
    f"SELECT i.distribution_center_id, distribution_center_name, {_ops} FROM w_items i "
    "JOIN w_centers c ON c.distribution_center_id = i.distribution_center_id GROUP BY ALL",
    rounded=_lead_names,
)
register(
    "G03_return_risk_segments",
    lambda w: w.return_risk_segments,
    f"""
    SELECT t AS segment_type, v AS segment_value, COUNT(*) AS items,
      CAST(SUM(return_observation_eligible_flag) AS BIGINT) AS eligible_items,
      CAST(SUM(returned_item_flag) AS BIGINT) AS returned_items, SUM(returned_value)::DOUBLE AS returned_value,
      {ratio('SUM(returned_item_flag)', 'SUM(return_observation_eligible_flag)')} AS observed_return_rate
    FROM (SELECT *, unnest(['Category', 'Country', 'Age Band', 'Acquisition Source']) AS t,
            unnest([category, country, age_band, acquisition_source]) AS v FROM w_items)
    GROUP BY 1, 2 HAVING SUM(return_observation_eligible_flag) >= 100""",
)
register(
    "G04_inventory_performance",
    lambda w: w.inventory_performance,
    f"""
    SELECT p.department, p.category, distribution_center_name, COUNT(*) AS inventory_units, COUNT(sold_at) AS sold_units,
      COUNT(*) - COUNT(sold_at) AS unsold_units, {ratio('COUNT(sold_at)', 'COUNT(*)')} AS sell_through_rate,
      quantile_cont(days_to_sell::DOUBLE, 0.5) AS median_days_to_sell, quantile_cont(days_to_sell::DOUBLE, 0.9) AS p90_days_to_sell,
      COUNT(*) FILTER (inventory_age_bucket = '181+ days') AS aged_181_plus_units,
      COALESCE(SUM(u.unit_cost) FILTER (sold_at IS NULL), 0)::DOUBLE AS unsold_inventory_cost,
      COALESCE(SUM(u.retail_price) FILTER (sold_at IS NULL), 0)::DOUBLE AS unsold_inventory_retail_value
    FROM w_units u JOIN w_products p ON p.product_id = u.product_id
    JOIN w_centers c ON c.distribution_center_id = u.distribution_center_id GROUP BY ALL""",
    rounded=["median_days_to_sell", "p90_days_to_sell"],
)

# --- planning ----------------------------------------------------------------

register("H01_actual_country_month", lambda w: w.actual_country_month, "SELECT * FROM w_market_months",
         doubles=["gross_sales_value", "net_sales_value", "net_profit_value"])
register("H02_plan_vs_actual_monthly", lambda w: w.plan_vs_actual_monthly, "SELECT * FROM w_pva")
register("H03_plan_vs_actual_region", lambda w: w.plan_vs_actual_region, "SELECT * FROM w_region_years")
_effects = ["volume_effect", "mix_effect", "price_effect"]
register("H04_price_volume_mix", lambda w: w.price_volume_mix, "SELECT * FROM w_pvm", rounded=_effects, digits=4)
register("H05_commercial_scorecard", lambda w: w.commercial_scorecard, "SELECT * FROM w_score")
register(
    "H06_plan_target_baseline",
    lambda w: planning.plan_target_baseline(w.actual_country_month),
    """
    SELECT canonical_country, plan_month, growth, round_even(usd / 100, 0) * 100 AS plan_net_sales_usd,
      CAST(round_even(units * factor, 0) AS BIGINT) AS plan_units
    FROM (SELECT *, growth * CASE WHEN month(plan_month) > 10 THEN 1.05::DOUBLE ELSE 1.0::DOUBLE END AS factor,
            sales * (growth * CASE WHEN month(plan_month) > 10 THEN 1.05::DOUBLE ELSE 1.0::DOUBLE END) AS usd
          FROM (SELECT m.canonical_country, CAST(month_start + INTERVAL 1 YEAR AS DATE) AS plan_month,
                  net_sales_value::DOUBLE AS sales, net_units AS units,
                  COALESCE(CASE WHEN b.s > 0 THEN greatest(1.0::DOUBLE, least(2.2::DOUBLE, a.s::DOUBLE / b.s::DOUBLE)) END,
                    1.15::DOUBLE) AS growth
                FROM w_market_months m
                LEFT JOIN w_years a ON a.k = m.canonical_country AND a.y = year(m.month_start)
                LEFT JOIN w_years b ON b.k = m.canonical_country AND b.y = year(m.month_start) - 1))
    WHERE usd > 0""",
    parts={"w_years": "SELECT canonical_country AS k, year(month_start) AS y, SUM(net_sales_value) AS s FROM w_market_months GROUP BY ALL"},
)
