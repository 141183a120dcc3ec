"""Reference SQL for an independent engine, put together from named parts.

``PARTS`` holds one query per intermediate table. ``compose`` takes a final
SELECT and prefixes the parts it mentions, in dependency order.
"""

from __future__ import annotations

import re

from .driver_tables import (
    ALIASES,
    COMPARISONS,
    EVENT_SHIFT_DAYS,
    FX,
    PLAN_FROM,
    PLAN_TO,
    REGION_CURRENCY,
    country_spelling,
)

_NAME = re.compile(r"\bw_[a-z0-9_]+\b")


def compose(sql: str, extra: dict[str, str] | None = None) -> str:
    known = PARTS | (extra or {})
    done: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in known and name not in done:
                visit(known[name])
                done.append(name)

    visit(sql)
    if not done:
        return sql
    if sql.lstrip().upper().startswith("WITH"):
        sql = f"SELECT * FROM ({sql})"
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in done) + "\n" + sql


def boundary_minutes(a: str, b: str) -> str:
    return f"date_diff('minute', {a}, {b})"


def lead(a: str, b: str) -> str:
    return f"CASE WHEN {b} >= {a} THEN date_diff('minute', {a}, {b}) / 1440.0::DOUBLE END"


def ratio(a: str, b: str) -> str:
    return f"({a})::DOUBLE / NULLIF(({b})::DOUBLE, 0)"


def ymd(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)"


def _timeline(created: str) -> str:
    return f"""
      {lead(created, 'shipped_at')} AS ship_lead_days,
      {lead('shipped_at', 'delivered_at')} AS delivery_lead_days,
      {lead(created, 'delivered_at')} AS end_to_end_lead_days,
      {lead('delivered_at', 'returned_at')} AS return_cycle_days,
      CASE WHEN COALESCE(shipped_at < {created}, FALSE)
             OR (delivered_at IS NOT NULL AND COALESCE(delivered_at < shipped_at, TRUE))
             OR (returned_at IS NOT NULL AND COALESCE(returned_at < delivered_at, TRUE))
           THEN 0 ELSE 1 END AS valid_timeline_flag"""


_currency = " ".join(f"WHEN '{r}' THEN '{c}'" for r, c in REGION_CURRENCY.items())
_spans = ", ".join(
    f"('{c.label}', {c.order}, DATE '{c.prior_from}', DATE '{c.prior_to}', DATE '{c.current_from}', DATE '{c.current_to}')"
    for c in COMPARISONS
)

PARTS: dict[str, str] = {
    "w_users": f"""
      SELECT c_custkey AS user_id, 18 + CAST(floor((c_acctbal + 1000) / 200) AS INTEGER) AS age,
        CASE WHEN c_acctbal < 4500 THEN 'F' ELSE 'M' END AS gender, r_name AS state,
        CAST(c_nationkey AS VARCHAR) AS postal_code, n_name AS city, {country_spelling()} AS country,
        c_nationkey * 1.5::DOUBLE AS latitude, c_nationkey * (-2.5)::DOUBLE AS longitude,
        c_mktsegment AS acquisition_source,
        TIMESTAMP '1994-06-01 00:00:00' + to_days(c_nationkey) AS registered_at
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "w_products": """
      SELECT p_partkey AS product_id,
        CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.6 AS DECIMAL(18,4)) AS unit_cost,
        p_type AS category, p_name AS product_name, p_brand AS brand,
        CAST(p_retailprice AS DECIMAL(18,4)) AS retail_price,
        CASE WHEN p_size <= 25 THEN 'Small' ELSE 'Large' END AS department,
        'SKU-' || p_partkey AS sku, p_size AS distribution_center_id
      FROM part""",
    "w_orders": """
      SELECT o_orderkey AS order_id, o_custkey AS user_id,
        CASE o_orderstatus WHEN 'F' THEN CASE WHEN pr = 3 THEN 'Returned' ELSE 'Complete' END
          WHEN 'O' THEN CASE WHEN pr = 4 THEN 'Cancelled' ELSE 'Shipped' END
          ELSE 'Processing' END AS order_status,
        CASE WHEN o_totalprice < 250000 THEN 'F' ELSE 'M' END AS gender,
        o_orderdate AS created_at,
        CASE WHEN o_orderstatus = 'F' AND pr = 3 THEN o_orderdate + to_days(9) + to_minutes(5) END AS returned_at,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_days(4 - pr) + to_minutes(pr * 17) END AS shipped_at,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(4) + to_minutes(pr * 41) END AS delivered_at,
        pr AS item_count
      FROM (SELECT *, CAST(o_orderpriority[1] AS INTEGER) AS pr FROM orders)""",
    "w_lines": """
      SELECT id AS order_item_id, l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS product_id,
        id AS inventory_item_id, item_status, o_orderdate AS created_at, ship AS shipped_at, deliver AS delivered_at,
        CASE WHEN l_returnflag = 'R' THEN deliver + to_days(3) END AS returned_at, sale_price,
        CAST(l_suppkey AS INTEGER) AS distribution_center_id
      FROM (
        SELECT *, l_orderkey * 10 + l_linenumber AS id,
          CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Cancelled'
            ELSE CASE WHEN l_linestatus = 'F' THEN 'Complete' ELSE 'Shipped' END END AS item_status,
          CASE WHEN l_returnflag <> 'A' THEN l_shipdate END AS ship,
          CASE WHEN l_returnflag <> 'A' AND l_linestatus = 'F'
            THEN l_shipdate + to_days(l_linenumber) + to_minutes(CAST(l_quantity AS INTEGER) * 37) END AS deliver,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
            AS sale_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "w_events": f"""
      SELECT event_id, CASE WHEN event_type <> 'signup' THEN e.user_id END AS user_id, event_id AS sequence_number,
        e.user_id || '-' || CAST(moved AS DATE) AS session_id, moved AS created_at,
        CASE WHEN event_type <> 'view' THEN u.city END AS city, u.state, u.postal_code,
        'b' || (e.user_id % 5) AS browser, COALESCE(u.acquisition_source, 'Unknown') AS traffic_source,
        '/' || event_type AS uri,
        CASE event_type WHEN 'view' THEN 'product' WHEN 'click' THEN 'cart' WHEN 'error' THEN 'cancel'
          WHEN 'signup' THEN 'home' ELSE event_type END AS event_type
      FROM (SELECT *, ts - to_days({EVENT_SHIFT_DAYS}) AS moved FROM events) e
      LEFT JOIN w_users u ON u.user_id = e.user_id""",
    "w_sessions": """
      SELECT session_id, MAX(user_id) AS user_id, CAST(COUNT(*) AS INTEGER) AS event_count,
        CAST(COUNT(user_id) AS INTEGER) AS events_with_user_id,
        COUNT(user_id)::DOUBLE / COUNT(*) AS event_identity_coverage_rate,
        MIN(created_at) AS session_start_at, MAX(created_at) AS session_end_at,
        (array_agg(city ORDER BY sequence_number) FILTER (city IS NOT NULL))[1] AS city,
        (array_agg(state ORDER BY sequence_number) FILTER (state IS NOT NULL))[1] AS state,
        (array_agg(postal_code ORDER BY sequence_number) FILTER (postal_code IS NOT NULL))[1] AS postal_code,
        (array_agg(browser ORDER BY sequence_number))[1] AS browser,
        (array_agg(traffic_source ORDER BY sequence_number))[1] AS traffic_source,
        (array_agg(event_type ORDER BY sequence_number))[1] AS first_event_type,
        (array_agg(event_type ORDER BY sequence_number DESC))[1] AS final_event_type,
        CAST(COALESCE(bool_or(event_type = 'home'), FALSE) AS INTEGER) AS home_flag,
        CAST(COALESCE(bool_or(event_type = 'department'), FALSE) AS INTEGER) AS department_flag,
        CAST(COALESCE(bool_or(event_type = 'product'), FALSE) AS INTEGER) AS product_view_flag,
        CAST(COALESCE(bool_or(event_type = 'cart'), FALSE) AS INTEGER) AS cart_flag,
        CAST(COALESCE(bool_or(event_type = 'purchase'), FALSE) AS INTEGER) AS purchase_flag,
        CAST(COALESCE(bool_or(event_type = 'cancel'), FALSE) AS INTEGER) AS cancel_event_flag
      FROM w_events WHERE session_id IS NOT NULL GROUP BY session_id""",
    "w_stock": """
      SELECT l_orderkey * 10 + l_linenumber AS inventory_item_id, l_partkey AS product_id, o_orderdate AS created_at,
        CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS sold_at, p.unit_cost, p.category, p.product_name, p.brand,
        p.retail_price, p.department, p.sku, CAST(l_suppkey AS INTEGER) AS distribution_center_id
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN w_products p ON p.product_id = l_partkey""",
    "w_centers": """
      SELECT CAST(s_suppkey AS INTEGER) AS distribution_center_id, s_name AS distribution_center_name,
        s_nationkey * 1.5::DOUBLE AS latitude, s_nationkey * (-2.5)::DOUBLE AS longitude FROM supplier""",
    "w_master": f"""
      SELECT n_name AS source_country_value, n_name AS canonical_country, r_name AS region,
        r_name || ' ' || n_regionkey AS sub_region, 0 AS is_alias, NULL::VARCHAR AS alias_reason
      FROM nation JOIN region ON n_regionkey = r_regionkey
      UNION ALL
      SELECT a.spelling, n_name, r_name, r_name || ' ' || n_regionkey, 1, 'Local spelling used by one customer segment'
      FROM (VALUES {", ".join(f"('{a}', '{n}')" for a, n, _ in ALIASES)}) a(spelling, nation)
      JOIN nation ON n_name = a.nation JOIN region ON n_regionkey = r_regionkey
      UNION ALL SELECT 'Unknown', 'Unknown', 'Unassigned', 'Unassigned', 0, NULL""",
    "w_fx": "SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', CAST({r} AS DECIMAL(18,6)))" for c, _, r in FX)
    + ") t(currency_code, budget_rate_to_usd)",
    "w_bounds": """
      SELECT CAST(least(e.a, i.a, s.a) AS DATE) AS min_date, CAST(greatest(e.b, i.b, s.b) AS DATE) AS max_date
      FROM (SELECT MIN(created_at) a, MAX(created_at) b FROM w_events) e,
           (SELECT MIN(created_at) a, MAX(created_at) b FROM w_lines) i,
           (SELECT MIN(created_at) a, MAX(COALESCE(sold_at, created_at)) b FROM w_stock) s""",
    "w_days": """
      SELECT d, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, year(d)::INTEGER AS yr, month(d)::INTEGER AS mon,
        CAST(date_trunc('month', d) AS DATE) AS month_start,
        CAST(d < date_trunc('month', max_date) AS INTEGER) AS is_complete_month,
        (month(d) - 10 + 12)::INTEGER % 12 + 1 AS fmon,
        year(d + INTERVAL 3 MONTH)::INTEGER AS fiscal_year
      FROM (SELECT CAST(unnest(generate_series(min_date, max_date, INTERVAL 1 DAY)) AS DATE) AS d, max_date FROM w_bounds)""",
    "w_customers": """
      SELECT *, CASE WHEN age IS NULL THEN 'Unknown' WHEN age >= 65 THEN '65+' WHEN age >= 55 THEN '55-64'
        WHEN age >= 45 THEN '45-54' WHEN age >= 35 THEN '35-44' WHEN age >= 25 THEN '25-34' ELSE '18-24' END AS age_band
      FROM w_users""",
    "w_items": f"""
      SELECT i.order_item_id, i.order_id, i.user_id AS customer_id, i.product_id, i.inventory_item_id,
        p.distribution_center_id, c.acquisition_source, c.country, c.age_band, p.category, p.department, p.brand,
        i.item_status, i.created_at AS order_item_created_at, shipped_at, delivered_at, returned_at,
        {ymd('i.created_at')} AS order_date_key, CAST(date_trunc('month', i.created_at) AS DATE) AS month_start,
        i.sale_price, p.unit_cost, i.sale_price - p.unit_cost AS gross_margin_value,
        CASE WHEN i.sale_price > 0
          THEN (i.sale_price - p.unit_cost)::DOUBLE / i.sale_price::DOUBLE END AS gross_margin_rate,
        i.sale_price AS gross_sales_value,
        CAST(i.sale_price * (item_status = 'Cancelled')::INTEGER AS DECIMAL(18,4)) AS cancelled_value,
        CAST(i.sale_price * (item_status = 'Returned')::INTEGER AS DECIMAL(18,4)) AS returned_value,
        CAST(i.sale_price * (item_status IN ('Complete', 'Shipped'))::INTEGER AS DECIMAL(18,4)) AS net_sales_value,
        CAST((i.sale_price - p.unit_cost) * (item_status IN ('Complete', 'Shipped'))::INTEGER AS DECIMAL(18,4))
          AS net_profit_value,
        (item_status = 'Cancelled')::INTEGER AS cancelled_item_flag,
        (item_status = 'Returned')::INTEGER AS returned_item_flag,
        (item_status IN ('Complete', 'Returned'))::INTEGER AS return_observation_eligible_flag,
        (item_status IN ('Complete', 'Shipped'))::INTEGER AS net_unit, {_timeline('i.created_at')}
      FROM w_lines i JOIN w_products p ON p.product_id = i.product_id JOIN w_customers c ON c.user_id = i.user_id""",
    "w_dated_items": "SELECT i.*, d.is_complete_month, d.fiscal_year, d.fmon FROM w_items i JOIN w_days d ON d.date_key = i.order_date_key",
    "w_visits": f"""
      SELECT session_id, s.user_id AS customer_id, session_start_at, session_end_at,
        {ymd('session_start_at')} AS session_date_key, browser, traffic_source,
        COALESCE(c.country, 'Unknown') AS country, event_count, events_with_user_id, event_identity_coverage_rate,
        (events_with_user_id > 0)::INTEGER AS identified_session_flag,
        CASE WHEN session_end_at >= session_start_at
          THEN date_diff('second', session_start_at, session_end_at) END AS session_duration_seconds,
        first_event_type, final_event_type, home_flag, department_flag, product_view_flag, cart_flag, purchase_flag,
        cancel_event_flag, (cart_flag > purchase_flag)::INTEGER AS cart_abandoned_flag,
        (product_view_flag = 1 AND cart_flag + purchase_flag = 0)::INTEGER AS early_product_exit_flag,
        CASE WHEN purchase_flag = 1 THEN 'Purchase' WHEN cart_flag = 1 THEN 'Cart'
          WHEN product_view_flag = 1 THEN 'Product' WHEN department_flag = 1 THEN 'Department' ELSE 'Home' END
          AS highest_stage
      FROM w_sessions s LEFT JOIN w_customers c ON c.user_id = s.user_id""",
    "w_units": f"""
      SELECT inventory_item_id, product_id, distribution_center_id, created_at AS inventory_created_at, sold_at,
        {ymd('created_at')} AS inventory_created_date_key, unit_cost, retail_price,
        (sold_at IS NOT NULL)::INTEGER AS sold_flag,
        CASE WHEN sold_at >= created_at THEN date_diff('day', created_at, sold_at) END AS days_to_sell,
        CASE WHEN sold_at IS NULL THEN age END AS unsold_age_days,
        CASE WHEN sold_at IS NOT NULL THEN 'Sold' WHEN age > 180 THEN '181+ days' WHEN age > 90 THEN '91-180 days'
          WHEN age > 60 THEN '61-90 days' WHEN age > 30 THEN '31-60 days' ELSE '0-30 days' END AS inventory_age_bucket
      FROM (SELECT *, date_diff('day', CAST(created_at AS DATE), (SELECT CAST(MAX(created_at) AS DATE) FROM w_events)) AS age
            FROM w_stock)""",
    "w_spellings": "SELECT source_country_value, canonical_country, region, sub_region FROM w_master",
    "w_market_months": """
      SELECT m.canonical_country, m.region, m.sub_region, i.month_start, i.fiscal_year,
        'FQ' || ((i.fmon - 1) // 3 + 1) AS fiscal_quarter_label, i.is_complete_month,
        SUM(gross_sales_value) AS gross_sales_value, SUM(net_sales_value) AS net_sales_value,
        SUM(net_profit_value) AS net_profit_value, CAST(SUM(net_unit) AS BIGINT) AS net_units,
        COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers
      FROM w_dated_items i JOIN w_spellings m ON m.source_country_value = i.country GROUP BY ALL""",
    "w_plan_raw": f"""
      SELECT CASE WHEN pm < DATE '2001-01-01' THEN 'FY2000-PLAN-V1' ELSE 'FY2001-PLAN-V1' END AS submission_batch,
        CASE WHEN k = 'NATION_12' THEN 'NATION_12 ' WHEN k = 'NATION_20' AND pm = DATE '2001-02-01' THEN 'NATION-20'
          WHEN k = 'NATION_3' AND pm < DATE '2001-01-01' THEN 'NACION_3' ELSE k END AS submitted_country,
        pm AS plan_month,
        CASE WHEN k = 'NATION_24' AND pm = DATE '2001-06-01' THEN 'XXX' WHEN k = 'NATION_1' THEN ' usd' ELSE ccy END
          AS currency_code,
        CAST(CASE WHEN k = 'NATION_5' AND month(pm) = 3 THEN NULL
          WHEN k = 'NATION_8' AND pm = DATE '2001-05-01' THEN -amount ELSE amount END AS DECIMAL(18,4))
          AS plan_net_sales_local,
        net_units * 11 // 10 AS plan_units
      FROM (
        SELECT a.canonical_country AS k, CAST(month_start + INTERVAL 12 MONTH AS DATE) AS pm, net_units, ccy,
          round(net_sales_value::DOUBLE * 1.1::DOUBLE / f.budget_rate_to_usd::DOUBLE, 2) AS amount
        FROM (SELECT *, CASE region {_currency} END AS ccy FROM w_market_months) a
        JOIN w_fx f ON f.currency_code = a.ccy)
      WHERE pm BETWEEN DATE '{PLAN_FROM}' AND DATE '{PLAN_TO}'
        AND NOT (k = 'NATION_9' AND pm IN (DATE '2001-03-01', DATE '2001-04-01'))""",
    "w_plan": """
      SELECT submission_batch, submitted_country, trim(submitted_country) AS submitted_country_trimmed,
        m.canonical_country, m.region, m.sub_region, plan_month, upper(trim(r.currency_code)) AS currency_code,
        budget_rate_to_usd, plan_net_sales_local,
        CAST(plan_net_sales_local * budget_rate_to_usd AS DECIMAL(18,4)) AS plan_net_sales_usd, plan_units,
        (m.canonical_country IS NULL)::INTEGER AS flag_unmapped_country,
        (budget_rate_to_usd IS NULL)::INTEGER AS flag_missing_fx_rate,
        (plan_net_sales_local IS NULL)::INTEGER AS flag_blank_target,
        COALESCE(plan_net_sales_local < 0, FALSE)::INTEGER AS flag_negative_target,
        (submitted_country <> trim(submitted_country))::INTEGER AS flag_whitespace_in_key
      FROM w_plan_raw r LEFT JOIN w_spellings m ON m.source_country_value = trim(submitted_country)
      LEFT JOIN w_fx f ON f.currency_code = upper(trim(r.currency_code))""",
    "w_accepted": """
      SELECT * FROM w_plan WHERE flag_unmapped_country + flag_missing_fx_rate + flag_blank_target + flag_negative_target = 0""",
    "w_targets": f"""
      SELECT canonical_country, region, sub_region, plan_month, {ymd('plan_month')} AS plan_date_key, currency_code,
        budget_rate_to_usd, SUM(plan_net_sales_local) AS plan_net_sales_local,
        SUM(plan_net_sales_usd) AS plan_net_sales_usd, CAST(SUM(plan_units) AS BIGINT) AS plan_units,
        MAX(submission_batch) AS submission_batch
      FROM w_accepted GROUP BY ALL""",
    "w_rejects": """
      SELECT submission_batch, submitted_country, plan_month, currency_code, plan_net_sales_local,
        CASE WHEN flag_unmapped_country = 1 THEN 'Country not present in the country master'
          WHEN flag_missing_fx_rate = 1 THEN 'No budget FX rate for the submitted currency'
          WHEN flag_blank_target = 1 THEN 'Plan value is blank' ELSE 'Plan value is negative' END AS reject_reason
      FROM w_plan
      WHERE flag_unmapped_country + flag_missing_fx_rate + flag_blank_target + flag_negative_target > 0""",
    "w_sales": f"""
      SELECT month_start, year(month_start)::INTEGER AS year, month(month_start)::INTEGER AS month_number,
        MAX(is_complete_month) AS is_complete_month, COUNT(DISTINCT order_id) AS orders,
        COUNT(DISTINCT customer_id) AS customers, COUNT(*) AS items,
        SUM(gross_sales_value)::DOUBLE AS gross_sales_value, SUM(cancelled_value)::DOUBLE AS cancelled_value,
        SUM(returned_value)::DOUBLE AS returned_value, SUM(net_sales_value)::DOUBLE AS net_sales_value,
        SUM(net_profit_value)::DOUBLE AS net_profit_value,
        {ratio('SUM(net_profit_value)', 'SUM(net_sales_value)')} AS net_margin_rate,
        {ratio('SUM(net_sales_value)', 'COUNT(DISTINCT order_id)')} AS average_order_value,
        {ratio('COUNT(*)', 'COUNT(DISTINCT order_id)')} AS items_per_order,
        {ratio('SUM(cancelled_item_flag)', 'COUNT(*)')} AS item_cancellation_rate,
        {ratio('SUM(returned_item_flag)', 'COUNT(*)')} AS item_return_rate
      FROM w_dated_items GROUP BY month_start""",
    "w_c360": f"""
      SELECT c.user_id AS customer_id, age, age_band, gender, country, state, city, acquisition_source, registered_at,
        first_order_date, last_order_date, CAST(date_trunc('month', first_order_date) AS DATE) AS first_order_cohort_month,
        date_diff('day', last_order_date, MAX(last_order_date) OVER ()) AS recency_days, order_count, item_count,
        gross_sales_value, net_sales_value, net_profit_value, {ratio('net_sales_value', 'order_count')} AS average_order_value,
        returned_items, cancelled_items, {ratio('returned_items', 'eligible')} AS observed_return_rate,
        (order_count >= 2)::INTEGER AS repeat_customer_flag
      FROM w_customers c JOIN (
        SELECT customer_id, CAST(MIN(order_item_created_at) AS DATE) AS first_order_date,
          CAST(MAX(order_item_created_at) AS DATE) AS last_order_date, COUNT(DISTINCT order_id) AS order_count,
          COUNT(*) AS item_count, SUM(gross_sales_value) AS gross_sales_value, SUM(net_sales_value) AS net_sales_value,
          SUM(net_profit_value) AS net_profit_value, CAST(SUM(returned_item_flag) AS BIGINT) AS returned_items,
          CAST(SUM(cancelled_item_flag) AS BIGINT) AS cancelled_items,
          SUM(return_observation_eligible_flag) AS eligible
        FROM w_items GROUP BY customer_id) s ON s.customer_id = c.user_id""",
    "w_cohorts": f"""
      SELECT first_month AS cohort_month, date_diff('month', first_month, month_start) AS months_since_first_order,
        FIRST(size) AS cohort_size, COUNT(*) AS active_customers, {ratio('COUNT(*)', 'FIRST(size)')} AS retention_rate
      FROM (SELECT customer_id, month_start, MIN(month_start) OVER (PARTITION BY customer_id) AS first_month
            FROM w_items WHERE net_sales_value > 0 GROUP BY customer_id, month_start)
      JOIN (SELECT f AS sm, COUNT(*) AS size FROM (SELECT MIN(month_start) AS f FROM w_items
            WHERE net_sales_value > 0 GROUP BY customer_id) GROUP BY f) ON sm = first_month
      GROUP BY ALL""",
    "w_pva": f"""
      SELECT COALESCE(a.canonical_country, t.canonical_country) AS canonical_country,
        COALESCE(a.region, t.region) AS region, COALESCE(a.month_start, t.plan_month) AS month_start,
        a.net_sales_value::DOUBLE AS actual_net_sales_usd, a.net_units AS actual_units,
        t.plan_net_sales_usd::DOUBLE AS plan_net_sales_usd, t.plan_units,
        (a.net_sales_value - t.plan_net_sales_usd)::DOUBLE AS variance_usd,
        CASE WHEN t.plan_net_sales_usd > 0 THEN {ratio('a.net_sales_value - t.plan_net_sales_usd', 't.plan_net_sales_usd')} END
          AS variance_rate,
        CASE WHEN t.plan_net_sales_usd > 0 THEN {ratio('a.net_sales_value', 't.plan_net_sales_usd')} END AS achievement_rate,
        COALESCE(a.is_complete_month, 0) AS is_complete_month,
        (COALESCE(a.month_start, t.plan_month) BETWEEN (SELECT MIN(plan_month) FROM w_targets)
          AND (SELECT MAX(plan_month) FROM w_targets))::INTEGER AS in_plan_horizon,
        CASE WHEN t.canonical_country IS NULL THEN 'Actual with no plan'
          WHEN a.canonical_country IS NULL THEN 'Plan with no actual yet'
          WHEN a.net_sales_value >= t.plan_net_sales_usd THEN 'On or above plan'
          WHEN a.net_sales_value::DOUBLE >= t.plan_net_sales_usd::DOUBLE * 0.95::DOUBLE THEN 'Within 5% of plan'
          ELSE 'Below plan' END AS plan_status
      FROM w_market_months a FULL JOIN w_targets t
        ON t.canonical_country = a.canonical_country AND t.plan_month = a.month_start""",
    "w_region_years": f"""
      SELECT region, CAST(date_trunc('year', month_start) AS DATE) AS plan_year,
        SUM(a)::DOUBLE AS actual_net_sales_usd, SUM(p)::DOUBLE AS plan_net_sales_usd,
        (SUM(a) - SUM(p))::DOUBLE AS variance_usd,
        CASE WHEN SUM(p) > 0 THEN {ratio('SUM(a)', 'SUM(p)')} END AS achievement_rate, COUNT(*) AS month_rows,
        COUNT(*) - COUNT(p) AS months_without_plan
      FROM (SELECT *, CAST(actual_net_sales_usd AS DECIMAL(18,4)) AS a, CAST(plan_net_sales_usd AS DECIMAL(18,4)) AS p
            FROM w_pva WHERE actual_net_sales_usd IS NOT NULL AND is_complete_month = 1 AND in_plan_horizon = 1)
      GROUP BY ALL""",
    "w_spans": f"SELECT * FROM (VALUES {_spans}) t(label, ord, p1, p2, c1, c2)",
    "w_pvm_base": """
      SELECT label, ord, department, category,
        COUNT(*) FILTER (old) AS u0, COUNT(*) FILTER (NOT old) AS u1,
        COALESCE(SUM(net_sales_value) FILTER (old), 0) AS r0, COALESCE(SUM(net_sales_value) FILTER (NOT old), 0) AS r1
      FROM (SELECT *, CAST(order_item_created_at AS DATE) BETWEEN p1 AND p2 AS old FROM w_items, w_spans
            WHERE net_unit = 1 AND (CAST(order_item_created_at AS DATE) BETWEEN p1 AND p2
              OR CAST(order_item_created_at AS DATE) BETWEEN c1 AND c2))
      GROUP BY ALL""",
    "w_pvm": """
      SELECT label AS comparison_label, ord AS comparison_order, department, category, u0 AS units_prior,
        u1 AS units_current, r0::DOUBLE AS revenue_prior, r1::DOUBLE AS revenue_current, a0 AS asp_prior, a1 AS asp_current,
        (r1 - r0)::DOUBLE AS total_variance,
        COALESCE((t1 - t0) * (u0 / NULLIF(t0, 0)::DOUBLE) * a0, 0) AS volume_effect,
        COALESCE(t1 * (u1 / NULLIF(t1, 0)::DOUBLE - u0 / NULLIF(t0, 0)::DOUBLE) * a0, 0) AS mix_effect,
        COALESCE(u1 * (a1 - a0), 0) AS price_effect
      FROM (SELECT *, r0::DOUBLE / NULLIF(u0, 0)::DOUBLE AS a0, r1::DOUBLE / NULLIF(u1, 0)::DOUBLE AS a1,
              CAST(SUM(u0) OVER (PARTITION BY label) AS DOUBLE) AS t0,
              CAST(SUM(u1) OVER (PARTITION BY label) AS DOUBLE) AS t1
            FROM w_pvm_base)""",
    "w_anchor": "SELECT MAX(month_start) AS m FROM w_sales WHERE is_complete_month = 1",
    "w_plan_months": """
      SELECT plan_month, SUM(plan_net_sales_usd)::DOUBLE AS plan_net_sales_usd, CAST(SUM(plan_units) AS DOUBLE) AS plan_units
      FROM w_targets GROUP BY plan_month""",
    "w_kpis": "\n      UNION ALL ".join(
        f"SELECT {i} AS kpi_order, '{n}' AS kpi_name, '{k}' AS kpi_format, month_start, {c}::DOUBLE AS v FROM w_sales"
        for i, n, k, c in (
            (1, "Net Sales", "currency", "net_sales_value"),
            (2, "Net Profit", "currency", "net_profit_value"),
            (3, "Net Margin Rate", "percent", "net_margin_rate"),
            (4, "Units Sold", "number", "items"),
            (5, "Orders", "number", "orders"),
            (6, "Active Customers", "number", "customers"),
            (7, "Average Order Value", "currency", "average_order_value"),
            (8, "Item Return Rate", "percent_inverse", "item_return_rate"),
            (9, "Item Cancellation Rate", "percent_inverse", "item_cancellation_rate"),
        )
    ),
    "w_score": f"""
      SELECT kpi_order, kpi_name, kpi_format, m AS reporting_month, a AS actual_value, b AS prior_month_value,
        y AS last_year_value, p AS plan_value, a - b AS mom_variance, a / NULLIF(b, 0) - 1 AS mom_variance_rate,
        a - y AS yoy_variance, a / NULLIF(y, 0) - 1 AS yoy_variance_rate, a - p AS plan_variance,
        a / NULLIF(p, 0) AS plan_achievement_rate,
        CASE WHEN p IS NULL THEN 'No plan'
          WHEN kpi_format <> 'percent_inverse' THEN
            CASE WHEN a >= p THEN 'Green' WHEN a >= p * 0.95::DOUBLE THEN 'Amber' ELSE 'Red' END
          ELSE CASE WHEN a <= p THEN 'Green' WHEN a <= p * 1.05::DOUBLE THEN 'Amber' ELSE 'Red' END END AS plan_rag_status
      FROM (SELECT kpi_order, kpi_name, kpi_format, m,
              MAX(v) FILTER (month_start = m) AS a, MAX(v) FILTER (month_start = m - INTERVAL 1 MONTH) AS b,
              MAX(v) FILTER (month_start = m - INTERVAL 1 YEAR) AS y,
              CASE kpi_order WHEN 1 THEN (SELECT plan_net_sales_usd FROM w_plan_months, w_anchor WHERE plan_month = m)
                WHEN 4 THEN (SELECT plan_units FROM w_plan_months, w_anchor WHERE plan_month = m) END AS p
            FROM w_kpis, w_anchor GROUP BY ALL)""",
}
