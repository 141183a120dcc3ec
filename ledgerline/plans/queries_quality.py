"""Queries for gates, reconciliation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.measures import exact_sum
from ..operators import facts, gates, profiling
from .oracle import ratio
from .registry import register


def _check(name, layer, severity, blocking, notes, failures, total) -> str:
    return (
        f"SELECT '{name}' AS check_name, '{layer}' AS layer, '{severity}' AS severity, {blocking} AS blocking, "
        f"'{notes}' AS notes, CAST(({failures}) AS BIGINT) AS failure_count, CAST(({total}) AS BIGINT) AS denominator"
    )


def _gate(checks) -> str:
    body = "\n UNION ALL ".join(_check(*c) for c in checks)
    return f"""SELECT check_name, layer, severity, failure_count, denominator,
        {ratio('failure_count', 'denominator')} AS failure_rate,
        CASE WHEN failure_count = 0 THEN 'PASS' WHEN blocking = 1 THEN 'FAIL' ELSE 'WARN' END AS status, notes
      FROM ({body})"""


def _count(table: str, where: str = "TRUE") -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE {where}"


def _unique(table: str, key: str) -> str:
    return f"SELECT COUNT(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING COUNT(*) > 1)"


_RAW = [
    (f"{t}_primary_key_unique", "raw", "CRITICAL", 1, f"{t}.{k} must be unique", _unique(src, col), _count(src))
    for t, k, src, col in (
        ("users", "id", "w_users", "user_id"),
        ("products", "id", "w_products", "product_id"),
        ("orders", "order_id", "w_orders", "order_id"),
        ("order_items", "id", "w_lines", "order_item_id"),
        ("events", "id", "w_events", "event_id"),
    )
] + [
    ("events_session_id_present", "raw", "CRITICAL", 1, "Every event must carry a session id before sessions are built",
     _count("w_events", "session_id IS NULL OR trim(session_id) = ''"), _count("w_events")),
    ("country_master_covers_source", "raw", "CRITICAL", 1, "Every country spelling must map to a market",
     "SELECT COUNT(DISTINCT country) FROM w_users WHERE country NOT IN (SELECT source_country_value FROM w_master)",
     "SELECT COUNT(DISTINCT country) FROM w_users"),
    ("fx_rates_cover_plan_currencies", "raw", "CRITICAL", 1, "Every plan currency must have a budget rate",
     "SELECT COUNT(DISTINCT upper(trim(currency_code))) FROM w_plan_raw WHERE upper(trim(currency_code)) NOT IN (SELECT currency_code FROM w_fx)",
     "SELECT COUNT(DISTINCT currency_code) FROM w_plan_raw"),
    ("events_user_id_missing", "raw", "INFO", 0, "User ids are sparse; a session takes the one id found in it",
     _count("w_events", "user_id IS NULL"), _count("w_events")),
]
_MODEL = [
    ("derived_sessions_primary_key_unique", "stg", "CRITICAL", 1, "Sessions derived from events must have one row per id",
     _unique("w_sessions", "session_id"), _count("w_sessions")),
    ("session_attributes_consistent_within_session", "stg", "CRITICAL", 1, "A session has at most one user, browser and traffic source",
     "SELECT COUNT(*) FROM (SELECT session_id FROM w_events GROUP BY 1 HAVING greatest(COUNT(DISTINCT user_id), COUNT(DISTINCT browser), COUNT(DISTINCT traffic_source)) > 1)",
     _count("w_sessions")),
    ("orders_have_customer", "stg", "CRITICAL", 1, "Every order must match a customer",
     _count("w_orders o", "NOT EXISTS (SELECT 1 FROM w_users u WHERE u.user_id = o.user_id)"), _count("w_orders")),
    ("order_items_have_order", "stg", "CRITICAL", 1, "Every item must match an order",
     _count("w_lines i", "NOT EXISTS (SELECT 1 FROM w_orders o WHERE o.order_id = i.order_id)"), _count("w_lines")),
    ("order_items_have_product", "stg", "CRITICAL", 1, "Every item must match a product",
     _count("w_lines i", "NOT EXISTS (SELECT 1 FROM w_products p WHERE p.product_id = i.product_id)"), _count("w_lines")),
    ("order_item_count_reconciles", "core", "CRITICAL", 1, "Item fact rows must equal staged item rows",
     "SELECT abs((SELECT COUNT(*) FROM w_lines) - (SELECT COUNT(*) FROM w_items))", _count("w_lines")),
    ("session_count_reconciles_to_events", "core", "CRITICAL", 1, "Session fact rows must equal distinct session ids",
     "SELECT abs((SELECT COUNT(DISTINCT session_id) FROM w_events) - (SELECT COUNT(*) FROM w_visits))",
     "SELECT COUNT(DISTINCT session_id) FROM w_events"),
    ("session_event_count_reconciles", "core", "CRITICAL", 1, "Event counts over sessions must equal event rows",
     "SELECT abs((SELECT COUNT(*) FROM w_events) - (SELECT SUM(event_count) FROM w_visits))", _count("w_events")),
    ("nonnegative_sale_price", "stg", "HIGH", 1, "Sale prices cannot be negative",
     _count("w_lines", "sale_price < 0"), _count("w_lines")),
    ("product_cost_not_above_retail", "stg", "HIGH", 1, "Cost above retail would break margins",
     _count("w_products", "unit_cost < 0 OR retail_price < 0 OR unit_cost > retail_price"), _count("w_products")),
    ("shipping_not_before_item_created", "core", "HIGH", 0, "Known source condition: early shipments have no lead time",
     _count("w_items", "shipped_at < order_item_created_at"), _count("w_items")),
    ("delivery_not_before_shipping", "core", "HIGH", 1, "Delivery must follow shipment",
     _count("w_items", "delivered_at < shipped_at"), _count("w_items")),
    ("return_not_before_delivery", "core", "HIGH", 1, "Return must follow delivery",
     _count("w_items", "returned_at < delivered_at"), _count("w_items")),
    ("partial_latest_month", "mart", "INFO", 0, "The last source month is partial and left out of comparisons",
     _count("w_sales", "is_complete_month = 0"), _count("w_sales", "is_complete_month = 0")),
]
_PLAN_ROWS, _TARGET_ROWS = _count("w_plan"), _count("w_targets")
_COMMERCIAL = [
    ("plan_country_resolves_to_master", "stg", "CRITICAL", 1, "Every submitted spelling maps to a market",
     _count("w_plan", "flag_unmapped_country = 1"), _PLAN_ROWS),
    ("plan_currency_has_budget_rate", "stg", "CRITICAL", 1, "Every submitted currency has a budget rate",
     _count("w_plan", "flag_missing_fx_rate = 1"), _PLAN_ROWS),
    ("plan_grain_unique_country_month", "core", "CRITICAL", 1, "One plan row per market and month",
     "SELECT COUNT(*) - COUNT(DISTINCT canonical_country || plan_month) FROM w_targets", _TARGET_ROWS),
    ("plan_consolidation_ties_to_submissions", "core", "CRITICAL", 1, "The consolidated plan equals the accepted rows",
     "SELECT (abs((SELECT SUM(plan_net_sales_usd) FROM w_targets) - (SELECT SUM(plan_net_sales_usd) FROM w_accepted)) > 0.01)::INTEGER", "1"),
    ("plan_fx_conversion_reconciles", "stg", "CRITICAL", 1, "Conversion reproduces at the budget rate",
     _count("w_plan", "abs(plan_net_sales_usd::DOUBLE - plan_net_sales_local::DOUBLE * budget_rate_to_usd::DOUBLE) > 0.01"), _PLAN_ROWS),
    ("actuals_tie_to_fact_order_item", "mart", "CRITICAL", 1, "Market actuals equal the item fact",
     "SELECT (abs((SELECT SUM(net_sales_value) FROM w_market_months) - (SELECT SUM(net_sales_value) FROM w_items)) > 0.01)::INTEGER", "1"),
    ("pvm_decomposition_is_exact", "mart", "CRITICAL", 1, "Effects add up to the variance of each comparison",
     "SELECT COUNT(*) FROM (SELECT comparison_label FROM w_pvm GROUP BY 1 HAVING abs(SUM(volume_effect + mix_effect + price_effect - total_variance)) > 0.01)",
     "SELECT COUNT(DISTINCT comparison_label) FROM w_pvm"),
    ("plan_target_not_blank", "stg", "HIGH", 0, "Blank cells go back to the region",
     _count("w_plan", "flag_blank_target = 1"), _PLAN_ROWS),
    ("plan_target_not_negative", "stg", "HIGH", 0, "A negative target is a sign error",
     _count("w_plan", "flag_negative_target = 1"), _PLAN_ROWS),
    ("plan_month_coverage_contiguous", "core", "HIGH", 0, "A gap is a late or skipped submission",
     "SELECT COUNT(*) FROM w_plan_gaps", _TARGET_ROWS),
    ("plan_country_key_clean", "stg", "MEDIUM", 0, "Padding in a key makes an unmatched market",
     _count("w_plan", "flag_whitespace_in_key = 1"), _PLAN_ROWS),
    ("scorecard_has_reporting_month", "mart", "HIGH", 0, "Every KPI has a value for the reporting month",
     _count("w_score", "actual_value IS NULL"), _count("w_score")),
]
PARTS = {
    "w_plan_gaps": """
      SELECT canonical_country, m FROM (
        SELECT canonical_country, CAST(unnest(generate_series(MIN(plan_month), MAX(plan_month), INTERVAL 1 MONTH)) AS DATE) AS m
        FROM w_targets GROUP BY canonical_country)
      WHERE NOT EXISTS (SELECT 1 FROM w_targets t WHERE t.canonical_country = _g.canonical_country AND t.plan_month = _g.m)""".replace(
        "GROUP BY canonical_country)", "GROUP BY canonical_country) _g"
    ),
    "w_raw_gate": _gate(_RAW),
    "w_model_gate": _gate(_MODEL),
    "w_commercial_gate": _gate(_COMMERCIAL),
}

_tables = {
    "K00": ("raw_test_results", "w_raw_gate", "source_gate", _RAW),
    "K07": ("test_results", "w_model_gate", "warehouse_gate", _MODEL),
    "K08": ("plan_validation", "w_commercial_gate", "commercial_gate", _COMMERCIAL),
}
# Many branches of these results read the items, which are written once, with the columns that any branch reads.
_LINE_MONEY = ("o_custkey", "o_orderdate", "l_partkey", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
_LINE_KEYS = ("l_orderkey", "l_linenumber", "l_quantity")
_STAMPS = ("order_date_key", "order_item_created_at", "shipped_at", "delivered_at", "returned_at")
_ACTUALS = ("order_date_key", "item_status", "country", "gross_sales_value", "net_sales_value")
_SOLD = (
    *_ACTUALS, "order_item_created_at", "order_id", "customer_id", "category", "department", "net_profit_value",
    "cancelled_item_flag", "returned_item_flag",
)
_TIE = {"lines": _LINE_MONEY, "wide_order_item": _ACTUALS}
# Five steps of the statement start from the market months. Each table on the way is written, the dimensions before the
# months, so that no plan is five times as wide and the sizes of both sides of a join are known when it is planned: a
# lookup that is itself a join has none until it has run, and the items would be broadcast in its place.
_PLAN_KEYS = ("plan_month", "currency_code")
_STATED = _TIE | {
    "dim_country": ("source_country_value", "canonical_country", "region", "sub_region"),
    "dim_date": ("date_key", "month_start", "fiscal_year", "fiscal_quarter_label", "is_complete_month"),
    "actual_country_month": ("canonical_country", "region", "month_start", "gross_sales_value", "net_sales_value", "net_units"),
    "plan_submissions": (*_PLAN_KEYS, "submitted_country", "plan_net_sales_local"),
    "stg_plan_submissions": (
        *_PLAN_KEYS, "canonical_country", "region", "sub_region", "budget_rate_to_usd", "plan_net_sales_usd",
        *[name for name, _ in facts.REJECT_REASONS],
    ),
}
_MODELLED = {"lines": _LINE_MONEY + _LINE_KEYS, "wide_order_item": _STAMPS}
_PLANNED = {"lines": _LINE_MONEY + _LINE_KEYS[:1], "wide_order_item": _SOLD}
_ALL = {"lines": _LINE_MONEY + _LINE_KEYS, "wide_order_item": {*_STAMPS, *_SOLD}}
_WRITTEN = {"test_results": _MODELLED, "plan_validation": _PLANNED, "actuals_tie_to_fact_order_item": _TIE}


def statement(w):
    return w.written_once(_STATED).reconciliation_statement


def validation(w):
    return w.written_once(_PLANNED).plan_validation


def every_gate(w):
    """The source, warehouse and commercial gates over the same written items."""
    own = w.written_once(_ALL)
    return own.raw_test_results, own.test_results, own.plan_validation


def _once(w, name):
    return w.written_once(_WRITTEN[name]) if name in _WRITTEN else w


for _id, (_table, _part, _title, _checks) in _tables.items():
    register(f"{_id}_{_title}", lambda w, t=_table: _once(w, t).table(t), f"SELECT * FROM {_part}", parts=PARTS)
    for _n, _c in enumerate(_checks, 1):
        register(
            f"{_id}_{_n:02d}_{_c[0]}",
            lambda w, g=_title, c=_c[0]: getattr(_once(w, c), g)(c),
            _gate([_c]),
            parts=PARTS,
        )

register(
    "K09_metric_reconciliation",
    lambda w: w.metric_reconciliation,
    """
    SELECT metric_name, s::DOUBLE AS source_value, m::DOUBLE AS modeled_value, m::DOUBLE - s::DOUBLE AS variance FROM (
      SELECT 'orders_rows' AS metric_name, (SELECT COUNT(*) FROM w_orders)::DOUBLE AS s,
        (SELECT COUNT(*) FROM w_orders o JOIN w_users u ON u.user_id = o.user_id)::DOUBLE AS m
      UNION ALL SELECT 'order_items_rows', (SELECT COUNT(*) FROM w_lines), (SELECT COUNT(*) FROM w_items)
      UNION ALL SELECT 'sessions_from_events_rows', (SELECT COUNT(DISTINCT session_id) FROM w_events), (SELECT COUNT(*) FROM w_visits)
      UNION ALL SELECT 'events_into_sessions_rows', (SELECT COUNT(*) FROM w_events), (SELECT SUM(event_count) FROM w_visits)
      UNION ALL SELECT 'gross_sales_value', (SELECT SUM(sale_price)::DOUBLE FROM w_lines), (SELECT SUM(gross_sales_value)::DOUBLE FROM w_items))""",
)
STATEMENT_SQL = """
    SELECT k AS step_order, stream, stage, entity, n AS row_count, v AS value_usd, n - LAG(n) OVER p AS row_delta,
      v - LAG(v) OVER p AS value_delta, expectation
    FROM (
      SELECT 1 AS k, 'Sales' AS stream, 'Source file' AS stage, 'order_items' AS entity, COUNT(*) AS n,
        SUM(sale_price)::DOUBLE AS v, 'Rows and gross value as delivered' AS expectation FROM w_lines
      UNION ALL SELECT 2, 'Sales', 'stg', 'stg.order_items', COUNT(*), SUM(sale_price)::DOUBLE, 'Typing and renaming only' FROM w_lines
      UNION ALL SELECT 3, 'Sales', 'core', 'core.fact_order_item', COUNT(*), SUM(gross_sales_value)::DOUBLE, 'Joins must not drop rows' FROM w_items
      UNION ALL SELECT 4, 'Sales', 'mart', 'mart.actual_country_month', CAST(SUM(net_units) AS BIGINT), SUM(gross_sales_value)::DOUBLE,
        'Gross value must still tie by market and month' FROM w_market_months
      UNION ALL SELECT 5, 'Plan', 'Source file', 'plan_submissions', COUNT(*), NULL, 'Local currency, no USD value yet' FROM w_plan_raw
      UNION ALL SELECT 6, 'Plan', 'stg', 'stg.plan_submissions', COUNT(*), SUM(plan_net_sales_usd)::DOUBLE, 'Mapped and converted, all rows kept' FROM w_plan
      UNION ALL SELECT 7, 'Plan', 'qa', 'qa.plan_rejects', COUNT(*), NULL, 'Rows sent back to the region' FROM w_rejects
      UNION ALL SELECT 8, 'Plan', 'core', 'core.fact_plan', COUNT(*), SUM(plan_net_sales_usd)::DOUBLE, 'Accepted rows only' FROM w_targets)
    WINDOW p AS (PARTITION BY stream ORDER BY k)"""
register(
    "K10_reconciliation_statement",
    statement,
    STATEMENT_SQL,
    rounded=["value_delta"],
)
register(
    "K11_blocking_failures",
    lambda w: (lambda own: own.test_results.filter(F.col("status") == "FAIL").unionByName(
        own.raw_test_results.filter(F.col("status") == "FAIL")
    ))(w.written_once(_MODELLED)),
    "SELECT * FROM w_model_gate WHERE status = 'FAIL' UNION ALL SELECT * FROM w_raw_gate WHERE status = 'FAIL'",
    parts=PARTS,
)
GATES = "SELECT 'source' AS g, status FROM w_raw_gate UNION ALL SELECT 'warehouse', status FROM w_model_gate UNION ALL SELECT 'commercial', status FROM w_commercial_gate"
register(
    "K12_final_backstop",
    lambda w: gates.final_report(dict(zip(("source", "warehouse", "commercial"), every_gate(w)))),
    f"""SELECT g AS subject, COUNT(*) FILTER (status = 'FAIL') AS errors,
         CASE WHEN COUNT(*) FILTER (status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({GATES}) GROUP BY g""",
    parts=PARTS,
)
register(
    "K13_gate_status",
    lambda w: gates.gate_status(*every_gate(w)),
    f"SELECT status, COUNT(*) AS checks FROM ({GATES}) GROUP BY status",
    parts=PARTS,
)

# --- profiling ---------------------------------------------------------------

_profiled = (
    ("order_item_id", "bigint"), ("order_id", "bigint"), ("user_id", "bigint"), ("product_id", "bigint"),
    ("inventory_item_id", "bigint"), ("item_status", "string"), ("created_at", "timestamp_ntz"),
    ("shipped_at", "timestamp_ntz"), ("delivered_at", "timestamp_ntz"), ("returned_at", "timestamp_ntz"),
    ("sale_price", "decimal(18,4)"), ("distribution_center_id", "int"),
)
register(
    "J03_cols",
    lambda w: profiling.columns(w.stg_order_items.select(*[c for c, _ in _profiled])).drop("example"),
    "\n UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS column, '{t}' AS type, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,
          round((COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*), 4) AS null_pct, COUNT(DISTINCT {c}) AS distinct FROM w_lines"""
        for i, (c, t) in enumerate(_profiled)
    ).replace("AS column,", 'AS "column",').replace("AS distinct FROM", 'AS "distinct" FROM'),
)
register(
    "J05_values",
    lambda w: profiling.values(w.stg_events, "event_type"),
    """SELECT event_type AS value, COUNT(*) AS rows, round(COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM w_events), 4) AS share
       FROM w_events GROUP BY 1 ORDER BY rows DESC, value LIMIT 20""".replace("AS rows", 'AS "rows"').replace("BY rows", 'BY "rows"'),
)
register(
    "J06_grain",
    lambda w: profiling.grain(w.raw["order_items"], "order_id", "id", name="order_items"),
    f"""SELECT 'order_items' AS "table", 'order_id, id' AS keys, n AS rows, d AS distinct_keys, n - d AS duplicates,
         CASE WHEN n = d THEN '{profiling.UNIQUE}' ELSE '{profiling.REPEATED}' END AS verdict
       FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT (order_id, order_item_id)) AS d FROM w_lines)""",
)
register(
    "J07_duplicates",
    lambda w: profiling.duplicates(w.raw["order_items"], "id", n=20),
    """SELECT order_item_id AS id, COUNT(*) AS "rows" FROM w_lines GROUP BY 1 HAVING COUNT(*) > 1
       ORDER BY "rows" DESC, id LIMIT 20""",
)
register(
    "J08_overlap",
    lambda w: profiling.overlap(w.stg_orders, "order_id", w.stg_order_items, "order_id"),
    """SELECT COUNT(a.k) AS left_distinct, COUNT(b.k) AS right_distinct, COUNT(*) FILTER (a.k = b.k) AS matched,
         COUNT(*) FILTER (b.k IS NULL) AS left_only, COUNT(*) FILTER (a.k IS NULL) AS right_only
       FROM (SELECT DISTINCT order_id AS k FROM w_orders) a FULL JOIN (SELECT DISTINCT order_id AS k FROM w_lines) b ON a.k = b.k""",
)
register(
    "J08_overlap_unmatched",
    lambda w: profiling.unmatched(w.stg_orders, "order_id", w.stg_order_items, "order_id", n=10),
    "SELECT order_id AS unmatched FROM w_orders EXCEPT SELECT order_id FROM w_lines ORDER BY 1 LIMIT 10",
)
register(
    "J09_tie",
    lambda w: profiling.tie(
        "gross sales",
        w.stg_order_items.agg(exact_sum("sale_price").alias("v")),
        w.fact_order_item.agg(exact_sum("gross_sales_value").alias("v")),
    ),
    f"""SELECT 'gross sales' AS "check", round(l, 2) AS left, round(r, 2) AS right, round(r - l, 2) AS delta,
         CASE WHEN abs(r - l) < 0.01 THEN '{profiling.TIES}' ELSE '{profiling.OPEN}' END AS verdict
       FROM (SELECT (SELECT SUM(sale_price)::DOUBLE FROM w_lines) AS l, (SELECT SUM(gross_sales_value)::DOUBLE FROM w_items) AS r)"""
    .replace("AS left", 'AS "left"').replace("AS right", 'AS "right"'),
)
register(
    "J10_session_audit",
    lambda w: profiling.session_audit(w.stg_events),
    """SELECT COUNT(*) AS derived_sessions, COUNT(*) FILTER (session_id IS NULL OR session_id = '') AS invalid_session_ids,
         COUNT(*) FILTER (u > 1) AS sessions_with_multiple_users, COUNT(*) FILTER (b > 1) AS sessions_with_multiple_browsers,
         COUNT(*) FILTER (t > 1) AS sessions_with_multiple_sources
       FROM (SELECT session_id, COUNT(DISTINCT user_id) AS u, COUNT(DISTINCT browser) AS b, COUNT(DISTINCT traffic_source) AS t
             FROM w_events GROUP BY 1)""",
)
register(
    "J10_identity_coverage",
    lambda w: profiling.identity_coverage(w.fact_session),
    """SELECT COUNT(*) AS sessions, CAST(SUM(identified_session_flag) AS BIGINT) AS identified_sessions,
         AVG(event_identity_coverage_rate) AS average_session_event_identity_coverage,
         CAST(SUM(product_view_flag) AS BIGINT) AS product_sessions, CAST(SUM(cart_flag) AS BIGINT) AS cart_sessions,
         CAST(SUM(purchase_flag) AS BIGINT) AS purchase_sessions FROM w_visits""",
    rounded=["average_session_event_identity_coverage"],
)
register(
    "J11_alias_leakage",
    lambda w: profiling.alias_leakage(w.wide_order_item, w.dim_customer, w.dim_country),
    """SELECT country AS source_spelling, canonical_country, COUNT(*) AS items,
         round(SUM(net_sales_value)::DOUBLE, 2) AS net_sales_usd
       FROM w_items JOIN w_master ON source_country_value = country WHERE is_alias = 1 GROUP BY 1, 2""",
)
register(
    "J12_plan_gaps",
    lambda w: profiling.plan_gaps(w.fact_plan),
    "SELECT canonical_country, COUNT(*) AS missing_months FROM w_plan_gaps GROUP BY 1",
    parts=PARTS,
)
register(
    "J13_plan_defects",
    lambda w: profiling.plan_defects(w.raw["plan_submissions"], w.raw["country_master"]),
    """SELECT * FROM (
         SELECT submission_batch, submitted_country, plan_month, currency_code, plan_net_sales_local,
           CASE WHEN plan_net_sales_local IS NULL THEN 'blank target' WHEN plan_net_sales_local < 0 THEN 'negative target'
             WHEN length(submitted_country) > length(trim(submitted_country)) THEN 'trailing whitespace'
             WHEN submitted_country NOT IN (SELECT canonical_country FROM w_master) THEN 'non-English country name' END AS defect
         FROM w_plan_raw) WHERE defect IS NOT NULL""",
    doubles=["plan_net_sales_local"],
)
register(
    "J14_status_mix",
    lambda w: profiling.status_mix(w.fact_order_item),
    "SELECT item_status, COUNT(*) AS line_items, round(SUM(gross_sales_value)::DOUBLE, 0) AS gross_value FROM w_items GROUP BY 1",
)
register(
    "J15_rejects_by_reason",
    lambda w: profiling.rejects_by_reason(w.plan_rejects),
    """SELECT reject_reason, COUNT(*) AS rows_quarantined, string_agg(DISTINCT submitted_country, ', ' ORDER BY submitted_country) AS markets
       FROM w_rejects GROUP BY 1""",
)
