"""Quality gates, reconciliation and gate enforcement.

A gate is a union of aggregates: each table is profiled in one pass whatever
the number of rules on it, and the whole gate is one action for the caller.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.measures import exact, exact_sum, flag, ratio
from .staging import country_lookup

TOLERANCE = 0.01


class GateFailure(RuntimeError):
    """A blocking check failed."""


def status_of(failures: Column, blocking: Column) -> Column:
    return F.when(failures == 0, "PASS").when(blocking == 1, "FAIL").otherwise("WARN")


def _finish(checks: DataFrame) -> DataFrame:
    return checks.select(
        "check_name",
        "layer",
        "severity",
        "failure_count",
        "denominator",
        ratio("failure_count", "denominator").alias("failure_rate"),
        status_of(F.col("failure_count"), F.col("blocking")).alias("status"),
        "notes",
    )


Line = tuple[str, Column]


def _line(
    name: str, layer: str, severity: str, blocking: int, notes: str, failures: Column, denominator: Column
) -> Line:
    return name, F.struct(
        F.lit(name).alias("check_name"),
        F.lit(layer).alias("layer"),
        F.lit(severity).alias("severity"),
        F.coalesce(failures.cast("bigint"), F.lit(0).cast("bigint")).alias("failure_count"),
        F.coalesce(denominator.cast("bigint"), F.lit(0).cast("bigint")).alias("denominator"),
        F.lit(blocking).alias("blocking"),
        F.lit(notes).alias("notes"),
    )


def _lines(row: DataFrame, *lines: Line) -> tuple[DataFrame, tuple[Line, ...]]:
    """Check lines read off a one-row aggregate."""
    return row, lines


def _gate(parts: Sequence[tuple[DataFrame, tuple[Line, ...]]], only: Collection[str] | None) -> DataFrame:
    """All check lines, or the named ones: what they do not need is not computed."""
    frames = []
    for row, lines in parts:
        wanted = [line for name, line in lines if only is None or name in only]
        if wanted:
            frames.append(row.select(F.inline(F.array(*wanted))))
    if not frames:
        raise ValueError(f"no such check: {only}")
    return _finish(_union(frames))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _beside(row: DataFrame, other: DataFrame) -> DataFrame:
    """Two one-row aggregates as one row; the second is a scalar subquery."""
    packed = other.select(F.struct(*other.columns).alias("_o")).scalar()
    return row.withColumn("_o", packed).select(*row.columns, "_o.*")


def _repeats(df: DataFrame, *keys: str) -> DataFrame:
    """One row: number of key values that occur more than once, and the row count."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("repeated"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    )


def _orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: rows of ``df`` without a parent, and all rows.

    Keys are counted first, so a key that holds a large part of the rows is one
    row in the join.
    """
    keys = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias("k")).filter(F.col("k").isNotNull()).distinct()
    known = known.withColumn("_hit", F.lit(1))
    return keys.join(known, "k", "left").agg(
        F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("n")).otherwise(0)), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )


def source_gate(raw: dict[str, DataFrame], only: Collection[str] | None = None) -> DataFrame:
    """Nine checks on the raw tables alone, to run before anything is modelled."""
    keys = {"users": "id", "products": "id", "orders": "order_id", "order_items": "id", "events": "id"}
    unique = [
        _lines(
            _repeats(raw[table], key),
            _line(f"{table}_primary_key_unique", "raw", "CRITICAL", 1, f"{table}.{key} must be unique",
                  F.col("repeated"), F.col("total")),
        )
        for table, key in keys.items()
    ]
    session = F.trim(F.col("session_id").cast("string"))
    visits = raw["events"].agg(
        F.count("*").alias("total"),
        F.count_if(session.isNull() | (session == "")).alias("blank"),
        F.count_if(F.col("user_id").isNull()).alias("anonymous"),
    )
    spelled = (
        raw["users"].select(F.col("country").alias("k")).filter(F.col("k").isNotNull()).distinct()
        .join(raw["country_master"].select(F.col("source_country_value").alias("k"), F.lit(1).alias("hit")).distinct(),
              "k", "left")
        .agg(F.count_if(F.col("hit").isNull()).alias("unmapped"), F.count("*").alias("total"))
    )
    codes = raw["plan_submissions"].select("currency_code").distinct()
    rates = raw["fx_budget_rates"].select(F.col("currency_code").alias("k"), F.lit(1).alias("hit")).distinct()
    priced = (
        codes.groupBy(F.upper(F.trim("currency_code")).alias("k"))
        .agg(F.count("currency_code").alias("spellings"))
        .join(rates, "k", "left")
        .agg(F.count_if(F.col("hit").isNull()).alias("missing"), F.sum("spellings").alias("total"))
    )
    rest = [
        _lines(
            visits,
            _line("events_session_id_present", "raw", "CRITICAL", 1,
                  "Every event must carry a session id before sessions are built", F.col("blank"), F.col("total")),
            _line("events_user_id_missing", "raw", "INFO", 0,
                  "User ids are sparse; a session takes the one id found in it", F.col("anonymous"), F.col("total")),
        ),
        _lines(
            spelled,
            _line("country_master_covers_source", "raw", "CRITICAL", 1,
                  "Every country spelling must map to a market", F.col("unmapped"), F.col("total")),
        ),
        _lines(
            priced,
            _line("fx_rates_cover_plan_currencies", "raw", "CRITICAL", 1,
                  "Every plan currency must have a budget rate", F.col("missing"), F.col("total")),
        ),
    ]
    return _gate(unique + rest, only)


def warehouse_gate(
    users: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    events: DataFrame,
    sessions: DataFrame,
    fact_items: DataFrame,
    fact_sessions: DataFrame,
    sales: DataFrame,
    only: Collection[str] | None = None,
) -> DataFrame:
    """Fourteen checks across staged and modelled tables.

    Only the rows of the session fact are counted against distinct session ids;
    events without an id are in the event total and in no session.
    """
    per_session = events.groupBy("session_id").agg(
        F.count("*").alias("events"),
        *[(F.coalesce(F.min(c) != F.max(c), F.lit(False))).alias(f"mixed_{c}") for c in ("user_id", "browser", "traffic_source")],
    )
    mixed = F.col("mixed_user_id") | F.col("mixed_browser") | F.col("mixed_traffic_source")
    visits = per_session.agg(
        F.count("session_id").alias("sessions"), F.sum("events").alias("events"), F.count_if(mixed).alias("mixed")
    )
    modelled = fact_sessions.agg(F.count("*").alias("m_sessions"), F.sum("event_count").alias("m_events"))
    repeated = _repeats(sessions, "session_id")
    staged = items.agg(F.count("*").alias("total"), F.count_if(F.col("sale_price") < 0).alias("negative"))
    goods = products.agg(
        F.count("*").alias("total"),
        F.count_if((F.col("unit_cost") < 0) | (F.col("retail_price") < 0) | (F.col("unit_cost") > F.col("retail_price")))
        .alias("odd"),
    )
    created = F.col("order_item_created_at")
    facts = fact_items.agg(
        F.count("*").alias("f_total"),
        F.count_if(F.col("shipped_at") < created).alias("early_ship"),
        F.count_if(F.col("delivered_at") < F.col("shipped_at")).alias("early_delivery"),
        F.count_if(F.col("returned_at") < F.col("delivered_at")).alias("early_return"),
    )
    partial = sales.agg(F.count_if(F.col("is_complete_month") == 0).alias("partial"))
    visit_row = _beside(visits, modelled)
    item_row = _beside(staged, facts)
    parts = [
        _lines(
            repeated,
            _line("derived_sessions_primary_key_unique", "stg", "CRITICAL", 1,
                  "Sessions derived from events must have one row per id", F.col("repeated"), F.col("total")),
        ),
        _lines(
            visit_row,
            _line("session_attributes_consistent_within_session", "stg", "CRITICAL", 1,
                  "A session has at most one user, browser and traffic source", F.col("mixed"), F.col("sessions")),
            _line("session_count_reconciles_to_events", "core", "CRITICAL", 1,
                  "Session fact rows must equal distinct session ids",
                  F.abs(F.col("sessions") - F.col("m_sessions")), F.col("sessions")),
            _line("session_event_count_reconciles", "core", "CRITICAL", 1,
                  "Event counts over sessions must equal event rows",
                  F.abs(F.col("events") - F.col("m_events")), F.col("events")),
        ),
        *[
            _lines(
                _orphans(child, key, parent, key),
                _line(name, "stg", "CRITICAL", 1, notes, F.col("orphans"), F.col("total")),
            )
            for name, child, key, parent, notes in (
                ("orders_have_customer", orders, "user_id", users, "Every order must match a customer"),
                ("order_items_have_order", items, "order_id", orders, "Every item must match an order"),
                ("order_items_have_product", items, "product_id", products, "Every item must match a product"),
            )
        ],
        _lines(
            item_row,
            _line("order_item_count_reconciles", "core", "CRITICAL", 1,
                  "Item fact rows must equal staged item rows", F.abs(F.col("total") - F.col("f_total")), F.col("total")),
            _line("nonnegative_sale_price", "stg", "HIGH", 1, "Sale prices cannot be negative",
                  F.col("negative"), F.col("total")),
            _line("shipping_not_before_item_created", "core", "HIGH", 0,
                  "Known source condition: early shipments have no lead time", F.col("early_ship"), F.col("f_total")),
            _line("delivery_not_before_shipping", "core", "HIGH", 1, "Delivery must follow shipment",
                  F.col("early_delivery"), F.col("f_total")),
            _line("return_not_before_delivery", "core", "HIGH", 1, "Return must follow delivery",
                  F.col("early_return"), F.col("f_total")),
        ),
        _lines(
            goods,
            _line("product_cost_not_above_retail", "stg", "HIGH", 1, "Cost above retail would break margins",
                  F.col("odd"), F.col("total")),
        ),
        _lines(
            partial,
            _line("partial_latest_month", "mart", "INFO", 0,
                  "The last source month is partial and left out of comparisons", F.col("partial"), F.col("partial")),
        ),
    ]
    return _gate(parts, only)


def missing_plan_months(plan: DataFrame) -> DataFrame:
    """Months inside a market's first..last plan month that have no plan row."""
    spans = plan.groupBy("canonical_country").agg(
        F.min("plan_month").alias("lo"), F.max("plan_month").alias("hi")
    )
    expected = spans.select(
        "canonical_country", F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("plan_month")
    )
    have = plan.select("canonical_country", "plan_month").distinct()
    return expected.join(have, ["canonical_country", "plan_month"], "left_anti")


def commercial_gate(
    plan: DataFrame,
    targets: DataFrame,
    items: DataFrame,
    actuals: DataFrame,
    bridge: DataFrame,
    scorecard: DataFrame,
    only: Collection[str] | None = None,
) -> DataFrame:
    """Twelve checks on plan consolidation, actuals, bridge and scorecard."""
    accepted = (
        F.col("flag_unmapped_country") + F.col("flag_missing_fx_rate")
        + F.col("flag_blank_target") + F.col("flag_negative_target")
    ) == 0
    converted = (F.col("plan_net_sales_local") * F.col("budget_rate_to_usd")).cast("double")
    submitted = plan.agg(
        F.count("*").alias("total"),
        *[
            F.count_if(F.col(f"flag_{c}") == 1).alias(c)
            for c in ("unmapped_country", "missing_fx_rate", "blank_target", "negative_target", "whitespace_in_key")
        ],
        F.count_if(F.abs(F.col("plan_net_sales_usd").cast("double") - converted) > TOLERANCE).alias("bad_fx"),
        F.coalesce(F.sum(F.when(accepted, exact("plan_net_sales_usd"))), F.lit(0)).alias("accepted_usd"),
    )
    consolidated = (
        targets.groupBy("canonical_country", "plan_month")
        .agg(F.count("*").alias("n"), exact_sum("plan_net_sales_usd").alias("usd"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("plan_rows"),
            (F.coalesce(F.sum("n"), F.lit(0)) - F.count("*")).alias("extra"),
            F.coalesce(F.sum("usd"), F.lit(0)).alias("plan_usd"),
        )
    )
    gaps = missing_plan_months(targets).agg(F.count("*").alias("gaps"))
    market = actuals.agg(F.coalesce(exact_sum("net_sales_value"), F.lit(0)).alias("market_usd"))
    sold = items.agg(F.coalesce(exact_sum("net_sales_value"), F.lit(0)).alias("item_usd"))
    broken = (
        bridge.groupBy("comparison_label")
        .agg(
            F.abs(
                F.sum("volume_effect") + F.sum("mix_effect") + F.sum("price_effect") - F.sum("total_variance")
            ).alias("residual")
        )
        .agg(F.count_if(F.col("residual") > TOLERANCE).alias("broken"), F.count("*").alias("comparisons"))
    )
    score = scorecard.agg(
        F.count("*").alias("total"), F.count_if(F.col("actual_value").isNull()).alias("unresolved")
    )
    planned = _beside(_beside(submitted, consolidated), gaps)
    apart = lambda a, b: flag(F.abs((F.col(a) - F.col(b)).cast("double")) > TOLERANCE)
    total = F.col("total")
    parts = [
        _lines(
            planned,
            _line("plan_country_resolves_to_master", "stg", "CRITICAL", 1,
                  "Every submitted spelling maps to a market", F.col("unmapped_country"), total),
            _line("plan_currency_has_budget_rate", "stg", "CRITICAL", 1,
                  "Every submitted currency has a budget rate", F.col("missing_fx_rate"), total),
            _line("plan_grain_unique_country_month", "core", "CRITICAL", 1,
                  "One plan row per market and month", F.col("extra"), F.col("plan_rows")),
            _line("plan_consolidation_ties_to_submissions", "core", "CRITICAL", 1,
                  "The consolidated plan equals the accepted rows", apart("plan_usd", "accepted_usd"), F.lit(1)),
            _line("plan_fx_conversion_reconciles", "stg", "CRITICAL", 1,
                  "Conversion reproduces at the budget rate", F.col("bad_fx"), total),
            _line("plan_target_not_blank", "stg", "HIGH", 0,
                  "Blank cells go back to the region", F.col("blank_target"), total),
            _line("plan_target_not_negative", "stg", "HIGH", 0,
                  "A negative target is a sign error", F.col("negative_target"), total),
            _line("plan_month_coverage_contiguous", "core", "HIGH", 0,
                  "A gap is a late or skipped submission", F.col("gaps"), F.col("plan_rows")),
            _line("plan_country_key_clean", "stg", "MEDIUM", 0,
                  "Padding in a key makes an unmatched market", F.col("whitespace_in_key"), total),
        ),
        _lines(
            _beside(market, sold),
            _line("actuals_tie_to_fact_order_item", "mart", "CRITICAL", 1,
                  "Market actuals equal the item fact", apart("market_usd", "item_usd"), F.lit(1)),
        ),
        _lines(
            broken,
            _line("pvm_decomposition_is_exact", "mart", "CRITICAL", 1,
                  "Effects add up to the variance of each comparison", F.col("broken"), F.col("comparisons")),
        ),
        _lines(
            score,
            _line("scorecard_has_reporting_month", "mart", "HIGH", 0,
                  "Every KPI has a value for the reporting month", F.col("unresolved"), total),
        ),
    ]
    return _gate(parts, only)


def metric_reconciliation(
    raw_orders: DataFrame,
    raw_items: DataFrame,
    events: DataFrame,
    items: DataFrame,
    fact_orders: DataFrame,
    fact_items: DataFrame,
    fact_sessions: DataFrame,
) -> DataFrame:
    """Five source totals next to their modelled totals."""

    def tagged(side: str, row: DataFrame, **values: Column) -> DataFrame:
        pairs = [
            F.struct(F.lit(k).alias("metric_name"), F.lit(side).alias("side"), v.cast("double").alias("v"))
            for k, v in values.items()
        ]
        return row.select(F.inline(F.array(*pairs)))

    per_session = events.groupBy("session_id").agg(F.count("*").alias("n"))
    visits = per_session.agg(F.count("session_id").alias("s"), F.sum("n").alias("e"))
    sides = [
        tagged("source", raw_orders.agg(F.count("*").alias("n")), orders_rows=F.col("n")),
        tagged("source", raw_items.agg(F.count("*").alias("n")), order_items_rows=F.col("n")),
        tagged("source", visits, sessions_from_events_rows=F.col("s"), events_into_sessions_rows=F.col("e")),
        tagged("source", items.agg(exact_sum("sale_price").alias("v")), gross_sales_value=F.col("v")),
        tagged("modeled", fact_orders.agg(F.count("*").alias("n")), orders_rows=F.col("n")),
        tagged(
            "modeled",
            fact_items.agg(F.count("*").alias("n"), exact_sum("gross_sales_value").alias("v")),
            order_items_rows=F.col("n"),
            gross_sales_value=F.col("v"),
        ),
        tagged(
            "modeled",
            fact_sessions.agg(F.count("*").alias("s"), F.sum("event_count").alias("e")),
            sessions_from_events_rows=F.col("s"),
            events_into_sessions_rows=F.col("e"),
        ),
    ]
    value = lambda s: F.max(F.when(F.col("side") == s, F.col("v")))
    return (
        _union(sides)
        .groupBy("metric_name")
        .agg(value("source").alias("source_value"), value("modeled").alias("modeled_value"))
        .withColumn("variance", F.col("modeled_value") - F.col("source_value"))
    )


def reconciliation_statement(
    raw_items: DataFrame,
    items: DataFrame,
    fact_items: DataFrame,
    actuals: DataFrame,
    raw_plan: DataFrame,
    plan: DataFrame,
    rejects: DataFrame,
    targets: DataFrame,
) -> DataFrame:
    """Eight steps in two streams, with the change from the step before.

    Step 4 sets net units against item rows, so its row change is not zero.
    """
    nothing = F.lit(None).cast("double")
    count = F.count("*")
    steps = (
        (1, "Sales", "Source file", "order_items", raw_items, count, exact_sum("sale_price"), "Rows and gross value as delivered"),
        (2, "Sales", "stg", "stg.order_items", items, count, exact_sum("sale_price"), "Typing and renaming only"),
        (3, "Sales", "core", "core.fact_order_item", fact_items, count, exact_sum("gross_sales_value"), "Joins must not drop rows"),
        (4, "Sales", "mart", "mart.actual_country_month", actuals, F.sum("net_units"), exact_sum("gross_sales_value"),
         "Gross value must still tie by market and month"),
        (5, "Plan", "Source file", "plan_submissions", raw_plan, count, nothing, "Local currency, no USD value yet"),
        (6, "Plan", "stg", "stg.plan_submissions", plan, count, exact_sum("plan_net_sales_usd"), "Mapped and converted, all rows kept"),
        (7, "Plan", "qa", "qa.plan_rejects", rejects, count, nothing, "Rows sent back to the region"),
        (8, "Plan", "core", "core.fact_plan", targets, count, exact_sum("plan_net_sales_usd"), "Accepted rows only"),
    )
    lines = _union(
        [
            df.agg(rows.cast("bigint").alias("row_count"), F.max(F.lit(1)).alias("_"), value.cast("double").alias("value_usd"))
            .select(
                F.lit(i).alias("step_order"),
                F.lit(stream).alias("stream"),
                F.lit(stage).alias("stage"),
                F.lit(entity).alias("entity"),
                "row_count",
                "value_usd",
                F.lit(text).alias("expectation"),
            )
            for i, stream, stage, entity, df, rows, value, text in steps
        ]
    )
    w = Window.partitionBy("stream").orderBy("step_order")
    delta = lambda c: F.col(c) - F.lag(c).over(w)
    return lines.withColumns({"row_delta": delta("row_count"), "value_delta": delta("value_usd")}).select(
        "step_order", "stream", "stage", "entity", "row_count", "value_usd", "row_delta", "value_delta", "expectation"
    )


def assert_no_blocking_failures(gate: DataFrame, stage: str) -> None:
    """Raise if any check of the gate has status FAIL. One action per gate."""
    failed = gate.filter(F.col("status") == "FAIL").orderBy("check_name").collect()
    if failed:
        lines = [f"{r.check_name} [{r.severity}] {r.failure_count} rows: {r.notes}" for r in failed]
        raise GateFailure(f"{len(failed)} blocking check(s) failed at {stage}:\n  " + "\n  ".join(lines))


def gate_status(*gates: DataFrame) -> DataFrame:
    """Checks per status over several gates."""
    return _union([g.select("status") for g in gates]).groupBy("status").agg(F.count("*").alias("checks"))


def final_report(gates: dict[str, DataFrame], missing_files: Sequence[str] = ()) -> DataFrame:
    """One line per saved gate table with its blocking failures, plus missing files."""
    lines = _union(
        [
            g.agg(F.count_if(F.col("status") == "FAIL").alias("blocking")).select(
                F.lit(name).alias("subject"),
                F.col("blocking").alias("errors"),
                F.when(F.col("blocking") == 0, "PASS").otherwise("FAIL").alias("status"),
            )
            for name, g in gates.items()
        ]
    )
    if missing_files:
        rows = [(path, 1, "FAIL") for path in missing_files]
        lines = lines.unionByName(
            lines.sparkSession.createDataFrame(rows, "subject STRING, errors BIGINT, status STRING")
        )
    return lines
