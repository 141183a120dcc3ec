"""Staging, dimensions, facts and marts on small fixtures with known answers."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import acquisition, dimensions, facts, gates, planning, reporting, revenue, staging

T, D = dt.datetime, dt.date


def events(spark, rows):
    return spark.createDataFrame(
        rows,
        "event_id long, user_id long, sequence_number long, session_id string, created_at timestamp_ntz, city string, "
        "state string, postal_code string, browser string, traffic_source string, uri string, event_type string",
    )


def event(i, session, kind, user=None, seq=None, city=None):
    return (i, user, seq or i, session, T(2024, 1, 1, 0, 0, i), city, None, None, "b", "Email", "/", kind)


def test_sessions(spark):
    rows = [
        event(1, "s", "home"), event(2, "s", "product", user=7, city="Rome"), event(3, "s", "cart", user=7, city="Oslo"),
        event(4, "one", "purchase", user=9, city="Bonn"), event(5, None, "home"),
    ]
    got = {r.session_id: r for r in staging.reconstruct_sessions(events(spark, rows)).collect()}
    assert set(got) == {"s", "one"}
    s = got["s"]
    assert (s.user_id, s.event_count, s.events_with_user_id, s.city) == (7, 3, 2, "Rome")
    assert s.event_identity_coverage_rate == pytest.approx(2 / 3)
    assert (s.first_event_type, s.final_event_type, s.cart_flag, s.purchase_flag) == ("home", "cart", 1, 0)
    assert got["one"].first_event_type == got["one"].final_event_type == "purchase"


def test_hot_session_matches_brute_force(spark):
    rows = [event(i, "hot" if i % 3 == 0 else f"s{i}", "product" if i % 2 else "home", user=i % 5) for i in range(1, 60)]
    got = {r.session_id: r.event_count for r in staging.reconstruct_sessions(events(spark, rows)).collect()}
    want = {}
    for r in rows:
        want[r[3]] = want.get(r[3], 0) + 1
    assert got == want


def test_calendar(spark):
    bounds = spark.sql("SELECT DATE'2020-02-28' AS min_date, DATE'2021-01-05' AS max_date")
    days = {r.calendar_date: r for r in dimensions.dim_date(bounds).collect()}
    assert D(2020, 2, 29) in days and len(days) == 313
    assert (days[D(2020, 9, 30)].fiscal_year, days[D(2020, 9, 30)].fiscal_month_number) == (2020, 12)
    first = days[D(2020, 10, 1)]
    assert (first.fiscal_year, first.fiscal_month_number, first.fiscal_quarter_label) == (2021, 1, "FQ1")
    assert first.fiscal_year_start == D(2020, 10, 1) and first.fiscal_year_label == "FY2021"
    assert days[D(2021, 1, 1)].iso_week_number == 53 and days[D(2021, 1, 4)].iso_week_number == 1
    assert days[D(2020, 12, 31)].is_complete_month == 1 and days[D(2021, 1, 1)].is_complete_month == 0
    lifted = dimensions.dim_date(bounds, last_month_complete=True).filter("is_complete_month = 0").count()
    assert lifted == 0
    plain = dimensions.dim_date(bounds, fiscal_start=1).filter("calendar_date = DATE'2020-03-01'").first()
    assert (plain.fiscal_year, plain.fiscal_month_number, plain.fiscal_year_start) == (2020, 3, D(2020, 1, 1))


ITEM = ("order_item_id long, order_id long, user_id long, product_id long, inventory_item_id long, item_status string, "
        "created_at timestamp_ntz, shipped_at timestamp_ntz, delivered_at timestamp_ntz, returned_at timestamp_ntz, "
        "sale_price decimal(18,4)")


def small_star(spark, rows):
    items = spark.createDataFrame(
        [(i, o, 1, p, i, s, c, None, None, None, None if v is None else Decimal(str(v))) for i, (o, p, s, c, v) in enumerate(rows)], ITEM
    )
    products = spark.createDataFrame(
        [(1, "A", "d", "x", 5, Decimal("4")), (2, "B", "d", "y", 6, Decimal("3")), (3, "C", "d", "y", 6, Decimal("1"))],
        "product_id long, category string, department string, brand string, distribution_center_id int, unit_cost decimal(18,4)",
    )
    people = spark.createDataFrame([(1, "Web", "Spain", "25-34")], "user_id long, acquisition_source string, country string, age_band string")
    return facts.fact_order_item(items, products, people, ["category", "department"], ["country"]), products


def test_status_mix(spark):
    day = T(2024, 1, 1)
    rows = [(1, 1, s, day, 10) for s in ("Cancelled", "Returned", "Complete", "Shipped", "Processing")]
    rows += [(1, 1, "Complete", day, 0), (1, 1, "Complete", day, None)]
    fact, _ = small_star(spark, rows)
    got = [tuple(r) for r in fact.orderBy("order_item_id").select(
        "cancelled_value", "returned_value", "net_sales_value", "net_profit_value", "return_observation_eligible_flag").collect()]
    money = [tuple(None if v is None else float(v) for v in r) for r in got]
    assert money[0] == (10, 0, 0, 0, 0) and money[1] == (0, 10, 0, 0, 1)
    assert money[2] == (0, 0, 10, 6, 1) and money[3] == money[4] == (0, 0, 10, 6, 0)
    assert money[6][2] is None and fact.filter("order_item_id = 5").first().gross_margin_rate is None
    total = fact.filter("sale_price IS NOT NULL").agg(
        F.sum("gross_sales_value") - F.sum("net_sales_value") - F.sum("cancelled_value") - F.sum("returned_value")).first()[0]
    assert total == 0


def test_inventory_ages(spark):
    as_of = D(2024, 12, 31)
    ages = (30, 31, 60, 61, 90, 91, 180, 181)
    rows = [(i, 1, T.combine(as_of - dt.timedelta(days=a), dt.time()), None) for i, a in enumerate(ages)]
    rows += [(90, 1, T(2024, 5, 2), T(2024, 5, 1)), (91, 1, T(2024, 5, 2), T(2024, 5, 9))]
    df = spark.createDataFrame(rows, "inventory_item_id long, product_id long, created_at timestamp_ntz, sold_at timestamp_ntz").withColumns(
        {"distribution_center_id": F.lit(1), "unit_cost": F.lit(1), "retail_price": F.lit(2)})
    got = facts.fact_inventory(df, F.lit(as_of)).orderBy("inventory_item_id").collect()
    assert [r.inventory_age_bucket for r in got[:8]] == [
        "0-30 days", "31-60 days", "31-60 days", "61-90 days", "61-90 days", "91-180 days", "91-180 days", "181+ days"]
    assert (got[8].days_to_sell, got[9].days_to_sell, got[9].inventory_age_bucket) == (None, 7, "Sold")


COUNTRIES = ("source_country_value string, canonical_country string, region string, sub_region string")
PLAN = ("submission_batch string, submitted_country string, plan_month date, currency_code string, "
        "plan_net_sales_local double, plan_units long")


def plan_fixture(spark):
    countries = spark.createDataFrame(
        [("Spain", "Spain", "EMEA", "S"), ("España", "Spain", "EMEA", "S"), ("Japan", "Japan", "APAC", "N")], COUNTRIES)
    fx = spark.createDataFrame([("EUR", 1.08), ("JPY", 0.0067)], "currency_code string, budget_rate_to_usd double")
    m = D(2024, 1, 1)
    rows = [
        ("A", "Spain", m, "EUR", 100.0, 5), ("B", "España", m, " eur", 50.0, 2), ("A", "Spain ", D(2024, 3, 1), "EUR", 10.0, 1),
        ("A", "Atlantis", m, "EUR", 1.0, 1), ("A", "Japan", m, "XXX", 1.0, 1), ("A", "Japan", m, "JPY", None, 1),
        ("A", "Japan", D(2024, 2, 1), "JPY", -4.0, 1),
    ]
    raw = spark.createDataFrame(rows, PLAN)
    return raw, staging.stage_plan(raw, countries, fx)


def test_plan_defects(spark):
    raw, plan = plan_fixture(spark)
    assert plan.count() == raw.count()
    targets, rejects = facts.fact_plan(plan), facts.plan_rejects(plan)
    reasons = sorted(r.reject_reason for r in rejects.collect())
    assert reasons == ["Country not present in the country master", "No budget FX rate for the submitted currency",
                       "Plan value is blank", "Plan value is negative"]
    got = {(r.canonical_country, r.plan_month): r for r in targets.collect()}
    assert set(got) == {("Spain", D(2024, 1, 1)), ("Spain", D(2024, 3, 1))}
    merged = got[("Spain", D(2024, 1, 1))]
    assert (float(merged.plan_net_sales_local), float(merged.plan_net_sales_usd), merged.plan_units, merged.submission_batch) == (150.0, 162.0, 7, "B")
    assert [tuple(r) for r in gates.missing_plan_months(targets).collect()] == [("Spain", D(2024, 2, 1))]
    assert plan.filter("flag_whitespace_in_key = 1").count() == 1


def test_plan_status_ladder(spark):
    m = D(2024, 1, 1)
    a = [("only_actual", 5), ("full", 100), ("near", 96), ("below", 94), ("zero", 3)]
    p = [("only_plan", 5), ("full", 100), ("near", 100), ("below", 100), ("zero", 0)]
    actual = spark.createDataFrame([(c, "R", m, float(v), 1, 1) for c, v in a],
                                   "canonical_country string, region string, month_start date, net_sales_value double, net_units long, is_complete_month int")
    plan = spark.createDataFrame([(c, "R", m, float(v), 1) for c, v in p],
                                 "canonical_country string, region string, plan_month date, plan_net_sales_usd double, plan_units long")
    got = {r.canonical_country: r for r in planning.plan_vs_actual_monthly(actual, plan).collect()}
    assert {k: v.plan_status for k, v in got.items()} == {
        "only_actual": "Actual with no plan", "only_plan": "Plan with no actual yet", "full": "On or above plan",
        "near": "Within 5% of plan", "below": "Below plan", "zero": "On or above plan"}
    assert got["zero"].variance_rate is None and got["only_plan"].is_complete_month == 0


def bridge(spark, rows, **kw):
    fact, products = small_star(spark, rows)
    span = planning.Comparison("y", 1, D(2023, 1, 1), D(2023, 12, 31), D(2024, 1, 1), D(2024, 12, 31))
    return planning.price_volume_mix(fact, products, [span], **kw)


def residual(df):
    return df.agg(F.sum(F.col("volume_effect") + F.col("mix_effect") + F.col("price_effect") - F.col("total_variance"))).first()[0]


def test_bridge_ties_when_a_category_disappears(spark):
    rows = [(1, 1, "Complete", T(2023, 5, 1), 10), (2, 2, "Complete", T(2023, 5, 1), 20), (3, 1, "Shipped", T(2024, 5, 1), 12),
            (4, 1, "Shipped", T(2024, 6, 1), 14), (5, 1, "Cancelled", T(2024, 6, 1), 99)]
    df = bridge(spark, rows)
    assert abs(residual(df)) < 1e-9
    gone = df.filter("category = 'B'").first()
    assert (gone.units_current, gone.total_variance, gone.asp_current) == (0, -20.0, None)


def test_bridge_new_category_does_not_tie(spark):
    rows = [(1, 1, "Complete", T(2023, 5, 1), 10), (3, 1, "Shipped", T(2024, 5, 1), 12), (4, 3, "Shipped", T(2024, 5, 1), 7)]
    df = bridge(spark, rows)
    new = df.filter("category = 'C'").first()
    assert (new.volume_effect, new.mix_effect, new.price_effect, new.total_variance) == (0, 0, 0, 7.0)
    assert abs(residual(df)) == pytest.approx(7.0)
    assert new.asp_prior is None
    booked = bridge(spark, rows, new_entrant="mix").filter("category = 'C'").first()
    assert booked.mix_effect == 7.0


def test_bridge_overlapping_spans_count_once_as_prior(spark):
    fact, products = small_star(spark, [(1, 1, "Complete", T(2024, 1, 15), 10)])
    span = planning.Comparison("o", 1, D(2024, 1, 1), D(2024, 1, 31), D(2024, 1, 10), D(2024, 2, 28))
    r = planning.price_volume_mix(fact, products, [span]).first()
    assert (r.units_prior, r.units_current) == (1, 0)


def test_scorecard_rag(spark):
    rows = [("number", 100.0, 100.0), ("number", 96.0, 100.0), ("number", 94.0, 100.0), ("percent_inverse", 1.0, 1.0),
            ("percent_inverse", 1.04, 1.0), ("percent_inverse", 1.06, 1.0), ("number", 1.0, None)]
    df = spark.createDataFrame(rows, "k string, a double, p double")
    got = [r[0] for r in df.select(planning.rag_status(*[F.col(c) for c in "kap"])).collect()]
    assert got == ["Green", "Amber", "Red", "Green", "Amber", "Red", "No plan"]


def test_scorecard_without_prior_months(spark):
    cols = [c for _, _, _, c, _ in planning.SCORECARD]
    monthly = spark.createDataFrame([(D(2024, 3, 1), 1, *[1.0] * len(cols)), (D(2024, 4, 1), 0, *[9.0] * len(cols))],
                                    "month_start date, is_complete_month int, " + ", ".join(f"{c} double" for c in cols))
    plan = spark.createDataFrame([], "plan_month date, plan_net_sales_usd double, plan_units long")
    got = planning.commercial_scorecard(monthly, plan).collect()
    assert len(got) == 9 and {r.reporting_month for r in got} == {D(2024, 3, 1)}
    assert all(r.actual_value == 1.0 and r.prior_month_value is None and r.plan_rag_status == "No plan" for r in got)


def test_target_baseline(spark):
    rows = [("A", D(y, m, 1), 1000.0 * g, 10) for y, g in ((2021, 1.0), (2022, 3.0), (2023, 3.0)) for m in (1, 11)]
    actuals = spark.createDataFrame(rows, "canonical_country string, month_start date, net_sales_value double, net_units long")
    got = {r.plan_month: r for r in planning.plan_target_baseline(actuals).collect()}
    assert got[D(2022, 1, 1)].growth == 1.15                                   # no two years before
    assert got[D(2023, 1, 1)].growth == 2.2                                    # 3.0 held at the top
    assert got[D(2024, 1, 1)].growth == 1.0 and got[D(2024, 1, 1)].plan_net_sales_usd == 3000.0
    assert got[D(2024, 11, 1)].plan_net_sales_usd == 3200.0                    # 3150 to the even hundred


def test_retention_and_funnel_identities(warehouse):
    first = warehouse.cohort_retention.filter("months_since_first_order = 0").select("retention_rate").distinct().collect()
    assert [r[0] for r in first] == [1.0]
    rows = warehouse.funnel_stage_channel.collect()
    assert all(r.conversion_from_session_rate == 1.0 for r in rows if r.stage_order == 1)
    assert all(r.conversion_from_previous_stage_rate is None for r in rows if r.stage_order == 1)


def test_plan_rows_are_accepted_or_rejected(warehouse):
    plan = warehouse.stg_plan_submissions
    accepted = plan.count() - warehouse.plan_rejects.count()
    assert accepted >= warehouse.fact_plan.count() > 0


def test_gate_fails_and_raises(spark, warehouse):
    with pytest.raises(gates.GateFailure, match="order_items_primary_key_unique"):
        gates.assert_no_blocking_failures(warehouse.source_gate("order_items_primary_key_unique"), "source gate")
    gates.assert_no_blocking_failures(warehouse.source_gate("users_primary_key_unique"), "source gate")
    report = {r.subject: r.status for r in gates.final_report({"source": warehouse.source_gate("users_primary_key_unique")}, ["x.csv"]).collect()}
    assert report == {"source": "PASS", "x.csv": "FAIL"}


def test_mixed_session_fails_gate(spark):
    df = events(spark, [event(1, "s", "home", user=1), event(2, "s", "cart", user=2), event(3, "t", "home", user=1)])
    from ledgerline.operators.profiling import session_audit
    r = session_audit(df).first()
    assert (r.derived_sessions, r.sessions_with_multiple_users, r.sessions_with_multiple_browsers) == (2, 1, 0)


def test_funnel_pivot_with_and_without_a_channel_list(spark):
    funnel = spark.createDataFrame([(1, "Sessions", "Email", 5), (1, "Sessions", "Search", 7), (2, "Purchase", "Search", 2)],
                                   "stage_order int, stage string, traffic_source string, stage_sessions long")
    assert [r.asDict() for r in reporting.funnel_pivot(funnel).collect()] == [
        {"stage_order": 1, "stage": "Sessions", "Email": 5, "Search": 7}, {"stage_order": 2, "stage": "Purchase", "Email": 0, "Search": 2}]
    given = reporting.funnel_pivot(funnel, ["Search", "Display"]).collect()
    assert [r.asDict() for r in given] == [
        {"stage_order": 1, "stage": "Sessions", "Search": 7, "Display": 0}, {"stage_order": 2, "stage": "Purchase", "Search": 2, "Display": 0}]
