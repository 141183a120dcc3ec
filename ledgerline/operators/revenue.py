"""Revenue, product, customer and cohort marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import exact_sum, flag, flag_sum, money_sum, ratio
from ..functions.times import as_date, days_between, month_start, months_apart
from .facts import attach, latest_date
from .staging import country_lookup


def by_calendar(items: DataFrame, dates: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Calendar attributes by date key; rows outside the calendar drop out."""
    return attach(items, dates, "order_date_key", "date_key", columns)


def sales_monthly(items: DataFrame, dates: DataFrame) -> DataFrame:
    """Month totals.

    The two distinct counts shuffle on (month, order) and (month, customer), so
    a month with a large part of all rows is spread over many tasks.
    """
    totals = (
        by_calendar(items, dates, ["month_start", "year", "month_number", "is_complete_month"])
        .groupBy("month_start", "year", "month_number")
        .agg(
            F.max("is_complete_month").alias("is_complete_month"),
            F.countDistinct("order_id").alias("orders"),
            F.countDistinct("customer_id").alias("customers"),
            F.count("*").alias("items"),
            money_sum("gross_sales_value").alias("gross_sales_value"),
            money_sum("cancelled_value").alias("cancelled_value"),
            money_sum("returned_value").alias("returned_value"),
            money_sum("net_sales_value").alias("net_sales_value"),
            money_sum("net_profit_value").alias("net_profit_value"),
            flag_sum("cancelled_item_flag").alias("_cancelled"),
            flag_sum("returned_item_flag").alias("_returned"),
        )
    )
    return totals.withColumns(
        {
            "net_margin_rate": ratio("net_profit_value", "net_sales_value"),
            "average_order_value": ratio("net_sales_value", "orders"),
            "items_per_order": ratio("items", "orders"),
            "item_cancellation_rate": ratio("_cancelled", "items"),
            "item_return_rate": ratio("_returned", "items"),
        }
    ).drop("_cancelled", "_returned")


def product_performance(
    items: DataFrame, products: DataFrame, by: Sequence[str] = ("department", "category")
) -> DataFrame:
    """Return rate is over eligible items, cancellation rate over all items."""
    totals = (
        attach(items, products, "product_id", "product_id", by)
        .groupBy(*by)
        .agg(
            F.countDistinct("product_id").alias("products"),
            F.countDistinct("order_id").alias("orders"),
            F.countDistinct("customer_id").alias("customers"),
            F.count("*").alias("items"),
            money_sum("gross_sales_value").alias("gross_sales_value"),
            money_sum("net_sales_value").alias("net_sales_value"),
            money_sum("net_profit_value").alias("net_profit_value"),
            flag_sum("returned_item_flag").alias("returned_items"),
            flag_sum("return_observation_eligible_flag").alias("_eligible"),
            flag_sum("cancelled_item_flag").alias("_cancelled"),
        )
    )
    return totals.withColumns(
        {
            "net_margin_rate": ratio("net_profit_value", "net_sales_value"),
            "observed_return_rate": ratio("returned_items", "_eligible"),
            "cancellation_rate": ratio("_cancelled", "items"),
        }
    ).drop("_eligible", "_cancelled")


def product_performance_brand(items: DataFrame, products: DataFrame) -> DataFrame:
    totals = (
        attach(items, products, "product_id", "product_id", ["brand", "category"])
        .groupBy("brand")
        .agg(
            F.countDistinct("category").alias("categories"),
            F.countDistinct("product_id").alias("products"),
            F.countDistinct("order_id").alias("orders"),
            F.count("*").alias("items"),
            money_sum("net_sales_value").alias("net_sales_value"),
            money_sum("net_profit_value").alias("net_profit_value"),
            flag_sum("returned_item_flag").alias("_returned"),
            flag_sum("return_observation_eligible_flag").alias("_eligible"),
        )
    )
    return totals.withColumns(
        {
            "net_margin_rate": ratio("net_profit_value", "net_sales_value"),
            "observed_return_rate": ratio("_returned", "_eligible"),
        }
    ).drop("_returned", "_eligible")


def geography_performance(items: DataFrame, customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Conformed market totals, with the source spellings they came from.

    Items shrink to one row per order and customer first, and both distinct counts
    start from these rows. A customer has one spelling, so customers add up over
    spellings; orders are told apart per market.
    """
    market = ["canonical_country", "region", "sub_region"]
    spelled = attach(items, customers, "customer_id", "user_id", ["country"])
    sums = ["items", "net_sales_value", "net_profit_value", "_returned", "_eligible"]
    add_up = lambda names: [F.sum(c).alias(c) for c in names]
    bought = (
        attach(spelled, country_lookup(countries), "country", "source_country_value", market)
        .groupBy(*market, "country", "customer_id", "order_id")
        .agg(
            F.count("*").alias("items"),
            exact_sum("net_sales_value").alias("net_sales_value"),
            exact_sum("net_profit_value").alias("net_profit_value"),
            flag_sum("returned_item_flag").alias("_returned"),
            flag_sum("return_observation_eligible_flag").alias("_eligible"),
        )
    )
    spellings = (
        bought.groupBy(*market, "country", "customer_id")
        .agg(*add_up(sums))
        .groupBy(*market, "country")
        .agg(F.count("customer_id").alias("customers"), *add_up(sums))
    )
    orders = bought.select(*market, "order_id").distinct().groupBy(*market).agg(F.count("order_id").alias("orders"))
    totals = (
        spellings.unionByName(orders, allowMissingColumns=True)
        .groupBy(*market)
        .agg(
            *add_up(["orders", "customers", "items", "_returned", "_eligible"]),
            money_sum("net_sales_value").alias("net_sales_value"),
            money_sum("net_profit_value").alias("net_profit_value"),
            F.array_join(F.sort_array(F.collect_set("country")), " | ").alias("source_spellings"),
        )
    )
    return totals.select(
        F.col("canonical_country").alias("country"),
        "region",
        "sub_region",
        "orders",
        "customers",
        "items",
        "net_sales_value",
        "net_profit_value",
        ratio("net_sales_value", "orders").alias("average_order_value"),
        ratio("_returned", "_eligible").alias("observed_return_rate"),
        "source_spellings",
    )


def customer_360(items: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per purchasing customer.

    Items are reduced to one row per customer before the join, so the join is
    one-to-one and a hot customer cannot make it uneven.
    """
    created = F.col("order_item_created_at")
    spend = items.groupBy(F.col("customer_id").alias("user_id")).agg(
        F.min(created).cast("date").alias("first_order_date"),
        F.max(created).cast("date").alias("last_order_date"),
        F.countDistinct("order_id").alias("order_count"),
        F.count("*").alias("item_count"),
        *[exact_sum(c).alias(c) for c in ("gross_sales_value", "net_sales_value", "net_profit_value")],
        flag_sum("returned_item_flag").alias("returned_items"),
        flag_sum("cancelled_item_flag").alias("cancelled_items"),
        flag_sum("return_observation_eligible_flag").alias("_eligible"),
    )
    as_of = latest_date(items, "order_item_created_at")
    return (
        customers.join(spend, "user_id", "inner")
        .withColumn("_as_of", as_of)
        .select(
            F.col("user_id").alias("customer_id"),
            "age",
            "age_band",
            "gender",
            "country",
            "state",
            "city",
            "acquisition_source",
            "registered_at",
            "first_order_date",
            "last_order_date",
            month_start(F.col("first_order_date")).alias("first_order_cohort_month"),
            days_between(F.col("last_order_date"), F.col("_as_of")).alias("recency_days"),
            "order_count",
            "item_count",
            "gross_sales_value",
            "net_sales_value",
            "net_profit_value",
            ratio("net_sales_value", "order_count").alias("average_order_value"),
            "returned_items",
            "cancelled_items",
            ratio("returned_items", "_eligible").alias("observed_return_rate"),
            flag(F.col("order_count") >= 2).alias("repeat_customer_flag"),
        )
    )


def cohort_retention(items: DataFrame) -> DataFrame:
    """Active share of each first-purchase month, by months since.

    A customer's active months are collected as a set: at most one entry per
    calendar month, merged before the only shuffle on customers.
    """
    active = (
        items.filter(F.col("net_sales_value") > 0)
        .groupBy("customer_id")
        .agg(F.collect_set(month_start(F.col("order_item_created_at"))).alias("months"))
        .select(F.array_min("months").alias("cohort_month"), F.explode("months").alias("activity_month"))
    )
    counts = active.groupBy(
        "cohort_month", months_apart(F.col("cohort_month"), F.col("activity_month")).alias("months_since_first_order")
    ).agg(F.count("*").alias("active_customers"))
    sizes = counts.filter(F.col("months_since_first_order") == 0).select(
        "cohort_month", F.col("active_customers").alias("cohort_size")
    )
    return counts.join(sizes, "cohort_month").select(
        "cohort_month",
        "months_since_first_order",
        "cohort_size",
        "active_customers",
        ratio("active_customers", "cohort_size").alias("retention_rate"),
    )


def executive_snapshot(items: DataFrame, sessions: DataFrame, customers: DataFrame) -> DataFrame:
    """Twelve headline figures as text and number; one aggregate per source."""
    sales = items.agg(
        F.max("order_item_created_at").alias("latest"),
        money_sum("gross_sales_value").alias("gross"),
        money_sum("net_sales_value").alias("net"),
        money_sum("net_profit_value").alias("profit"),
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        ratio(flag_sum("returned_item_flag"), flag_sum("return_observation_eligible_flag")).alias("returns"),
        ratio(flag_sum("cancelled_item_flag"), F.count("*")).alias("cancels"),
    )
    visits = sessions.agg(
        F.count("*").alias("sessions"),
        ratio(flag_sum("purchase_flag"), F.count("*")).alias("conversion"),
        ratio(flag_sum("cart_abandoned_flag"), flag_sum("cart_flag")).alias("abandonment"),
    )
    loyal = customers.agg(ratio(flag_sum("repeat_customer_flag"), F.count("*")).alias("repeat"))

    def figure(name: str, text, number):
        return F.struct(
            F.lit(name).alias("metric_name"),
            text.alias("metric_value"),
            number.cast("double").alias("numeric_value"),
        )

    def money(name: str, c: str):
        return figure(name, F.concat(F.lit("$"), F.format_number(F.round(c, 2), 2)), F.col(c))

    def whole(name: str, c: str):
        return figure(name, F.format_number(c, 0), F.col(c))

    def share(name: str, c: str):
        return figure(name, F.concat(F.format_number(F.round(F.col(c) * 100, 2), 2), F.lit("%")), F.col(c))

    headline = [
        figure("Data as of", F.col("latest").cast("string"), F.lit(None)),
        money("Gross Sales", "gross"),
        money("Net Sales", "net"),
        money("Net Profit", "profit"),
        whole("Orders", "orders"),
        whole("Customers", "customers"),
    ]
    headline += [share("Observed Return Rate", "returns"), share("Item Cancellation Rate", "cancels")]
    funnel = [
        whole("Sessions", "sessions"),
        share("Session Conversion Rate", "conversion"),
        share("Cart Abandonment Rate", "abandonment"),
    ]
    return (
        sales.select(F.inline(F.array(*headline)))
        .unionByName(visits.select(F.inline(F.array(*funnel))))
        .unionByName(loyal.select(F.inline(F.array(share("Repeat Customer Rate", "repeat")))))
    )
