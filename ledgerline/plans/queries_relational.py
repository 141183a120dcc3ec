"""Queries for the generic relational operators, over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.casting import blank_to_null, maybe_int, or_unknown
from ..functions.measures import band, exact_sum, flag, flag_sum, money_sum, ratio
from ..functions.times import (
    date_key,
    days_between,
    iso_weekday,
    minutes_between,
    month_key,
    month_start,
    months_apart,
    quarter_start,
    seconds_between,
    year_start,
)
from ..operators import associations, ranking
from ..operators.segmentation import _pct_rank
from .oracle import ratio as q
from .registry import register

def n_rows():
    return F.count("*").alias("n")



def _add(key, build, sql, **kw):
    register(key, build, sql, **kw)


def _values(w):
    spark = w.raw["orders"].sparkSession
    groups = spark.sql("SELECT * FROM VALUES ('Complete', 'kept'), ('Shipped', 'kept'), ('Returned', 'lost'), ('Cancelled', 'lost') AS t(item_status, outcome)")
    return w.stg_order_items.join(F.broadcast(groups), "item_status").groupBy("outcome").agg(n_rows())


_add("A07_inline_values", _values,
     """SELECT outcome, COUNT(*) AS n FROM w_lines JOIN (VALUES ('Complete', 'kept'), ('Shipped', 'kept'), ('Returned', 'lost'), ('Cancelled', 'lost'))
          t(s, outcome) ON s = item_status GROUP BY 1""")


def _view(w):
    w.stg_order_items.createOrReplaceTempView("ledgerline_stg_order_items")
    return w.raw["orders"].sparkSession.sql(
        "SELECT item_status, count(*) AS n, count(delivered_at) AS delivered FROM ledgerline_stg_order_items GROUP BY item_status"
    )


_add("A08_view", _view, "SELECT item_status, COUNT(*) AS n, COUNT(delivered_at) AS delivered FROM w_lines GROUP BY 1")
_add("A09_date_series",
     lambda w: w.date_bounds.select(F.explode(F.sequence(month_start(F.col("min_date")), F.col("max_date"), F.expr("interval 1 month"))).alias("month_start")),
     "SELECT CAST(unnest(generate_series(date_trunc('month', min_date), max_date, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM w_bounds")
_add("A10_trim_blank_default",
     lambda w: w.raw["plan_submissions"].select(or_unknown("submitted_country").alias("country"), blank_to_null("currency_code").alias("code")).groupBy("country", "code").agg(n_rows()),
     "SELECT COALESCE(NULLIF(trim(submitted_country), ''), 'Unknown') AS country, NULLIF(trim(currency_code), '') AS code, COUNT(*) AS n FROM w_plan_raw GROUP BY 1, 2")
_add("A11_upper_lower",
     lambda w: w.raw["users"].groupBy(F.upper(F.trim("gender")).alias("gender"), F.lower("traffic_source").alias("source")).agg(n_rows()),
     "SELECT gender, lower(acquisition_source) AS source, COUNT(*) AS n FROM w_users GROUP BY 1, 2")
_add("A12_cast_try_cast",
     lambda w: w.raw["users"].select(maybe_int(w.raw["users"], "postal_code").alias("code"), F.col("first_name").try_cast("int").alias("bad")).groupBy("code").agg(n_rows(), F.count("bad").alias("bad")),
     "SELECT TRY_CAST(postal_code AS INTEGER) AS code, COUNT(*) AS n, 0::BIGINT AS bad FROM w_users GROUP BY 1")
_add("A13_case_ladder",
     lambda w: w.stg_order_items.groupBy(band(F.col("sale_price"), (1000, 10000, 50000), ("low", "middle", "high", "top"), "none").alias("price_class")).agg(n_rows()),
     "SELECT CASE WHEN sale_price IS NULL THEN 'none' WHEN sale_price < 1000 THEN 'low' WHEN sale_price < 10000 THEN 'middle' WHEN sale_price < 50000 THEN 'high' ELSE 'top' END AS price_class, COUNT(*) AS n FROM w_lines GROUP BY 1")
_add("A14_null_safe_ratio",
     lambda w: w.stg_order_items.groupBy("distribution_center_id").agg(ratio(F.count("returned_at"), F.count("delivered_at")).alias("rate")),
     f"SELECT distribution_center_id, {q('COUNT(returned_at)', 'COUNT(delivered_at)')} AS rate FROM w_lines GROUP BY 1")
_add("A15_predicates",
     lambda w: w.fact_order_item.filter(F.col("item_status").isin("Complete", "Shipped") & F.col("sale_price").between(1000, 20000) & (F.col("order_date_key") != 19970101))
     .join(w.dim_product.filter(F.col("brand").startswith("Brand#1")), "product_id").groupBy("item_status").agg(n_rows()),
     "SELECT item_status, COUNT(*) AS n FROM w_items WHERE item_status IN ('Complete', 'Shipped') AND sale_price BETWEEN 1000 AND 20000 AND order_date_key <> 19970101 AND brand LIKE 'Brand#1%' GROUP BY 1")
_add("A16_date_format",
     lambda w: w.stg_orders.groupBy(date_key(F.col("created_at")).alias("day_key"), month_key(F.col("created_at")).alias("month_key"),
                                    F.date_format("created_at", "MMMM").alias("month_name"), F.date_format("created_at", "MMM yyyy").alias("label"), F.date_format("created_at", "EEEE").alias("day_name")).agg(n_rows()),
     "SELECT CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS day_key, CAST(strftime(created_at, '%Y%m') AS INTEGER) AS month_key, strftime(created_at, '%B') AS month_name, strftime(created_at, '%b %Y') AS label, strftime(created_at, '%A') AS day_name, COUNT(*) AS n FROM w_orders GROUP BY ALL")
_add("A17_date_parts",
     lambda w: w.stg_orders.groupBy(F.year("created_at").alias("y"), F.quarter("created_at").alias("qr"), F.weekofyear("created_at").alias("wk"), iso_weekday(F.col("created_at")).alias("dow"),
                                    F.make_date(F.year("created_at"), F.month("created_at"), F.lit(1)).alias("first")).agg(n_rows()),
     "SELECT year(created_at)::INTEGER AS y, quarter(created_at)::INTEGER AS qr, weekofyear(created_at)::INTEGER AS wk, isodow(created_at)::INTEGER AS dow, make_date(year(created_at), month(created_at), 1) AS first, COUNT(*) AS n FROM w_orders GROUP BY ALL")
_add("A18_date_trunc",
     lambda w: w.stg_orders.groupBy(month_start(F.col("created_at")).alias("m"), quarter_start(F.col("created_at").cast("date")).alias("qs"), year_start(F.col("created_at").cast("date")).alias("ys")).agg(n_rows()),
     "SELECT CAST(date_trunc('month', created_at) AS DATE) AS m, CAST(date_trunc('quarter', created_at) AS DATE) AS qs, CAST(date_trunc('year', created_at) AS DATE) AS ys, COUNT(*) AS n FROM w_orders GROUP BY ALL")
_add("A19_boundary_differences",
     lambda w: w.stg_sessions.groupBy(minutes_between(F.col("session_start_at"), F.col("session_end_at")).alias("minutes")).agg(
         n_rows(), F.sum(seconds_between(F.col("session_start_at"), F.col("session_end_at"))).alias("seconds"),
         F.max(days_between(F.col("session_start_at"), F.col("session_end_at"))).alias("days"), F.max(months_apart(F.col("session_start_at"), F.col("session_end_at"))).alias("months")),
     "SELECT date_diff('minute', session_start_at, session_end_at) AS minutes, COUNT(*) AS n, CAST(SUM(date_diff('second', session_start_at, session_end_at)) AS BIGINT) AS seconds, MAX(date_diff('day', session_start_at, session_end_at)) AS days, MAX(date_diff('month', session_start_at, session_end_at)) AS months FROM w_sessions GROUP BY 1")
_add("A20_date_arithmetic",
     lambda w: w.stg_orders.groupBy(F.add_months(month_start(F.col("created_at")), -1).alias("month_before"), F.add_months(month_start(F.col("created_at")), -12).alias("year_before")).agg(n_rows()),
     "SELECT CAST(date_trunc('month', created_at) - INTERVAL 1 MONTH AS DATE) AS month_before, CAST(date_trunc('month', created_at) - INTERVAL 1 YEAR AS DATE) AS year_before, COUNT(*) AS n FROM w_orders GROUP BY 1, 2")
_add("A21_fiscal_arithmetic",
     lambda w: w.stg_orders.groupBy(((F.month("created_at") + 2) % 12 + 1).alias("fiscal_month"), F.concat(F.lit("FQ"), F.floor(((F.month("created_at") + 2) % 12) / 3).cast("int") + 1).alias("fiscal_quarter")).agg(n_rows()),
     "SELECT ((month(created_at) + 2) % 12 + 1)::INTEGER AS fiscal_month, 'FQ' || (((month(created_at) + 2) % 12) // 3 + 1) AS fiscal_quarter, COUNT(*) AS n FROM w_orders GROUP BY 1, 2")
_add("A22_scalar_math",
     lambda w: w.fact_order_item.groupBy("item_status").agg(
         F.min(F.abs("gross_margin_value")).alias("smallest"), F.max(F.round(F.col("sale_price"), 1)).alias("largest"), F.sum(F.floor("sale_price")).cast("bigint").alias("whole")),
     "SELECT item_status, MIN(abs(gross_margin_value))::DOUBLE AS smallest, MAX(round(sale_price, 1))::DOUBLE AS largest, CAST(SUM(floor(sale_price)) AS BIGINT) AS whole FROM w_items GROUP BY 1")
_add("A23_formatted_text",
     lambda w: w.fact_order_item.groupBy("item_status").agg(n_rows(), money_sum("sale_price").alias("v")).select(
         "item_status", F.format_string("%,d", "n").alias("n_text"), F.format_string("$%,.2f", F.round("v", 2)).alias("v_text")),
     "SELECT item_status, printf('%,d', COUNT(*)) AS n_text, printf('$%,.2f', round(SUM(sale_price)::DOUBLE, 2)) AS v_text FROM w_items GROUP BY 1")
_add("A24_clip_and_logs",
     lambda w: w.stg_order_items.groupBy("item_status").agg(
         F.avg(F.log1p(F.greatest(F.lit(0.0), F.least(F.lit(50000.0), F.col("sale_price").cast("double"))))).alias("mean_log"), F.exp(F.avg(F.log(F.greatest(F.lit(1.0), F.col("sale_price").cast("double"))))).alias("geo_mean")),
     "SELECT item_status, AVG(ln(1 + greatest(0, least(50000, sale_price::DOUBLE)))) AS mean_log, exp(AVG(ln(greatest(1, sale_price::DOUBLE)))) AS geo_mean FROM w_lines GROUP BY 1",
     rounded=["mean_log", "geo_mean"])

# --- joins -------------------------------------------------------------------

_add("A25_inner_join", lambda w: w.stg_order_items.drop("distribution_center_id").join(w.dim_product, "product_id").groupBy("price_band", "department").agg(n_rows()),
     "SELECT CASE WHEN retail_price < 200 THEN 'below' ELSE '$200+' END AS price_band, department, COUNT(*) AS n FROM w_lines JOIN w_products p ON p.product_id = w_lines.product_id GROUP BY 1, 2")
_add("A26_left_join",
     lambda w: w.stg_sessions.join(w.dim_customer.select("user_id", "country"), "user_id", "left").groupBy(F.coalesce("country", F.lit("Unknown")).alias("country")).agg(n_rows()),
     "SELECT COALESCE(country, 'Unknown') AS country, COUNT(*) AS n FROM w_sessions s LEFT JOIN w_users u ON u.user_id = s.user_id GROUP BY 1")
_add("A27_full_outer_join",
     lambda w: w.stg_orders.groupBy(month_start(F.col("created_at")).alias("m")).agg(F.count("*").alias("created")).join(
         w.stg_orders.filter(F.col("delivered_at").isNotNull()).groupBy(month_start(F.col("delivered_at")).alias("m")).agg(F.count("*").alias("delivered")), "m", "outer"),
     """SELECT COALESCE(a.m, b.m) AS m, created, delivered FROM (SELECT CAST(date_trunc('month', created_at) AS DATE) AS m, COUNT(*) AS created FROM w_orders GROUP BY 1) a
        FULL JOIN (SELECT CAST(date_trunc('month', delivered_at) AS DATE) AS m, COUNT(*) AS delivered FROM w_orders WHERE delivered_at IS NOT NULL GROUP BY 1) b ON a.m = b.m""")
_add("A28_anti_join", lambda w: w.stg_orders.join(w.stg_order_items, "order_id", "left_anti").groupBy("order_status").agg(n_rows()),
     "SELECT order_status, COUNT(*) AS n FROM w_orders o LEFT JOIN w_lines i ON i.order_id = o.order_id WHERE i.order_id IS NULL GROUP BY 1")
_add("A29_not_in_null_filtered",
     lambda w: w.stg_users.select("user_id").join(w.stg_events.select("user_id").filter(F.col("user_id").isNotNull()), "user_id", "left_anti").agg(F.count("*").alias("users_without_events")),
     "SELECT COUNT(*) AS users_without_events FROM w_users WHERE user_id NOT IN (SELECT user_id FROM w_events WHERE user_id IS NOT NULL)")
_add("A30_one_row_as_of",
     lambda w: w.stg_orders.withColumn("as_of", w.stg_orders.agg(F.max("created_at").cast("date")).scalar()).groupBy(F.floor(F.datediff("as_of", F.col("created_at").cast("date")) / 365).alias("years_ago")).agg(n_rows()),
     "SELECT date_diff('day', CAST(created_at AS DATE), (SELECT CAST(MAX(created_at) AS DATE) FROM w_orders)) // 365 AS years_ago, COUNT(*) AS n FROM w_orders GROUP BY 1")
_add("A31_range_join",
     lambda w: w.price_volume_mix.groupBy("comparison_label").agg(F.sum("units_prior").alias("prior"), F.sum("units_current").alias("current")),
     "SELECT label AS comparison_label, COUNT(*) FILTER (CAST(order_item_created_at AS DATE) BETWEEN p1 AND p2) AS prior, COUNT(*) FILTER (CAST(order_item_created_at AS DATE) BETWEEN c1 AND c2) AS current FROM w_items, w_spans WHERE net_unit = 1 GROUP BY 1")
_add("A32_self_join_pairs",
     lambda w: associations.basket_rules(w.wide_order_item, w.dim_product).filter(F.col("antecedent") < F.col("consequent")).select("antecedent", "consequent", "pair_orders"),
     "SELECT a.category AS antecedent, b.category AS consequent, COUNT(DISTINCT a.order_id) AS pair_orders FROM w_items a JOIN w_items b ON a.order_id = b.order_id AND a.category < b.category WHERE a.net_sales_value > 0 AND b.net_sales_value > 0 GROUP BY 1, 2 HAVING COUNT(DISTINCT a.order_id) >= 25")
_add("A33_join_using", lambda w: w.stg_orders.select("order_id", "gender").join(w.stg_order_items.select("order_id", "sale_price"), ["order_id"]).groupBy("gender").agg(money_sum("sale_price").alias("v")),
     "SELECT gender, SUM(sale_price)::DOUBLE AS v FROM w_orders JOIN w_lines USING (order_id) GROUP BY 1")
_add("A34_deduplicated_mapping",
     lambda w: w.stg_users.join(w.raw["country_master"].select("source_country_value", "canonical_country").distinct(), F.col("country") == F.col("source_country_value")).groupBy("canonical_country").agg(n_rows()),
     "SELECT canonical_country, COUNT(*) AS n FROM w_users JOIN (SELECT DISTINCT source_country_value, canonical_country FROM w_master) ON source_country_value = country GROUP BY 1")
_add("A35_lateral_generator",
     lambda w: w.stg_order_items.groupBy("distribution_center_id").agg(F.min(month_start(F.col("created_at"))).alias("lo"), F.max(month_start(F.col("created_at"))).alias("hi"))
     .select("distribution_center_id", F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("m")).groupBy("m").agg(F.count("*").alias("centers")),
     """SELECT CAST(m AS DATE) AS m, COUNT(*) AS centers FROM (SELECT distribution_center_id, MIN(date_trunc('month', created_at)) AS lo, MAX(date_trunc('month', created_at)) AS hi FROM w_lines GROUP BY 1),
          LATERAL (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m) GROUP BY 1""")

# --- aggregation -------------------------------------------------------------

_add("A36_group_by", lambda w: w.wide_order_item.groupBy("category", "department", "item_status").agg(n_rows()),
     "SELECT category, department, item_status, COUNT(*) AS n FROM w_items GROUP BY ALL")
_add("A37_basic_aggregates",
     lambda w: w.stg_order_items.groupBy("item_status").agg(n_rows(), F.count("delivered_at").alias("delivered"), money_sum("sale_price").alias("total"), ratio(exact_sum("sale_price"), F.count("sale_price")).alias("mean"),
                                                         F.min("sale_price").alias("lo"), F.max("sale_price").alias("hi")),
     f"SELECT item_status, COUNT(*) AS n, COUNT(delivered_at) AS delivered, SUM(sale_price)::DOUBLE AS total, {q('SUM(sale_price)', 'COUNT(sale_price)')} AS mean, MIN(sale_price)::DOUBLE AS lo, MAX(sale_price)::DOUBLE AS hi FROM w_lines GROUP BY 1")
_add("A38_count_distinct", lambda w: w.wide_order_item.groupBy("category").agg(*[F.countDistinct(c).alias(c) for c in ("order_id", "customer_id", "product_id")]),
     "SELECT category, COUNT(DISTINCT order_id) AS order_id, COUNT(DISTINCT customer_id) AS customer_id, COUNT(DISTINCT product_id) AS product_id FROM w_items GROUP BY 1")
_add("A39_count_distinct_tuple", lambda w: w.stg_order_items.agg(F.countDistinct(F.struct("order_id", "delivered_at")).alias("n")),
     "SELECT COUNT(DISTINCT (order_id, delivered_at)) AS n FROM w_lines")
_add("A40_conditional_aggregate", lambda w: w.fact_inventory.groupBy("distribution_center_id").agg(money_sum(F.when(F.col("sold_flag") == 0, F.col("unit_cost")).otherwise(0)).alias("unsold_cost"), flag_sum(flag(F.col("days_to_sell") > 30)).alias("slow")),
     "SELECT distribution_center_id, COALESCE(SUM(unit_cost) FILTER (sold_at IS NULL), 0)::DOUBLE AS unsold_cost, COUNT(*) FILTER (days_to_sell > 30) AS slow FROM w_units GROUP BY 1")
_add("A41_first_last_by_sequence", lambda w: w.stg_sessions.groupBy("first_event_type", "final_event_type").agg(n_rows(), F.count("city").alias("with_city")),
     "SELECT first_event_type, final_event_type, COUNT(*) AS n, COUNT(city) AS with_city FROM w_sessions GROUP BY 1, 2")
_add("A42_median_and_quantile", lambda w: ranking.percentiles(w.fact_order, ["order_status"], {"p50": ("end_to_end_lead_days", 0.5), "p90": ("end_to_end_lead_days", 0.9)}),
     """SELECT order_status, median(d) AS p50, quantile_cont(d, 0.9) AS p90 FROM (SELECT order_status, date_diff('minute', created_at, delivered_at) / 1440.0::DOUBLE AS d FROM w_orders WHERE delivered_at IS NOT NULL) GROUP BY 1""",
     rounded=["p50", "p90"])
_add("A43_having", lambda w: w.stg_order_items.groupBy("order_id").agg(n_rows()).filter(F.col("n") >= 8).groupBy("n").agg(F.count("*").alias("orders")),
     "SELECT n, COUNT(*) AS orders FROM (SELECT order_id, COUNT(*) AS n FROM w_lines GROUP BY 1 HAVING COUNT(*) >= 8) GROUP BY 1")
_add("A44_distinct_text_list", lambda w: w.wide_order_item.groupBy("category").agg(F.array_join(F.sort_array(F.collect_set("country")), " | ").alias("countries")),
     "SELECT category, string_agg(DISTINCT country, ' | ' ORDER BY country) AS countries FROM w_items GROUP BY 1")
_add("A45_scalar_subquery", lambda w: w.stg_orders.withColumn("lo", w.stg_orders.agg(F.min("created_at")).scalar()).filter(F.col("created_at") == F.col("lo")).agg(n_rows()),
     "SELECT COUNT(*) AS n FROM w_orders WHERE created_at = (SELECT MIN(created_at) FROM w_orders)")
_add("A46_named_aggregation", lambda w: w.customer_360.groupBy("acquisition_source").agg(F.countDistinct("customer_id").alias("customers"), F.median("recency_days").alias("median_recency"), F.avg("order_count").alias("mean_orders"), money_sum("net_sales_value").alias("net_sales")),
     "SELECT acquisition_source, COUNT(DISTINCT customer_id) AS customers, median(recency_days)::DOUBLE AS median_recency, AVG(order_count) AS mean_orders, SUM(net_sales_value)::DOUBLE AS net_sales FROM w_c360 GROUP BY 1",
     rounded=["mean_orders"])

# --- windows, sorts, sets ----------------------------------------------------

_add("A47_row_number", lambda w: w.wide_order_item.groupBy("brand").agg(n_rows()).withColumn("position", F.row_number().over(Window.orderBy(F.desc("n"), "brand"))),
     "SELECT brand, COUNT(*) AS n, row_number() OVER (ORDER BY COUNT(*) DESC, brand)::INTEGER AS position FROM w_items GROUP BY 1")
_add("A48_lag", lambda w: w.sales_monthly.select("month_start", (F.col("items") - F.lag("items").over(Window.partitionBy("month_number").orderBy("year"))).alias("change")),
     "SELECT month_start, items - LAG(items) OVER (PARTITION BY month_number ORDER BY year) AS change FROM w_sales")
_add("A49_first_value", lambda w: w.sales_monthly.select("month_start", F.first("items").over(Window.partitionBy("year").orderBy("month_number")).alias("first_items")),
     "SELECT month_start, FIRST_VALUE(items) OVER (PARTITION BY year ORDER BY month_number) AS first_items FROM w_sales")
_add("A50_min_over_partition", lambda w: w.cohort_retention.groupBy("cohort_month").agg(F.max("cohort_size").alias("customers")),
     "SELECT f AS cohort_month, COUNT(*) AS customers FROM (SELECT DISTINCT customer_id, MIN(month_start) OVER (PARTITION BY customer_id) AS f FROM w_items WHERE net_sales_value > 0) GROUP BY 1")
_add("A51_share_of_total", lambda w: w.stg_order_items.groupBy("item_status").agg(n_rows()).withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 4)),
     "SELECT item_status, COUNT(*) AS n, round(COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER (), 4) AS share FROM w_lines GROUP BY 1")
_add("A52_average_rank", lambda w: w.wide_order_item.groupBy("age_band", "department").agg(F.countDistinct("country").alias("countries")).withColumn("rank_pct", _pct_rank("countries")),
     "SELECT age_band, department, n AS countries, (rank() OVER (ORDER BY n) + (COUNT(*) OVER (PARTITION BY n) - 1) / 2.0::DOUBLE) / COUNT(*) OVER () AS rank_pct FROM (SELECT age_band, department, COUNT(DISTINCT country) AS n FROM w_items GROUP BY 1, 2)")


def _terciles(w):
    spend = w.customer_360.select(F.col("net_sales_value").cast("double").alias("v"))
    edges = ranking.percentile_edges(spend, "v", 3, ranking.MONEY_CELLS)
    return spend.withColumn("_e", edges).groupBy(ranking.bucket_of(F.col("v"), F.col("_e")).alias("tercile")).agg(n_rows(), F.min("v").alias("lo"), F.max("v").alias("hi"))


_add("A53_quantile_buckets", _terciles,
     "SELECT 1 + (v > e[1])::INTEGER + (v > e[2])::INTEGER AS tercile, COUNT(*) AS n, MIN(v) AS lo, MAX(v) AS hi FROM (SELECT net_sales_value::DOUBLE AS v FROM w_c360), (SELECT quantile_cont(net_sales_value::DOUBLE, [1/3, 2/3]) AS e FROM w_c360) GROUP BY 1")
_add("A54_top_n", lambda w: w.customer_360.select("customer_id", "net_sales_value").orderBy(F.desc("net_sales_value"), "customer_id").limit(25),
     "SELECT customer_id, net_sales_value::DOUBLE AS net_sales_value FROM w_c360 ORDER BY net_sales_value DESC, customer_id LIMIT 25")
_add("A55_union_all", lambda w: w.stg_orders.select(F.col("order_status").alias("status")).unionByName(w.stg_order_items.select(F.col("item_status").alias("status"))).groupBy("status").agg(n_rows()),
     "SELECT status, COUNT(*) AS n FROM (SELECT order_status AS status FROM w_orders UNION ALL SELECT item_status FROM w_lines) GROUP BY 1")
_add("A56_distinct", lambda w: w.wide_order_item.select("department", "category", "country").distinct(), "SELECT DISTINCT department, category, country FROM w_items")
_add("A57_pivot", lambda w: w.wide_order_item.groupBy("category").pivot("item_status", ["Cancelled", "Complete", "Returned", "Shipped"]).agg(F.count("order_id")).na.fill(0),
     "SELECT category, COUNT(*) FILTER (item_status = 'Cancelled') AS Cancelled, COUNT(*) FILTER (item_status = 'Complete') AS Complete, COUNT(*) FILTER (item_status = 'Returned') AS Returned, COUNT(*) FILTER (item_status = 'Shipped') AS Shipped FROM w_items GROUP BY 1")
_add("A58_unpivot", lambda w: w.sales_monthly.unpivot(["month_start"], ["gross_sales_value", "net_sales_value", "net_profit_value"], "measure", "value"),
     "SELECT month_start, unnest(['gross_sales_value', 'net_sales_value', 'net_profit_value']) AS measure, unnest([gross_sales_value, net_sales_value, net_profit_value]) AS value FROM w_sales")


def _ctes(w):
    spend = w.customer_360.select("customer_id", "country", "net_sales_value")
    best = spend.groupBy("country").agg(F.max("net_sales_value").alias("net_sales_value"))
    return spend.join(best, ["country", "net_sales_value"], "left_semi").groupBy("country").agg(F.min("customer_id").alias("customer_id"))


_add("A59_chained_subqueries", _ctes,
     "SELECT country, MIN(customer_id) AS customer_id FROM w_c360 c WHERE (country, net_sales_value) IN (SELECT country, MAX(net_sales_value) FROM w_c360 GROUP BY country) GROUP BY 1")
