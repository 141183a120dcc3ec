"""Columns of the source files, in file order.

Files are read as text and typed by the staging operators, so an identifier that
does not convert fails the job instead of turning into NULL on the way in.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The source contract.
COLUMNS = {
    "users": "id first_name last_name email age gender state street_address postal_code city country latitude longitude "
    "traffic_source created_at",
    "products": "id cost category name brand retail_price department sku distribution_center_id",
    "orders": "order_id user_id status gender created_at returned_at shipped_at delivered_at num_of_item",
    "order_items": "id order_id user_id product_id inventory_item_id status created_at shipped_at delivered_at returned_at "
    "sale_price",
    "events": "id user_id sequence_number session_id created_at ip_address city state postal_code browser traffic_source "
    "uri event_type",
    "inventory_events": "id product_id created_at sold_at cost product_category product_name product_brand "
    "product_retail_price product_department product_sku product_distribution_center_id",
    "distribution_centers": "id name latitude longitude",
    "country_master": "source_country_value canonical_country region sub_region is_alias alias_reason",
    "fx_budget_rates": "currency_code currency_name budget_rate_to_usd rate_basis",
    "plan_submissions": "submission_batch submitted_country plan_month currency_code plan_net_sales_local plan_units",
}


def schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS[table].split()])
