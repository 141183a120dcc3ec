"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.casting import UNKNOWN
from ..functions.measures import band, flag, ratio
from ..functions.times import (
    as_date,
    date_key,
    iso_weekday,
    month_key,
    month_start,
    quarter_start,
    year_start,
)

# Band edges and labels of the customer and product dimensions.
AGE_EDGES = (25, 35, 45, 55, 65)
AGE_LABELS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
PRICE_EDGES = (25, 50, 100, 200)
PRICE_LABELS = ("Under $25", "$25-$49", "$50-$99", "$100-$199", "$200+")
FISCAL_START = 10


def date_bounds(events: DataFrame, items: DataFrame, inventory: DataFrame) -> DataFrame:
    """First and last date over events, items and inventory; one pass per table."""
    created = F.col("created_at")
    spans = [
        events.agg(F.min(created).alias("lo"), F.max(created).alias("hi")),
        items.agg(F.min(created).alias("lo"), F.max(created).alias("hi")),
        inventory.agg(
            F.min(created).alias("lo"),
            F.max(F.coalesce(F.col("sold_at"), created)).alias("hi"),
        ),
    ]
    both = spans[0].unionByName(spans[1]).unionByName(spans[2])
    return both.agg(
        F.least(F.min("lo"), F.min("hi")).cast("date").alias("min_date"),
        F.greatest(F.max("lo"), F.max("hi")).cast("date").alias("max_date"),
    )


def dim_date(bounds: DataFrame, fiscal_start: int = FISCAL_START, last_month_complete: bool = False) -> DataFrame:
    """One row per day between the bounds.

    A month counts as complete only if it ends before the month of the last
    date; ``last_month_complete`` lifts that rule for the final month.
    """
    day = F.col("calendar_date")
    days = bounds.select(
        F.explode(F.sequence("min_date", "max_date", F.expr("interval 1 day"))).alias("calendar_date"),
        "max_date",
    )
    month, year = F.month(day), F.year(day)
    rolls_over = (month >= fiscal_start) & F.lit(fiscal_start > 1)
    fiscal_year = year + F.when(rolls_over, 1).otherwise(0)
    fiscal_month = F.pmod(month - F.lit(fiscal_start), F.lit(12)) + 1
    fiscal_quarter = F.floor((fiscal_month - 1) / 3).cast("int") + 1
    start_year = F.when(month >= fiscal_start, year).otherwise(year - 1)
    open_month = F.lit(False) if last_month_complete else (day >= F.trunc("max_date", "MM"))
    return days.select(
        date_key(day).alias("date_key"),
        day,
        year.alias("year"),
        F.quarter(day).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter_label"),
        month.alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM yyyy").alias("month_year"),
        month_start(day).alias("month_start"),
        quarter_start(day).alias("quarter_start"),
        year_start(day).alias("year_start"),
        F.weekofyear(day).alias("iso_week_number"),
        iso_weekday(day).alias("iso_day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        flag(iso_weekday(day) >= 6).alias("is_weekend"),
        flag(~open_month).alias("is_complete_month"),
        fiscal_year.alias("fiscal_year"),
        F.concat(F.lit("FY"), fiscal_year).alias("fiscal_year_label"),
        fiscal_month.alias("fiscal_month_number"),
        fiscal_quarter.alias("fiscal_quarter_number"),
        F.concat(F.lit("FQ"), fiscal_quarter).alias("fiscal_quarter_label"),
        F.make_date(start_year, F.lit(fiscal_start), F.lit(1)).alias("fiscal_year_start"),
    )


def dim_month(dates: DataFrame) -> DataFrame:
    return dates.select(
        "month_start",
        month_key(F.col("month_start")).alias("month_key"),
        "year",
        "month_number",
        "month_name",
        "month_year",
        "quarter_label",
        "fiscal_year",
        "fiscal_year_label",
        "fiscal_quarter_label",
        "fiscal_month_number",
        "is_complete_month",
    ).distinct()


def dim_customer(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        "age",
        band(F.col("age"), AGE_EDGES, AGE_LABELS, UNKNOWN).alias("age_band"),
        "gender",
        *[F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in ("country", "state", "city")],
        "postal_code",
        "latitude",
        "longitude",
        "acquisition_source",
        "registered_at",
        date_key(F.col("registered_at")).alias("registered_date_key"),
    )


def dim_product(products: DataFrame) -> DataFrame:
    """A NULL price takes the top band, as the ladder's last step has no test."""
    price, margin = F.col("retail_price"), F.col("retail_price") - F.col("unit_cost")
    return products.select(
        "product_id",
        "category",
        "product_name",
        "brand",
        "department",
        "sku",
        "distribution_center_id",
        "unit_cost",
        "retail_price",
        margin.alias("unit_margin"),
        F.when(price > 0, ratio(margin, price)).alias("unit_margin_rate"),
        band(price, PRICE_EDGES, PRICE_LABELS, None).alias("price_band"),
    )


def dim_distribution_center(centers: DataFrame) -> DataFrame:
    return centers.select("distribution_center_id", "distribution_center_name", "latitude", "longitude")


def _numbered(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Surrogate key by sort order.

    Only for dimension lists that are already reduced to one row per label
    (channels, spellings, markets): the global window sees that list alone.
    """
    position = F.row_number().over(Window.orderBy(*[F.asc_nulls_last(c) for c in order]))
    return df.select(position.cast("int").alias(key), *df.columns)


def dim_session_traffic_source(sessions: DataFrame) -> DataFrame:
    return _numbered(sessions.select("traffic_source").distinct(), "session_traffic_source_key", "traffic_source")


def dim_acquisition_source(users: DataFrame) -> DataFrame:
    return _numbered(users.select("acquisition_source").distinct(), "acquisition_source_key", "acquisition_source")


def dim_country(master: DataFrame) -> DataFrame:
    """Source spelling to market. Markets repeat; never join on the market here."""
    rows = master.select(
        "source_country_value",
        "canonical_country",
        "region",
        "sub_region",
        F.col("is_alias").cast("int").alias("is_alias"),
        "alias_reason",
    )
    return _numbered(rows, "country_key", "canonical_country", "source_country_value")


def dim_market(countries: DataFrame) -> DataFrame:
    rows = (
        countries.filter(F.col("canonical_country") != UNKNOWN)
        .groupBy("canonical_country", "region", "sub_region")
        .agg(F.count("*").alias("source_spellings_mapped"))
    )
    return _numbered(rows, "market_key", "canonical_country")
