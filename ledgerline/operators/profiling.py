"""Table profiling: columns, values, grain, overlaps and plan defects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.measures import money_sum, ratio
from .facts import attach
from .gates import missing_plan_months

UNIQUE, REPEATED = "unique at this grain", "NOT unique - a join on these keys will multiply rows"
TIES, OPEN = "ties", "DOES NOT TIE"


def _identity(field: T.StructField) -> Column:
    """Text that is equal exactly where two values of the column are."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")  # local times repeat when clocks go back
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0.0).cast(kind)).cast("string")  # no negative zero
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c)))
    return c.cast("string")


def _exact_stats(df: DataFrame) -> DataFrame:
    """One row of totals: rows are reduced to counts per column and value, and those are counted.

    The last step has no key, so that texts are compared without a sort.
    """
    fields = list(enumerate(df.schema.fields))
    plain = (T.StringType, T.FloatType, T.DoubleType, T.IntegralType, T.DecimalType, T.DateType, T.BooleanType)
    cells = [
        F.struct(
            F.lit(i).alias("i"),
            _identity(f).alias("k"),
            (F.lit(None) if isinstance(f.dataType, plain) else F.col(f"`{f.name}`")).cast("string").alias("e"),
        )
        for i, f in fields
    ]
    found = df.select(F.inline(F.array(*cells))).groupBy("i", "k", "e").agg(F.count("*").alias("n"))
    known = F.col("k").isNotNull()

    def of(i: int, value: Column) -> Column:
        return F.when((F.col("i") == i) & known, value)

    return found.agg(
        F.coalesce(F.sum(F.when(F.col("i") == 0, F.col("n"))), F.lit(0)).alias("_rows"),
        *[
            x
            for i, _ in fields
            for x in (
                F.coalesce(F.sum(of(i, F.col("n"))), F.lit(0)).alias(f"_n{i}"),
                F.count(of(i, F.lit(1))).alias(f"_d{i}"),
                F.min(of(i, F.coalesce("e", "k"))).alias(f"_e{i}"),
            )
        ],
    )


def _sketched_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("_rows"),
        *[
            x
            for i, c in enumerate(df.columns)
            for x in (
                F.count(f"`{c}`").alias(f"_n{i}"),
                F.approx_count_distinct(f"`{c}`").alias(f"_d{i}"),
                F.min(F.col(f"`{c}`").cast("string")).alias(f"_e{i}"),
            )
        ],
    )


def columns(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, NULLs, distinct values and smallest text of every column, from one scan.

    ``approx`` takes the distinct counts from sketches, and nothing is shuffled
    but one row per task.
    """
    stats = _sketched_stats(df) if approx else _exact_stats(df)
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("nulls"),
            F.round(F.coalesce(ratio(F.col("_rows") - F.col(f"_n{i}"), F.col("_rows")), F.lit(0.0)), 4).alias("null_pct"),
            F.col(f"_d{i}").alias("distinct"),
            F.col(f"_e{i}").alias("example"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return stats.select(F.inline(F.array(*lines)))


def values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Most frequent values with their share of all rows; ties in value order."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    total = df.agg(F.count("*")).scalar()
    return (
        counts.withColumn("_total", total)
        .orderBy(F.desc("rows"), F.asc_nulls_last("value"))
        .limit(n)
        .select("value", "rows", F.round(ratio("rows", "_total"), 4).alias("share"))
    )


def grain(df: DataFrame, *keys: str, name: str = "") -> DataFrame:
    """Are the keys unique? Key groups with NULLs count as values."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    totals = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_keys"))
    extra = F.col("rows") - F.col("distinct_keys")
    return totals.select(
        F.lit(name).alias("table"),
        F.lit(", ".join(keys)).alias("keys"),
        "rows",
        "distinct_keys",
        extra.alias("duplicates"),
        F.when(extra == 0, UNIQUE).otherwise(REPEATED).alias("verdict"),
    )


def duplicates(df: DataFrame, *keys: str, n: int = 20) -> DataFrame:
    """The most repeated keys; ties in key order."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
        .orderBy(F.desc("rows"), *[F.asc_nulls_last(k) for k in keys])
        .limit(n)
    )


def _sides(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Distinct non-NULL keys with two flags, from one shuffle of both tables."""
    one, zero = F.lit(1), F.lit(0)
    both = left.select(F.col(left_key).alias("k"), one.alias("in_left"), zero.alias("in_right")).unionByName(
        right.select(F.col(right_key).alias("k"), zero.alias("in_left"), one.alias("in_right"))
    )
    return (
        both.filter(F.col("k").isNotNull())
        .groupBy("k")
        .agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"))
    )


def overlap(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """How far two key columns match, both ways."""
    l, r = F.col("in_left") == 1, F.col("in_right") == 1
    return _sides(left, left_key, right, right_key).agg(
        F.count_if(l).alias("left_distinct"),
        F.count_if(r).alias("right_distinct"),
        F.count_if(l & r).alias("matched"),
        F.count_if(l & ~r).alias("left_only"),
        F.count_if(r & ~l).alias("right_only"),
    )


def unmatched(left: DataFrame, left_key: str, right: DataFrame, right_key: str, n: int = 10) -> DataFrame:
    """The first ``n`` keys of the left table that the right one lacks."""
    keys = left.select(F.col(left_key).alias("unmatched")).filter(F.col("unmatched").isNotNull()).distinct()
    known = right.select(F.col(right_key).alias("unmatched")).filter(F.col("unmatched").isNotNull())
    return keys.join(known, "unmatched", "left_anti").orderBy("unmatched").limit(n)


def tie(label: str, left: DataFrame, right: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Two one-row, one-column totals and whether they agree."""
    l, r = left.columns[0], right.columns[0]
    pair = left.agg(F.coalesce(F.max(F.col(l)).cast("double"), F.lit(0.0)).alias("l")).withColumn(
        "r", F.coalesce(right.agg(F.max(F.col(r)).cast("double")).scalar(), F.lit(0.0))
    )
    delta = F.col("r") - F.col("l")
    return pair.select(
        F.lit(label).alias("check"),
        F.round("l", 2).alias("left"),
        F.round("r", 2).alias("right"),
        F.round(delta, 2).alias("delta"),
        F.when(F.abs(delta) < tolerance, TIES).otherwise(OPEN).alias("verdict"),
    )


def session_audit(events: DataFrame) -> DataFrame:
    """Sessions with invalid ids or more than one user, browser or source.

    More than one distinct value is the same as smallest and largest differing,
    which needs no distinct count.
    """
    mixed = lambda c: F.coalesce(F.min(c) != F.max(c), F.lit(False))
    per_session = events.groupBy("session_id").agg(
        mixed("user_id").alias("users"), mixed("browser").alias("browsers"), mixed("traffic_source").alias("sources")
    )
    return per_session.agg(
        F.count("*").alias("derived_sessions"),
        F.count_if(F.col("session_id").isNull() | (F.col("session_id") == "")).alias("invalid_session_ids"),
        F.count_if("users").alias("sessions_with_multiple_users"),
        F.count_if("browsers").alias("sessions_with_multiple_browsers"),
        F.count_if("sources").alias("sessions_with_multiple_sources"),
    )


def identity_coverage(sessions: DataFrame) -> DataFrame:
    return sessions.agg(
        F.count("*").alias("sessions"),
        F.sum("identified_session_flag").alias("identified_sessions"),
        F.avg("event_identity_coverage_rate").alias("average_session_event_identity_coverage"),
        F.sum("product_view_flag").alias("product_sessions"),
        F.sum("cart_flag").alias("cart_sessions"),
        F.sum("purchase_flag").alias("purchase_sessions"),
    )


def alias_leakage(items: DataFrame, customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Value that alias spellings would take away from their market."""
    aliases = (
        countries.filter(F.col("is_alias") == 1).select("source_country_value", "canonical_country").distinct()
    )
    spelled = attach(items, customers, "customer_id", "user_id", ["country"])
    return (
        attach(spelled, aliases, "country", "source_country_value", ["canonical_country"])
        .groupBy(F.col("country").alias("source_spelling"), "canonical_country")
        .agg(F.count("*").alias("items"), money_sum("net_sales_value").alias("net_sales_usd"))
        .withColumn("net_sales_usd", F.round("net_sales_usd", 2))
    )


def plan_gaps(targets: DataFrame) -> DataFrame:
    return missing_plan_months(targets).groupBy("canonical_country").agg(F.count("*").alias("missing_months"))


def plan_defects(raw_plan: DataFrame, master: DataFrame) -> DataFrame:
    """Raw plan rows with a defect and the first label that fits."""
    names = master.select(F.col("canonical_country").alias("submitted_country")).distinct().withColumn("_known", F.lit(1))
    amount, country = F.col("plan_net_sales_local"), F.col("submitted_country")
    padded = country != F.trim("submitted_country")
    label = (
        F.when(amount.isNull(), "blank target")
        .when(amount < 0, "negative target")
        .when(padded, "trailing whitespace")
        .when(country.isNotNull() & F.col("_known").isNull(), "non-English country name")
    )
    return (
        raw_plan.join(names, "submitted_country", "left")
        .select("submission_batch", "submitted_country", "plan_month", "currency_code", "plan_net_sales_local", label.alias("defect"))
        .filter(F.col("defect").isNotNull())
    )


def status_mix(items: DataFrame) -> DataFrame:
    return items.groupBy("item_status").agg(
        F.count("*").alias("line_items"), F.round(money_sum("gross_sales_value"), 0).alias("gross_value")
    )


def rejects_by_reason(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(
        F.count("*").alias("rows_quarantined"),
        F.array_join(F.sort_array(F.collect_set("submitted_country")), ", ").alias("markets"),
    )
