"""Cleaning and typing of source columns.

Two policies: identifiers and timestamps must convert (a bad value fails the
job), descriptive numbers may not (a bad value becomes NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
RATE = T.DecimalType(18, 6)
UNKNOWN = "Unknown"


def blank_to_null(name: str) -> Column:
    """Trim spaces and turn an empty string into NULL."""
    return F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))


def or_unknown(name: str, default: str = UNKNOWN) -> Column:
    return F.coalesce(blank_to_null(name), F.lit(default))


def must(name: str, dtype: str) -> Column:
    return F.col(name).cast(dtype)


def maybe_int(df: DataFrame, name: str) -> Column:
    """Text such as ``'3.7'`` rounds half-even to an integer; junk becomes NULL."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).try_cast("int")
    return F.bround(F.col(name).try_cast("double")).try_cast("int")


def maybe_long(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(df.schema[name].dataType, T.StringType):
        # whole numbers keep all 19 digits; only fractional text goes through double
        text = F.trim(F.col(name))
        return F.coalesce(text.try_cast("bigint"), F.bround(text.try_cast("double")).try_cast("bigint"))
    return F.bround(F.col(name).try_cast("double")).try_cast("bigint")


def maybe_double(name: str) -> Column:
    return F.col(name).try_cast("double")


def maybe_money(df: DataFrame, name: str) -> Column:
    """Money is held as DECIMAL(18,4), so sums do not depend on row order."""
    if isinstance(df.schema[name].dataType, T.DecimalType):
        return F.col(name).cast(MONEY)
    return F.col(name).try_cast("double").try_cast(MONEY)


def plain(df: DataFrame) -> DataFrame:
    """Report shape: decimal columns leave as DOUBLE."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
