"""Concentration of a value over its owners: Gini, Lorenz curve, top shares.

All three need the rank of every owner. Equal values are merged into counts and
the ranks come from running totals over cells, so no task sees all owners.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casting import MONEY
from ..functions.measures import exact_sum, ratio
from .ranking import MONEY_CELLS, running_totals


def customer_spend(items: DataFrame, positive_only: bool = False) -> DataFrame:
    """Net spend per ordering customer; negative totals are left out."""
    spend = items.groupBy("customer_id").agg(exact_sum("net_sales_value").cast(MONEY).alias("net_spend"))
    return spend.filter(F.col("net_spend") > 0 if positive_only else F.col("net_spend") >= 0)


def _ranked(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("v"))
        .agg(F.count("*").alias("c"))
        .withColumn("r", F.col("v") * F.col("c"))
    )
    return running_totals(counts, by, "v", ["c", "r"], MONEY_CELLS)


def gini(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Population Gini over all rows or per group."""
    c, b = F.col("c").cast("double"), F.col("c_before").cast("double")
    ranks = c * b + c * (c + 1) / 2
    sums = _ranked(df, value, by).groupBy(*by).agg(
        F.sum("c").alias("owners"),
        F.sum("r").cast("double").alias("total"),
        F.sum(F.col("v").cast("double") * ranks).alias("weighted"),
    )
    n = F.col("owners")
    return sums.select(
        *by, "owners", ratio(2 * F.col("weighted") - (n + 1) * F.col("total"), n * F.col("total")).alias("gini")
    )


def lorenz(df: DataFrame, value: str, points: int = 100) -> DataFrame:
    """Share of the total held by the lowest k/points of owners, k = 1..points."""
    ranked = _ranked(df, value)
    totals = df.filter(F.col(value).isNotNull()).agg(
        F.struct(F.count("*").alias("n"), F.sum(value).alias("total"))
    ).scalar()
    # the number of owners at point k is floor(n * k / points); a value covers
    # the points whose number falls into its own run of ranks
    first = F.ceil((F.col("c_before") + 1) * points / F.col("_t.n"))
    last = F.least(F.ceil((F.col("c_before") + F.col("c") + 1) * points / F.col("_t.n")) - 1, F.lit(points))
    covered = F.when(first <= last, F.sequence(first, last))
    owners = F.floor(F.col("_t.n") * F.col("point") / points)
    held = F.col("r_before") + F.col("v") * (owners - F.col("c_before"))
    return (
        ranked.withColumn("_t", totals)
        .withColumn("point", F.explode(covered))
        .select(
            F.col("point").cast("int").alias("point"),
            owners.alias("owners"),
            ratio(owners, F.col("_t.n")).alias("owner_share"),
            ratio(held, F.col("_t.total")).alias("value_share"),
        )
    )


def top_share(df: DataFrame, value: str, shares: Sequence[float] = (0.1, 0.2)) -> DataFrame:
    """Part of the total that the top share of owners holds."""
    n = df.filter(F.col(value).isNotNull()).agg(F.count("*")).scalar()
    ranked = _ranked(df, value).withColumn("_n", n)
    sums = [F.sum("r").alias("total")]
    for i, p in enumerate(shares):
        cut = F.floor(F.col("_n") * F.lit(1 - p))
        kept = F.greatest(F.lit(0), F.col("c") - F.greatest(F.lit(0), cut - F.col("c_before")))
        sums.append(F.sum(F.col("v") * kept).alias(f"top{i}"))
    lines = [
        F.struct(F.lit(float(p)).alias("top_share"), ratio(f"top{i}", "total").alias("value_share"))
        for i, p in enumerate(shares)
    ]
    return ranked.agg(*sums).select(F.inline(F.array(*lines)))
