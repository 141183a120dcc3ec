"""Power planning and classical tests."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.measures import flag_sum, ratio
from .facts import attach
from .ranking import DAY_CELLS, running_totals


def experiment_power_plan(
    sessions: DataFrame,
    alpha: float = 0.05,
    powers: Sequence[float] = (0.80, 0.90),
    effects: Sequence[float] = (0.01, 0.02, 0.03),
) -> DataFrame:
    """Sample size per variant to see an absolute rise in the cart-to-purchase rate."""
    z = NormalDist().inv_cdf
    cart = F.col("cart_flag") == 1
    base = sessions.agg(
        ratio(F.sum(F.when(cart, F.col("purchase_flag")).otherwise(0)), flag_sum("cart_flag")).alias("p1")
    )
    grid = [
        F.struct(
            F.lit(float(e)).alias("absolute_mde"),
            F.lit(float(p)).alias("power"),
            F.lit(z(1 - alpha / 2)).alias("za"),
            F.lit(z(p)).alias("zb"),
        )
        for p in powers
        for e in effects
    ]
    p1, mde = F.col("p1"), F.col("absolute_mde")
    p2 = F.least(F.lit(0.999), p1 + mde)
    mean = (p1 + p2) / 2
    width = F.col("za") * F.sqrt(2 * mean * (1 - mean)) + F.col("zb") * F.sqrt(p1 * (1 - p1) + p2 * (1 - p2))
    size = F.ceil(width * width / (mde * mde))
    return base.select("p1", F.inline(F.array(*grid))).select(
        p1.alias("baseline_cart_to_purchase_rate"),
        "absolute_mde",
        ratio(mde, p1).alias("relative_mde"),
        F.lit(alpha).alias("alpha"),
        "power",
        size.alias("sample_per_variant"),
        (size * 2).alias("total_sample"),
    )


# Steps of the two expansions of the error function: enough for 15 digits on their sides of ERFC_CUT.
ERFC_STEPS, ERFC_CUT = 80, 3.0


def erfc_root(h: Column) -> Column:
    """erfc(sqrt(h)) for h > 0: a series of positive terms near zero, a continued fraction beyond."""
    down = F.sequence(F.lit(ERFC_STEPS), F.lit(1))
    series = F.aggregate(down, F.lit(1.0), lambda acc, n: 1 + acc * h * 2 / (n * 2 + 1))
    fraction = F.aggregate(down, F.lit(0.0), lambda acc, n: n / (h * 2) / (acc + 1))
    near = 1 - 2 * F.sqrt(h / math.pi) * F.exp(-h) * series
    return F.when(h < ERFC_CUT, near).otherwise(F.exp(-h) / F.sqrt(h * math.pi) / (fraction + 1))


def chi2_tail(x: Column, dof: Column) -> Column:
    """P(chi-square > x) from the finite sums for even and odd degrees of freedom; NaN without both.

    Terms are carried as logarithms, so that large values do not run out of range.
    """
    half = x.cast("double") / 2
    odd = dof % 2 == 1
    start = F.when(odd, 0.5).otherwise(0.0)
    first = -half + F.when(odd, F.log(half) / 2 - math.lgamma(1.5)).otherwise(0.0)
    terms = F.filter(F.sequence(F.lit(0), F.floor(dof / 2).cast("int")), lambda k: k < F.floor(dof / 2))
    total = F.aggregate(
        terms,
        F.struct(F.lit(0.0).alias("sum"), first.alias("log")),
        lambda acc, k: F.struct(
            (acc["sum"] + F.exp(acc["log"])).alias("sum"), (acc["log"] + F.log(half / (start + k + 1))).alias("log")
        ),
        lambda acc: acc["sum"],
    )
    known = x.isNotNull() & ~F.isnan(x.cast("double")) & (dof >= 1)
    tail = F.least(F.lit(1.0), total + F.when(odd, erfc_root(half)).otherwise(0.0))
    return F.when(F.coalesce(known, F.lit(False)), F.when(half <= 0, 1.0).otherwise(tail)).otherwise(F.lit(float("nan")))


def chi_square_independence(df: DataFrame, rows: str, cols: str) -> DataFrame:
    """Chi-square, p and Cramer's V of two columns; cells never seen count as 0.

    Works on the contingency counts only. The correction for continuity applies
    to a 2 x 2 table.
    """
    cells = df.groupBy(rows, cols).agg(F.count("*").cast("double").alias("o"))
    margins = cells.withColumns(
        {
            "r": F.sum("o").over(Window.partitionBy(rows)),
            "c": F.sum("o").over(Window.partitionBy(cols)),
        }
    )
    shape = cells.agg(
        F.struct(
            F.sum("o").alias("n"), F.countDistinct(rows).alias("rows"), F.countDistinct(cols).alias("cols"),
            F.count("*").alias("seen"),
        )
    ).scalar()
    expected = F.col("r") * F.col("c") / F.col("_s.n")
    dof = (F.col("_s.rows") - 1) * (F.col("_s.cols") - 1)
    gap = F.abs(F.col("o") - expected)
    gap = F.when(dof == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
    full = F.col("seen") == F.col("rows") * F.col("cols")
    n = F.col("n")
    return (
        margins.withColumn("_s", shape)
        .select("_s.*", dof.alias("dof"), expected.alias("e"), (gap * gap / expected).alias("x"))
        .groupBy("n", "rows", "cols", "seen", "dof")
        .agg(F.sum("x").alias("x"), F.sum("e").alias("e"))
        .withColumn("chi_square", F.col("x") + F.when(full, 0.0).otherwise(n - F.col("e")))
        .select(
            "chi_square",
            F.col("dof").cast("int").alias("dof"),
            chi2_tail(F.col("chi_square"), F.col("dof").cast("int")).alias("p_value"),
            F.sqrt(F.col("chi_square") / (n * (F.least("rows", "cols") - 1))).alias("cramers_v"),
        )
    )


def returns_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    eligible = attach(
        items.filter(F.col("return_observation_eligible_flag") == 1), products, "product_id", "product_id", ["category"]
    )
    return chi_square_independence(eligible, "category", "returned_item_flag")


def kruskal_wallis(df: DataFrame, group: str, value: str, min_group: int = 30, cells=DAY_CELLS) -> DataFrame:
    """Tie-corrected H and p over the groups with enough rows.

    Rows are counted per group and value; average ranks come from running totals
    over the distinct values.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("c"))
    # one row per group and distinct value: windows over it stay on the value grid
    sized = counts.withColumn("size", F.sum("c").over(Window.partitionBy(group))).filter(F.col("size") >= min_group)
    values = sized.groupBy(value).agg(F.sum("c").alias("t"))
    ranked = running_totals(values, [], value, ["t"], cells)
    t = F.col("t").cast("double")
    ranks = ranked.select(value, (F.col("t_before") + (F.col("t") + 1) / 2).alias("rank"))
    ties = values.agg(F.sum(t * t * t - t)).scalar()
    sums = (
        sized.join(ranks, value)
        .groupBy(group, "size")
        .agg(F.sum(F.col("c") * F.col("rank")).alias("r"))
        .agg(
            F.count("*").alias("groups"),
            F.sum("size").cast("double").alias("n"),
            F.sum(F.col("r") * F.col("r") / F.col("size")).alias("s"),
        )
        .withColumn("ties", ties)
    )
    n = F.col("n")
    h = (12 / (n * (n + 1)) * F.col("s") - 3 * (n + 1)) / (1 - F.col("ties") / (n * n * n - n))
    return sums.select(
        h.alias("statistic"),
        chi2_tail(h, (F.col("groups") - 1).cast("int")).alias("p_value"),
        F.col("groups"),
        n.cast("bigint").alias("observations"),
    )


def ship_lead_by_center(items: DataFrame, min_group: int = 30) -> DataFrame:
    valid = items.filter(F.col("valid_timeline_flag") == 1)
    return kruskal_wallis(valid, "distribution_center_id", "ship_lead_days", min_group)
