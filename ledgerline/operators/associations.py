"""Category association rules over orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import ratio
from .facts import attach


def basket_rules(items: DataFrame, products: DataFrame, min_pair: int = 25, level: str = "category") -> DataFrame:
    """Support, confidence and lift of ordered category pairs.

    An order becomes the sorted set of its categories, at most one entry per
    category however many lines it has. Equal sets are counted first and pairs
    are formed once per distinct set, weighted by its number of orders, not once
    per order. Categories in fewer than ``min_pair`` orders cannot be part of a
    pair that reaches it and are left out of the pairing; this loses no rule.
    """
    sold = attach(items.filter(F.col("net_sales_value") > 0), products, "product_id", "product_id", [level])
    entries = sold.select("order_id", F.col(level).alias("cat")).distinct()
    total = entries.agg(F.count_distinct("order_id")).scalar()
    singles = entries.groupBy("cat").agg(F.count("*").alias("orders"))
    sets = (
        entries.join(singles.filter(F.col("orders") >= min_pair), "cat", "left_semi")
        .groupBy("order_id")
        .agg(F.sort_array(F.collect_set("cat")).alias("cats"))
        .groupBy("cats")
        .agg(F.count("*").alias("n"))
    )
    x, y = F.col("x"), F.col("y")
    pairs = (
        sets.select(F.posexplode("cats").alias("i", "x"), "cats", "n")
        .select("x", F.explode(F.slice("cats", F.col("i") + 2, F.size("cats"))).alias("y"), "n")
        .groupBy("x", "y")
        .agg(F.sum("n").alias("pair_orders"))
        .filter(F.col("pair_orders") >= min_pair)
    )
    both = F.array(
        F.struct(x.alias("antecedent"), y.alias("consequent")), F.struct(y.alias("antecedent"), x.alias("consequent"))
    )
    left = singles.select(F.col("cat").alias("antecedent"), F.col("orders").alias("antecedent_orders"))
    right = singles.select(F.col("cat").alias("consequent"), F.col("orders").alias("consequent_orders"))
    pair, a, b, t = (F.col(c) for c in ("pair_orders", "antecedent_orders", "consequent_orders", "eligible_orders"))
    return (
        pairs.select(F.inline(both), "pair_orders")
        .join(left, "antecedent")
        .join(right, "consequent")
        .withColumn("eligible_orders", total)
        .select(
            "antecedent",
            "consequent",
            "pair_orders",
            ratio(pair, t).alias("support"),
            ratio(pair, a).alias("confidence"),
            (ratio(pair, a) / ratio(b, t)).alias("lift"),
            "antecedent_orders",
            "consequent_orders",
            "eligible_orders",
        )
    )


def top_rules(rules: DataFrame, n: int = 15) -> DataFrame:
    """Rules with at least median support, best lift first."""
    middle = rules.agg(F.percentile("support", 0.5)).scalar()
    return (
        rules.withColumn("_m", middle)
        .filter(F.col("support") >= F.col("_m"))
        .drop("_m")
        .orderBy(F.desc("lift"), F.desc("pair_orders"), "antecedent", "consequent")
        .limit(n)
    )
