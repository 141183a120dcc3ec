"""Order statistics without putting one group into one task.

All of these start from counts per distinct value, so repeated values are
merged before any shuffle. Running totals are then taken cell by cell: a cell is
a coarser step of the value (a day for minutes, a whole unit for money), so the
rows of one window are limited by the grid and not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Cell = Callable[[Column], Column]


# Cells for money held to four decimals, and for logarithms and scores.
MONEY_CELLS: tuple[Cell, ...] = (lambda v: F.floor(v), lambda c: F.floor(c / 10000))
FINE_CELLS: tuple[Cell, ...] = (lambda v: F.floor(v * 100000), lambda c: F.floor(c / 1000))
DAY_CELLS: tuple[Cell, ...] = (lambda v: F.floor(v),)


def running_totals(
    df: DataFrame, by: Sequence[str], value: str, totals: Sequence[str], cells: Sequence[Cell] = ()
) -> DataFrame:
    """Add ``<total>_before``: the sum over smaller values of the same group.

    ``df`` has one row per group and value. ``cells`` go from fine to coarse and
    must not decrease when the value grows; cell k is applied to cell k-1.
    """
    by = list(by)

    def prefix(frame: DataFrame, keys: list[str], order: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return frame.select(
            "*", *[F.coalesce(F.sum(t).over(w), F.lit(0)).alias(f"{t}_before") for t in totals]
        )

    if not cells:
        return prefix(df, by, value)
    step = f"_cell_{len(cells)}"
    celled = df.withColumn(step, cells[0](F.col(value)))
    inner = prefix(celled, [*by, step], value)
    coarse = celled.groupBy(*by, step).agg(*[F.sum(t).alias(t) for t in totals])
    offsets = running_totals(coarse, by, step, totals, cells[1:])
    renamed = offsets.select(
        *[F.col(k).alias(f"_k_{k}") for k in [*by, step]],
        *[F.col(f"{t}_before").alias(f"_o_{t}") for t in totals],
    )
    match = None
    for k in [*by, step]:
        test = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        match = test if match is None else match & test
    joined = inner.join(renamed, match, "inner")
    return joined.select(
        *df.columns, *[(F.col(f"{t}_before") + F.col(f"_o_{t}")).alias(f"{t}_before") for t in totals]
    )


def percentiles(
    df: DataFrame,
    by: Sequence[str],
    wanted: Mapping[str, tuple[str | Column, float]],
    cells: Sequence[Cell] = (),
    sums: Mapping[str, Column] | None = None,
    means: Mapping[str, str] | None = None,
) -> DataFrame:
    """Exact percentiles with linear interpolation; NULLs are left out.

    ``wanted`` maps an output name to (value, p). One scan serves all of them,
    and also ``sums`` (per-row values to add up over all rows of the group) and
    ``means`` (output name to one of the values): they ride on the same counts.
    Without ``cells`` this is for values on a bounded grid (whole days, minutes):
    the window of a group streams over one row per distinct value. Continuous
    values need ``cells``.
    """
    by = list(by)
    sources: list[tuple[str, Column]] = []
    slots: dict[str, int] = {}
    for col, _ in wanted.values():
        label = col if isinstance(col, str) else str(col)
        if label not in slots:
            slots[label] = len(sources)
            sources.append((label, F.col(col) if isinstance(col, str) else col))
    sums, means = dict(sums or {}), dict(means or {})
    extra = {name: f"_s{i}" for i, name in enumerate(sums)}
    pairs = [F.struct(F.lit(i).alias("slot"), c.cast("double").alias("v")) for i, (_, c) in enumerate(sources)]
    # the sums are carried by the first value's rows, so those stay even if it is NULL
    counts = (
        df.select(*by, *[c.alias(extra[name]) for name, c in sums.items()], F.inline(F.array(*pairs)))
        .filter((F.col("slot") == 0) | F.col("v").isNotNull() if sums else F.col("v").isNotNull())
        .groupBy(*by, "slot", "v")
        .agg(
            F.count("v").alias("n"),
            *[F.sum(F.when(F.col("slot") == 0, F.col(c))).alias(c) for c in extra.values()],
        )
    )
    ranked = running_totals(counts, [*by, "slot"], "v", ["n"], cells)
    if cells:
        sizes = counts.groupBy(*by, "slot").agg(F.sum("n").alias("size"))
        same = F.lit(True)
        for k in [*by, "slot"]:
            same = same & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        renamed = sizes.select(*[F.col(k).alias(f"_s_{k}") for k in [*by, "slot"]], "size")
        ranked = ranked.join(renamed, same, "inner")
    else:
        ranked = ranked.withColumn("size", F.sum("n").over(Window.partitionBy(*by, "slot")))
    picks = []
    for name, (col, p) in wanted.items():
        slot = slots[col if isinstance(col, str) else str(col)]
        place = F.lit(float(p)) * (F.col("size") - 1)
        hit = lambda k: F.max(
            F.when(
                (F.col("slot") == slot) & (F.col("n_before") <= k) & (k < F.col("n_before") + F.col("n")), F.col("v")
            )
        )
        low, high = hit(F.floor(place)), hit(F.ceil(place))
        part = F.max(F.when(F.col("slot") == slot, place - F.floor(place)))
        picks.append((low + (high - low) * part).alias(name))
    for name, value in means.items():
        mine = F.col("slot") == slots[value]
        total = F.sum(F.when(mine, F.col("v") * F.col("n")))
        picks.append((total / F.nullif(F.sum(F.when(mine, F.col("n"))), F.lit(0))).alias(name))
    picks += [F.sum(c).alias(name) for name, c in extra.items()]
    return ranked.groupBy(*by).agg(*picks)


def percentile_edges(df: DataFrame, value: str, parts: int, cells: Sequence[Cell] = ()) -> Column:
    """Inner edges of a split into equal parts, as a scalar array; repeated edges once.

    Positions are linear between neighbours. Distinct values are ranked cell by
    cell, so continuous scores need ``cells``.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    stats = counts.agg(F.struct(F.sum("n").alias("size"), F.min(value).alias("lowest"))).scalar()
    ranked = running_totals(counts, [], value, ["n"], cells).withColumn("_t", stats).select(
        value, "n", "n_before", F.col("_t.size").alias("size"), F.col("_t.lowest").alias("lowest")
    )
    steps = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    picks = (
        ranked.select(value, "n", "n_before", "size", "lowest", F.posexplode(steps).alias("step", "p"))
        .withColumn("place", F.col("p") * (F.col("size") - 1))
    )
    inside = lambda k: (F.col("n_before") <= k) & (k < F.col("n_before") + F.col("n"))
    edge = (
        picks.filter(inside(F.floor("place")) | inside(F.ceil("place")))
        .groupBy("step")
        .agg(
            F.max(F.when(inside(F.floor("place")), F.col(value))).alias("lo"),
            F.max(F.when(inside(F.ceil("place")), F.col(value))).alias("hi"),
            F.max(F.col("place") - F.floor("place")).alias("part"),
            F.max("lowest").alias("lowest"),
        )
        .select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("edge"), "lowest")
    )
    return edge.filter(F.col("edge") > F.col("lowest")).agg(F.array_sort(F.collect_set("edge"))).scalar()


def bucket_of(value: Column, edges: Column) -> Column:
    """1 + the number of edges below the value: right-closed buckets."""
    return F.size(F.filter(edges, lambda e: e < value)) + 1
