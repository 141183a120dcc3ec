"""Recency, frequency and monetary segments by k-means."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.measures import money_sum, ratio
from ..plans.session import shared_table
from .ranking import FINE_CELLS, percentiles

AXES = ("recency", "frequency", "monetary")
RAW = {"recency": "recency_days", "frequency": "order_count", "monetary": "net_sales_value"}
SCALED = tuple(f"{a}_scaled" for a in AXES)
# A centre that moves less than this stands still.
STILL = 1e-4
# Customers that starting centres are drawn from, and those that the silhouette is measured on.
START_SAMPLE, SILHOUETTE_SAMPLE = 4096, 12_000
# Points compared with all centres at a time.
CHUNK = 8192
# Segment names from best to worst.
SEGMENTS = ("Champions", "New / Developing", "Hibernating")


@contextmanager
def kept(df: DataFrame):
    """Keep a training set across iterations; lost blocks are recomputed."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def rfm_features(customers: DataFrame) -> DataFrame:
    """Logged axes and their robust scale: (x - median) / interquartile range."""
    logged = customers.filter((F.col("net_sales_value") > 0) & (F.col("order_count") > 0)).select(
        "customer_id",
        *RAW.values(),
        "observed_return_rate",
        F.log1p(F.greatest(F.col("recency_days"), F.lit(0)).cast("double")).alias("recency"),
        F.log1p(F.col("order_count").cast("double")).alias("frequency"),
        F.log1p(F.col("net_sales_value").cast("double")).alias("monetary"),
    )
    logged = shared_table(logged, "rfm-logged")  # the quantiles take several passes
    wanted = {f"{a}_q{int(p * 100)}": (a, p) for a in AXES for p in (0.25, 0.5, 0.75)}
    spread = percentiles(logged, [], wanted, FINE_CELLS)
    packed = spread.select(F.struct(*wanted).alias("q")).scalar()

    def scaled(a: str):
        width = F.col(f"_q.{a}_q75") - F.col(f"_q.{a}_q25")
        width = F.when(width == 0, 1.0).otherwise(width)  # a constant axis is only centred
        return ((F.col(a) - F.col(f"_q.{a}_q50")) / width).alias(f"{a}_scaled")

    return logged.withColumn("_q", packed).select(*logged.columns, *[scaled(a) for a in AXES])


def drawn(features: DataFrame, size: int) -> DataFrame:
    """``size`` customers in the order of an integer hash of their id, the same at any partitioning."""
    mixed = F.col("customer_id") % 2147483647 * 48271 % 2147483647
    return features.orderBy(mixed, "customer_id").limit(size)


def _starts(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` sampled points, each drawn by its squared distance from those drawn before."""
    rng = np.random.default_rng(seed)
    chosen = [sample[rng.integers(len(sample))]]
    far = ((sample - chosen[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        total = far.sum()
        chosen.append(sample[rng.choice(len(sample), p=far / total if total > 0 else None)])
        far = np.minimum(far, ((sample - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _nearest(axes: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and squared distance of the nearest centre of each point, the first of equally near ones; an axis at a time."""
    near, best = np.zeros(axes.shape[1], dtype=np.int64), None
    for place, centre in enumerate(centres):
        far = (axes[0] - centre[0]) ** 2
        for x, c in zip(axes[1:], centre[1:]):
            far += (x - c) ** 2
        if best is None:
            best = far
        else:
            near[far < best] = place
            np.minimum(best, far, out=best)
    return near, best


def _one_round(points: DataFrame, sets: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """For each set of centres, per cluster: weight, weighted sums of the axes, and cost; one aggregation for all sets."""
    width = len(AXES)

    def partial(batches):
        sums = {i: np.zeros((len(c), width + 2)) for i, c in sets.items()}
        for batch in batches:
            table = np.column_stack([batch.column(j).to_numpy() for j in range(width + 1)])
            for at in range(0, len(table), CHUNK):
                axes = np.ascontiguousarray(table[at : at + CHUNK, :width].T)
                w = np.ascontiguousarray(table[at : at + CHUNK, width])
                weighted = [w, *(w * x for x in axes)]
                for i, centres in sets.items():
                    near, far = _nearest(axes, centres)
                    for j, values in enumerate((*weighted, w * far)):
                        sums[i][:, j] += np.bincount(near, values, len(centres))
        rows = [(i, c, *row) for i, part in sums.items() for c, row in enumerate(part.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*rows)], names=names)

    names = ["fit", "cluster", "w", *[f"s{a}" for a in range(width)], "cost"]
    ddl = "fit bigint, cluster bigint, " + ", ".join(f"{n} double" for n in names[2:])
    totals = points.mapInArrow(partial, ddl).groupBy("fit", "cluster").agg(*[F.sum(n).alias(n) for n in names[2:]])
    out = {i: np.zeros((len(c), width + 2)) for i, c in sets.items()}
    for row in totals.collect():  # one row per centre
        out[row["fit"]][row["cluster"]] = row[2:]
    return out


def k_means(points: DataFrame, starts: Sequence[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """Centres and cost of the fit from each set of starting centres.

    ``points`` has the axes and a weight ``w``. All sets travel together: a round
    is one pass over the points for every set that still moves. A cluster without
    points keeps its centre. Rounds have no limit, as their number grows with the
    points: each lowers the cost by a centre's weight times its squared move, so
    all sets settle. Raises if a centre is not a number.
    """
    centres = [np.array(c, dtype=float) for c in starts]
    moving = set(range(len(centres)))
    while moving:
        for i, sums in _one_round(points, {i: centres[i] for i in sorted(moving)}).items():
            filled = sums[:, 0] > 0
            new = centres[i].copy()
            new[filled] = sums[filled, 1:-1] / sums[filled, :1]
            if not np.isfinite(new).all():
                raise ValueError("an axis has values that are no finite numbers")
            if np.abs(new - centres[i]).max() <= STILL:
                moving.discard(i)
            centres[i] = new
    final = _one_round(points, dict(enumerate(centres)))
    return [(c, float(final[i][:, -1].sum())) for i, c in enumerate(centres)]


def best_centres(features: DataFrame, ks: Sequence[int], restarts: int, seed: int) -> dict[int, tuple[np.ndarray, float]]:
    """For each number of clusters the centres and cost of the cheapest of ``restarts`` fits.

    ``features`` is read twice; give a written table. Equal points travel as one,
    with a weight. Starting centres come from ``START_SAMPLE`` customers; the fits
    run over all.
    """
    axes = [F.col(c).alias(f"x{i}") for i, c in enumerate(SCALED)]
    points = shared_table(features.groupBy(*axes).agg(F.count("*").cast("double").alias("w")), "rfm-points")
    sample = np.array([tuple(r) for r in drawn(features, START_SAMPLE).select(*SCALED).collect()], dtype=float).reshape(-1, len(AXES))
    if not len(sample):
        raise ValueError("no customers to segment")
    asked = [(k, i) for k in ks for i in range(restarts)]
    fits = k_means(points, [_starts(sample, k, seed + 1000 * k + i) for k, i in asked])
    best: dict[int, tuple[np.ndarray, float]] = {}
    for (k, _), fit in zip(asked, fits):
        if k not in best or fit[1] < best[k][1]:
            best[k] = fit
    return best


def silhouette(features: DataFrame, centres: dict[int, Sequence[Sequence[float]]], size: int = SILHOUETTE_SAMPLE, squared: bool = False) -> DataFrame:
    """(k, silhouette): mean of (b - a) / max(a, b) over ``size`` drawn customers, or all if they are fewer.

    a is a customer's mean distance from the others of its cluster in the sample, b
    the least mean distance from another cluster; alone in its cluster it counts 0.
    Distances are Euclidean, squared ones on request. Blocks of the sample meet the
    whole sample, whose size bounds what is sent to the tasks.
    """
    own = drawn(features, size).select(*SCALED)
    sample = np.array([tuple(r) for r in own.collect()], dtype=float).reshape(-1, len(AXES))
    labels = {}
    for k, c in centres.items():
        c = np.asarray(c, dtype=float)
        labels[k] = np.concatenate(
            [((sample[i : i + CHUNK, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1) for i in range(0, len(sample), CHUNK)] or [np.zeros(0, int)]
        )
    spark = features.sparkSession
    shared = spark.sparkContext.broadcast((sample, labels))
    blocks = spark.range(0, len(sample), 256, max(1, len(sample) // 256))

    def score(batches):
        points, known = shared.value
        members = {k: np.eye(int(v.max()) + 1)[v] for k, v in known.items()}
        for batch in batches:
            rows = []
            for at in batch.column(0).to_pylist():
                part = points[at : at + 256]
                far = ((part[:, None, :] - points[None]) ** 2).sum(axis=2)
                far = far if squared else np.sqrt(far)
                for k, own_label in known.items():
                    total, count = far @ members[k], members[k].sum(axis=0)
                    mine = own_label[at : at + 256]
                    at_own = np.arange(len(part))
                    a = total[at_own, mine] / np.maximum(count[mine] - 1, 1)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        mean = np.where(count > 0, total / count, np.inf)
                    mean[at_own, mine] = np.inf
                    b = mean.min(axis=1)
                    good = (count[mine] > 1) & np.isfinite(b) & (np.maximum(a, b) > 0)
                    s = np.where(good, (np.where(good, b, 0) - a) / np.where(good, np.maximum(a, b), 1), 0.0)
                    rows.append((k, float(s.sum()), len(s)))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*rows)], names=["k", "s", "n"])

    scored = blocks.mapInArrow(score, "k bigint, s double, n bigint")
    return scored.groupBy(F.col("k").cast("int").alias("k")).agg((F.sum("s") / F.sum("n")).alias("silhouette"))


def _diagnostics(features: DataFrame, best: dict[int, tuple[np.ndarray, float]], squared: bool = False) -> DataFrame:
    """Inertia and silhouette per number of clusters."""
    costs = features.sparkSession.createDataFrame([(int(k), cost) for k, (_, cost) in best.items()], "k INT, inertia DOUBLE")
    return costs.join(silhouette(features, {k: c for k, (c, _) in best.items()}, squared=squared), "k").select("k", "inertia", "silhouette")


def rfm_k_diagnostics(
    features: DataFrame, ks: Sequence[int] = (3, 4, 5, 6), restarts: int = 20, seed: int = 42, squared: bool = False
) -> DataFrame:
    """Inertia over all customers and silhouette over the drawn ones, per number of clusters."""
    kept_features = shared_table(features, "rfm-features")
    return _diagnostics(kept_features, best_centres(kept_features, ks, restarts, seed), squared)


def _pct_rank(c: str):
    """Average rank divided by the number of clusters."""
    w, same = Window.partitionBy().orderBy(c), Window.partitionBy(c)
    rows = F.count("*").over(Window.partitionBy())
    return (F.rank().over(w) + (F.count("*").over(same) - 1) / 2) / rows


def cluster_profile(assigned: DataFrame) -> DataFrame:
    """Cluster summary, value score and label; one row per cluster."""
    medians = percentiles(
        assigned,
        ["cluster_id"],
        {
            "median_recency_days": ("recency_days", 0.5),
            "median_net_sales": (F.col("net_sales_value").cast("double"), 0.5),
        },
        (lambda v: F.floor(v), lambda c: F.floor(c / 10000)),
    )
    profile = (
        assigned.groupBy("cluster_id")
        .agg(
            F.count("*").alias("customers"),
            F.avg("order_count").alias("mean_order_count"),
            money_sum("net_sales_value").alias("total_net_sales"),
            F.avg("observed_return_rate").alias("mean_return_rate"),
        )
        .join(medians, "cluster_id")
    )
    scored = profile.withColumn(
        "value_score",
        _pct_rank("mean_order_count") + _pct_rank("median_net_sales") - _pct_rank("median_recency_days"),
    )
    place = F.row_number().over(Window.orderBy(F.desc("value_score"), "cluster_id"))
    names = F.array(*[F.lit(s) for s in SEGMENTS])
    return scored.withColumn("segment", F.coalesce(F.get(names, place - 1), F.concat(F.lit("Segment "), place)))


def nearest_centre(features: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """``cluster_id`` and squared distance of the nearest of stored centres (scaled axes); the first of equally near ones."""
    far = [sum((F.col(f"{a}_scaled") - F.lit(float(x))) ** 2 for a, x in zip(AXES, c)) for c in centres]
    best = F.array_min(F.array(*[F.struct(d.alias("distance"), F.lit(i).alias("id")) for i, d in enumerate(far)]))
    return features.withColumn("_best", best).select(
        *features.columns, F.col("_best.id").alias("cluster_id"), F.col("_best.distance").alias("distance")
    )


def rfm_segment(features: DataFrame, k: int = 3, restarts: int = 30, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Customers with their segment, and the profile of the segments."""
    kept_features = shared_table(features, "rfm-features")
    centres = best_centres(kept_features, [k], restarts, seed)[k][0]
    assigned = nearest_centre(kept_features, centres.tolist()).drop("distance")
    profile = cluster_profile(assigned)
    labels = F.broadcast(profile.select("cluster_id", "segment"))  # k rows
    return assigned.join(labels, "cluster_id"), profile


def standard_scale(features: DataFrame) -> DataFrame:
    """The scaled axes replaced by (x - mean) / standard deviation; a constant axis is only centred."""
    stats = features.agg(F.struct(*[f(a).alias(f"{n}_{a}") for a in AXES for n, f in (("m", F.avg), ("s", F.stddev_pop))])).scalar()
    rest = [c for c in features.columns if c not in SCALED]
    width = lambda a: F.when(F.col(f"_s.s_{a}") > 0, F.col(f"_s.s_{a}")).otherwise(1.0)
    return features.withColumn("_s", stats).select(*rest, *[((F.col(a) - F.col(f"_s.m_{a}")) / width(a)).alias(f"{a}_scaled") for a in AXES])


def rfm_variant(features: DataFrame, k: int = 3, ks: Sequence[int] = (2, 3, 4, 5, 6, 7, 8), restarts: int = 20, seed: int = 42):
    """Standard scale, rank-sum naming with inverted recency, and the snake profile.

    Returns (segmented customers, snake profile, diagnostics over ``ks``).
    """
    data = shared_table(standard_scale(features), "rfm-standard")
    best = best_centres(data, sorted({k, *ks}), restarts, seed)
    assigned = nearest_centre(data, best[k][0].tolist()).drop("distance")
    named = snake_profile(assigned)
    segmented = assigned.join(F.broadcast(named.select("cluster_id", "segment")), "cluster_id")
    return segmented, named, _diagnostics(data, {n: best[n] for n in ks})


def snake_profile(assigned: DataFrame) -> DataFrame:
    """Means of the raw and scaled axes per cluster, with the name that their ranks give."""
    snake = assigned.groupBy("cluster_id").agg(
        F.count("*").alias("customers"),
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in RAW.values()],
        *[F.avg(f"{a}_scaled").alias(f"scaled_{a}") for a in AXES],
    )
    rank = lambda c: _pct_rank(c) * F.count("*").over(Window.partitionBy())
    worst = F.max("_r").over(Window.partitionBy())
    ranked = snake.withColumn("_r", rank("mean_recency_days")).withColumn(
        "quality", worst - F.col("_r") + 1 + rank("mean_order_count") + rank("mean_net_sales_value")
    ).drop("_r")
    names = F.array(*[F.lit(s) for s in SEGMENTS])
    place = F.row_number().over(Window.orderBy(F.desc("quality"), "cluster_id"))
    return ranked.withColumn("segment", F.coalesce(F.get(names, place - 1), F.concat(F.lit("Segment "), place)))


def segment_shares(profile: DataFrame) -> DataFrame:
    """Customer and revenue share per segment, over the k rows of the profile."""
    whole = Window.partitionBy()
    return profile.select(
        "segment",
        "customers",
        ratio(F.col("customers"), F.sum("customers").over(whole)).alias("customer_share"),
        "median_recency_days",
        "mean_order_count",
        "median_net_sales",
        "total_net_sales",
        ratio(F.col("total_net_sales"), F.sum("total_net_sales").over(whole)).alias("revenue_share"),
    )
