"""Return propensity: features, logistic model, scores, lift and metrics."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.measures import flag_sum, ratio
from ..functions.times import as_date, iso_weekday
from ..plans.session import checkpoint_folder, shared_table
from .facts import attach
from .ranking import FINE_CELLS, bucket_of, percentile_edges, running_totals
from .segmentation import kept

# The features of the model.
CATEGORICAL = (
    "category", "department", "brand_group", "distribution_center", "age_band", "gender", "country",
    "acquisition_source", "order_month", "order_weekday",
)
NUMERIC = ("sale_price", "unit_cost", "gross_margin_rate", "order_item_count", "age")
INFREQUENT, MISSING = "infrequent", "missing"
INTERCEPT = "(intercept)"
WEIGHTS = "name STRING, level STRING, weight DOUBLE, centre DOUBLE, scale DOUBLE"
# The fit stops when a step gains less than this share of the loss.
TOLERANCE = 1e-10
# Up to so many features the fit sums their products too, and needs few passes over the rows; wider models go by gradients alone.
MOST_FEATURES = 1024
# Draws of the stratified split go below this prime; a cell holds so many neighbouring ones.
DRAWS, DRAW_CELL = 2147483647, 2048


def propensity_features(
    items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame, top_brands: int = 100
) -> DataFrame:
    """Eligible items with what was known when they were ordered.

    Brands outside the largest ``top_brands`` share one label. The leading brands
    are found by a top-n over brand totals, a list bounded by ``top_brands``.
    """
    wide = attach(items, products, "product_id", "product_id", ["category", "department", "brand"])
    leaders = (
        wide.groupBy("brand")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "brand")
        .limit(top_brands)
        .select("brand", F.lit(True).alias("_leading"))
    )
    eligible = wide.filter(F.col("return_observation_eligible_flag") == 1)
    eligible = attach(eligible, customers, "customer_id", "user_id", ["country", "age_band"])
    people = customers.select(F.col("user_id").alias("customer_id"), "age", "gender")
    baskets = orders.select("order_id", F.col("item_count").alias("order_item_count"))
    created = F.col("order_item_created_at")
    return (
        eligible.join(F.broadcast(leaders), "brand", "left")
        .join(baskets, "order_id")
        .join(people, "customer_id")
        .select(
            "order_item_id",
            as_date(created).alias("order_date"),
            F.col("returned_item_flag").alias("return_flag"),
            F.col("sale_price").cast("double").alias("sale_price"),
            F.col("unit_cost").cast("double").alias("unit_cost"),
            "gross_margin_rate",
            "order_item_count",
            "category",
            "department",
            F.when(F.col("_leading"), F.col("brand")).otherwise("Other brands").alias("brand_group"),
            F.col("distribution_center_id").cast("string").alias("distribution_center"),
            "age",
            "age_band",
            "gender",
            "country",
            "acquisition_source",
            F.month(created).cast("string").alias("order_month"),
            iso_weekday(created).cast("string").alias("order_weekday"),
        )
    )


@dataclass
class PropensityModel:
    """A fitted model: ``known`` has the trained levels per categorical column, ``fitted`` the weights of all
    levels, one column after the other, then of the numbers, then the intercept."""

    levels: DataFrame
    categorical: Sequence[str]
    numeric: Sequence[str]
    label: str
    known: list[list[str]]
    centre: list[float]
    scale: list[float]
    fitted: list[float]
    passes: int

    def prepare(self, df: DataFrame) -> DataFrame:
        return prepare(df, self.levels, self.categorical, self.numeric)

    def score(self, df: DataFrame) -> DataFrame:
        return score_by_weights(self.prepare(df), self.weights(df.sparkSession), self.categorical, self.numeric)

    def coefficients(self, df: DataFrame, odds: bool = False) -> DataFrame:
        """Feature weights, largest first; bounded by the width of the model. Levels never seen have two columns of weight 0."""
        values, rows = iter(self.fitted), []
        for c, levels in zip(self.categorical, self.known):
            rows += [(f"{c}_{level}", next(values)) for level in levels] + [(f"{c}_unseen{i}", 0.0) for i in range(2)]
        rows += [(f"{c}_scaled", next(values)) for c in self.numeric]
        table = df.sparkSession.createDataFrame(rows, "feature STRING, coefficient DOUBLE").withColumn(
            "absolute_coefficient", F.abs("coefficient")
        )
        return table.withColumn("odds_ratio", F.exp("coefficient")) if odds else table

    def weights(self, spark: SparkSession) -> DataFrame:
        """(name, level, weight, centre, scale): a row per trained level, per number and for the intercept."""
        values, rows = iter(self.fitted), []
        for c, levels in zip(self.categorical, self.known):
            rows += [(c, level, next(values), None, None) for level in levels]
        rows += [(c, None, next(values), m, s) for c, m, s in zip(self.numeric, self.centre, self.scale)]
        return spark.createDataFrame([*rows, (INTERCEPT, None, next(values), None, None)], WEIGHTS)


def score_by_weights(
    prepared: DataFrame, weights: DataFrame, categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC
) -> DataFrame:
    """Add ``return_probability`` from a table of weights (see ``PropensityModel.weights``).

    Each categorical column is joined to the weights of its own levels, a level
    without one adds nothing; the few rows without a level come as one scalar map.
    A number whose scale is 0 adds nothing.
    """
    columns, total = prepared.columns, F.lit(0.0)
    for i, c in enumerate(categorical):
        side = weights.filter((F.col("name") == c) & F.col("level").isNotNull()).select(
            F.col("level").alias("_level"), F.col("weight").alias(f"_weight_{i}")
        )
        prepared = prepared.join(side, F.col(c) == F.col("_level"), "left").drop("_level")
        total = total + F.coalesce(F.col(f"_weight_{i}"), F.lit(0.0))
    entry = F.struct("name", F.struct("weight", "centre", "scale"))
    numbers = weights.filter(F.col("level").isNull()).agg(F.map_from_entries(F.collect_list(entry))).scalar()
    at = lambda c: F.col("_numbers")[c]
    for c in numeric:
        total = total + F.coalesce(at(c)["weight"] * (F.col(c) - at(c)["centre"]) / F.nullif(at(c)["scale"], F.lit(0.0)), F.lit(0.0))
    total = total + at(INTERCEPT)["weight"]
    return prepared.withColumn("_numbers", numbers).select(
        *columns, (1 / (1 + F.exp(-total))).alias("return_probability")
    )


def coefficient_table(weights: DataFrame, odds: bool = False) -> DataFrame:
    """Feature, coefficient and its size from a table of weights, without the intercept."""
    table = weights.filter(F.col("name") != INTERCEPT).select(
        F.concat_ws("_", "name", F.coalesce("level", F.lit("scaled"))).alias("feature"),
        F.col("weight").alias("coefficient"),
        F.abs("weight").alias("absolute_coefficient"),
    )
    return table.withColumn("odds_ratio", F.exp("coefficient")) if odds else table


def penalised_gradient(
    prepared: DataFrame,
    weights: DataFrame,
    label: str = "return_flag",
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
) -> DataFrame:
    """(name, level, gradient) of the class-balanced penalised loss at these weights, over the training rows.

    Zero everywhere, and only there, if the weights are the optimum. The rows are
    unfolded to their features and summed per feature before anything is shuffled.
    """
    sizes = prepared.groupBy(label).agg(F.count("*").alias("_size"))
    # few classes, so a scalar map: joined on the label, all rows of a class would meet in one task
    per_class = F.map_from_entries(F.collect_list(F.when(F.col(label).isNotNull(), F.struct(label, "_size"))))
    classes = sizes.agg(
        F.struct(F.count("*").alias("classes"), F.sum("_size").alias("rows"), per_class.alias("sizes"))
    ).scalar()
    parts = weights.filter(F.col("level").isNull() & F.col("centre").isNotNull())
    scaling = parts.agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct("centre", "scale"))))).scalar()
    scaled = lambda c: F.coalesce(
        (F.col(c) - F.col("_scaling")[c]["centre"]) / F.nullif(F.col("_scaling")[c]["scale"], F.lit(0.0)), F.lit(0.0)
    )
    feature = lambda name, level, value: F.struct(name.alias("name"), level.alias("level"), value.alias("value"))
    none = F.lit(None).cast("string")
    features = [feature(F.lit(c), F.col(c), F.lit(1.0)) for c in categorical]
    features += [feature(F.lit(c), none, scaled(c)) for c in numeric] + [feature(F.lit(INTERCEPT), none, F.lit(1.0))]
    # a class of n rows weighs 1 / classes in all, so a row's share is 1 / (classes * n)
    share = 1 / (F.col("_all.classes") * F.col("_all.sizes")[F.col(label)])
    residual = (F.col("return_probability") - F.col(label)) * share
    sums = (
        score_by_weights(prepared, weights, categorical, numeric)
        .filter(F.col(label).isNotNull())
        .withColumns({"_scaling": scaling, "_all": classes})
        .select(residual.alias("_residual"), F.inline(F.array(*features)))
        .groupBy("name", "level")
        .agg(F.sum(F.col("value") * F.col("_residual")).alias("slope"))
    )
    own = sums.select(F.col("name").alias("_name"), F.col("level").alias("_own"), "slope")
    met = (F.col("name") == F.col("_name")) & F.col("level").eqNullSafe(F.col("_own"))
    penalty = F.when(F.col("name") == INTERCEPT, 0.0).otherwise(F.col("weight") / F.col("_all.rows"))
    return (
        weights.join(own, met, "left")
        .withColumn("_all", classes)
        .select("name", "level", (F.coalesce("slope", F.lit(0.0)) + penalty).alias("gradient"))
    )


def optimality_certificate(model: PropensityModel, train: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """One row: training rows, classes, and whether no part of the penalised gradient exceeds ``tolerance``."""
    gradient = penalised_gradient(
        model.prepare(train), model.weights(train.sparkSession), model.label, model.categorical, model.numeric
    )
    largest = gradient.agg(F.max(F.abs("gradient"))).scalar()
    return (
        train.agg(F.count("*").alias("n_rows"), F.countDistinct(model.label).alias("classes"))
        .withColumn("_largest", largest)
        .select("n_rows", "classes", (F.col("_largest") <= tolerance).alias("optimal"))
    )


def level_table(train: DataFrame, columns: Sequence[str], minimum: int) -> DataFrame:
    """(name, level, rare) of all columns, counted in one pass and written to the shared folder."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("level")) for c in columns])
    counted = (
        train.select(F.inline(pairs))
        .filter(F.col("level").isNotNull())
        .groupBy("name", "level")
        .agg((F.count("*") < minimum).alias("rare"))
    )
    spark = train.sparkSession
    path = f"{checkpoint_folder(spark)}/levels-{uuid.uuid4().hex}"
    counted.write.parquet(path)
    return spark.read.schema("name STRING, level STRING, rare BOOLEAN").parquet(path)


def prepare(df: DataFrame, levels: DataFrame, columns: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Levels rare in training take the shared one; levels it never saw stay as they are."""
    for c in columns:
        side = levels.filter((F.col("name") == c) & F.col("rare")).select(F.col("level").alias("_level"), F.col("rare").alias("_rare"))
        folded = F.when(F.col("_rare"), INFREQUENT).otherwise(F.coalesce(F.col(c), F.lit(MISSING)))
        df = df.join(side, F.col(c) == F.col("_level"), "left").withColumn(c, folded).drop("_level", "_rare")
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric})


def _coded(
    train: DataFrame, levels: DataFrame, known: list[list[str]], label: str, categorical: Sequence[str], numeric: Sequence[str]
) -> DataFrame:
    """(y, c0, c1, …, x0, x1, …): the label, the place of each level among the known ones, and the numbers; written once."""
    rows = [(c, level, k) for c, own in zip(categorical, known) for k, level in enumerate(own)]
    places = train.sparkSession.createDataFrame(rows, "_name STRING, _folded STRING, _place INT")
    folded = F.when(F.col("rare"), INFREQUENT).otherwise(F.col("level"))
    met = (F.col("name") == F.col("_name")) & (folded == F.col("_folded"))
    placed = levels.join(F.broadcast(places), met).select("name", F.col("level").alias("_level"), "_place")
    placed = shared_table(placed, "coded-levels")  # by its own size, so that joins to it need not shuffle the rows
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{k}") for k, c in enumerate(numeric)]
    df = train.select(F.col(label).cast("double").alias("y"), *[F.col(c).alias(f"l{i}") for i, c in enumerate(categorical)], *numbers)
    for i, (c, own) in enumerate(zip(categorical, known)):
        side = placed.filter(F.col("name") == c).select("_level", F.col("_place").alias(f"c{i}"))
        missing = F.lit(own.index(MISSING) if MISSING in own else None).cast("int")
        df = df.join(side, F.col(f"l{i}") == F.col("_level"), "left").drop("_level").withColumn(f"c{i}", F.coalesce(f"c{i}", missing))
    return shared_table(df.select("y", *[f"c{i}" for i in range(len(known))], *[f"x{k}" for k in range(len(numeric))]), "coded")


def _arrays(batch: pa.RecordBatch, prefix: str) -> list[np.ndarray]:
    return [batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names) if name[0] == prefix]


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> list[list[float]]:
    """Per column the values at rank ceil(share x rows), exactly, however many rows and values there are.

    The doubles' bits, made to sort like the numbers, are found sixteen at a time:
    a pass counts the next sixteen of those that begin like a wanted value. No
    column has nulls; -0.0 is 0.0.
    """
    if not columns:
        return []
    step, source = 16, df.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(columns)])

    def ordered(values: np.ndarray) -> np.ndarray:
        bits = (values + 0.0).view(np.uint64)
        return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))

    found = [[0] * len(shares) for _ in columns]
    ranks: list[list[int]] = []
    for shift in range(64 - step, -1, -step):
        begun = [sorted(set(own)) for own in found]

        def count(batches):
            seen = [np.zeros((len(own), 1 << step), np.int64) for own in begun]
            for batch in batches:
                for k, values in enumerate(_arrays(batch, "x")):
                    bits = ordered(values) >> np.uint64(shift)
                    rest = (bits & np.uint64((1 << step) - 1)).astype(np.int64)
                    for i, start in enumerate(begun[k]):
                        # the first pass has nothing to begin with
                        mine = rest if shift == 64 - step else rest[bits >> np.uint64(step) == np.uint64(start)]
                        seen[k][i] += np.bincount(mine, minlength=1 << step)
            for k, own in enumerate(seen):
                i, part = np.nonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), k, np.int32)), pa.array(i.astype(np.int32)), pa.array(part.astype(np.int32)), pa.array(own[i, part])],
                    names=["k", "i", "part", "n"],
                )

        counted = source.mapInArrow(count, "k int, i int, part int, n bigint").groupBy("k", "i", "part").agg(F.sum("n").alias("n")).toArrow()
        k, i, part, n = (counted[c].to_numpy() for c in ("k", "i", "part", "n"))
        if not ranks:
            total = int(n[k == 0].sum())
            ranks = [[max(int(np.ceil(share * total)), 1) for share in shares] for _ in columns]
        for column, own in enumerate(found):
            for q, start in enumerate(own):
                mine = (k == column) & (i == begun[column].index(start))
                order = np.argsort(part[mine])
                upto = np.cumsum(n[mine][order])
                at = int(np.searchsorted(upto, ranks[column][q]))
                ranks[column][q] -= int(upto[at - 1]) if at else 0
                own[q] = start << step | int(part[mine][order][at])
    back = lambda bits: bits ^ (1 << 63) if bits >> 63 else ~bits & (1 << 64) - 1
    return [[float(np.uint64(back(bits)).view(np.float64)) for bits in own] for own in found]


def _sums(coded: DataFrame, sizes: Sequence[int], shares: dict, centre, factor, at: np.ndarray) -> np.ndarray:
    """Weighted loss, its gradient and its Hessian at these weights, end to end, summed over all rows.

    Rows are one level of each categorical column and a few numbers, so products
    of features are counts per pair of levels. A task gives one number per pair
    of features that it has met.
    """
    width, starts = len(at), [sum(sizes[:i]) for i in range(len(sizes))]
    first = sum(sizes)  # of the numbers; the intercept is a number that is always 1

    def add(batches):
        loss, gradient, hessian = 0.0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            y = _arrays(batch, "y")[0]
            levels = [v.astype(np.int64) for v in _arrays(batch, "c")]
            numbers = np.stack([(v - m) * f for v, m, f in zip(_arrays(batch, "x"), centre, factor)] + [np.ones(len(y))])
            score = at[first:] @ numbers
            for start, own in zip(starts, levels):
                score += at[start + own]
            weight = np.where(y == 1, shares[1], shares[0])
            chance = 1 / (1 + np.exp(-score))
            loss += float((weight * (np.logaddexp(0, score) - y * score)).sum())
            slope, curve = weight * (chance - y), weight * chance * (1 - chance)
            gradient[first:] += numbers @ slope
            bent = numbers * curve
            hessian[first:, first:] += bent @ numbers.T
            for i, (start, own, size) in enumerate(zip(starts, levels, sizes)):
                rows = slice(start, start + size)
                gradient[rows] += np.bincount(own, slope, size)
                for k in range(width - first):
                    hessian[rows, first + k] += np.bincount(own, bent[k], size)
                hessian[np.arange(start, start + size), np.arange(start, start + size)] += np.bincount(own, curve, size)
                for j in range(i):
                    pairs = np.bincount(own * sizes[j] + levels[j], curve, size * sizes[j]).reshape(size, sizes[j])
                    hessian[starts[j] : starts[j] + sizes[j], rows] += pairs.T
        values = np.concatenate(([loss], gradient, hessian.ravel()))
        met = np.flatnonzero(values)
        for k in range(0, len(met), 50_000):
            part = met[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(values[part])], names=["i", "v"])

    added = coded.mapInArrow(add, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(1 + width + width * width)
    out[added["i"].to_numpy()] = added["v"].to_numpy()
    return out


def _by_products(coded: DataFrame, sizes, shares, centre, factor, total: int, max_iter: int) -> tuple[list[float], int]:
    """(weights, passes) by Newton steps, halved where they do not gain. Each pass over the rows sums what one step needs."""
    first = sum(sizes)
    width = first + len(centre) + 1
    penalty = np.ones(width)
    penalty[-1] = 0.0  # the intercept goes free
    at, before, step, reached = np.zeros(width), None, None, np.inf
    for passes in range(1, max_iter + 1):
        sums = _sums(coded, sizes, shares, centre, factor, at)
        loss = (sums[0] + (penalty * at * at).sum() / 2) / total
        if not loss <= reached * (1 + 1e-12):
            step = step / 2
            at = before + step
            continue
        gradient = (sums[1 : 1 + width] + penalty * at) / total
        hessian = sums[1 + width :].reshape(width, width)
        upper = np.triu(hessian)
        hessian = (upper + np.triu(hessian, 1).T + np.diag(penalty)) / total
        step = -np.linalg.solve(hessian, gradient)
        at, before, reached = at + step, at, loss
        # what the step gains; what would follow it is of the order of its square
        if -(gradient @ step) / 2 < TOLERANCE * loss:
            return at.tolist(), passes
    raise RuntimeError(f"the logistic model has not converged after {max_iter} iterations")


def _by_gradients(coded: DataFrame, sizes, shares, centre, factor, total: int, max_iter: int) -> tuple[list[float], int]:
    """(weights, passes) by Spark's logistic regression, for models too wide for products of features."""
    codes = [f"c{i}" for i in range(len(sizes))]
    scaled = [((F.col(f"x{k}") - m) * f).alias(f"x{k}") for k, (m, f) in enumerate(zip(centre, factor))]
    weight = F.when(F.col("y") == 1, shares[1]).otherwise(shares[0]).alias("w")
    stages = [OneHotEncoder(inputCols=codes, outputCols=[f"v{i}" for i in range(len(sizes))], dropLast=False)] if codes else []
    stages += [
        VectorAssembler(inputCols=[f"v{i}" for i in range(len(sizes))] + [f"x{k}" for k in range(len(centre))], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="y", weightCol="w", standardization=False,
                           regParam=1.0 / total, maxIter=max_iter, tol=TOLERANCE),
    ]
    with kept(coded.select("y", *codes, *scaled, weight)) as data:
        fitted = Pipeline(stages=stages).fit(data).stages[-1]
    if fitted.summary.totalIterations >= max_iter:
        raise RuntimeError(f"the logistic model has not converged after {max_iter} iterations")
    return [*map(float, fitted.coefficients.toArray()), float(fitted.intercept)], fitted.summary.totalIterations


def propensity_fit(
    train: DataFrame,
    label: str = "return_flag",
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
    min_frequency: int = 20,
    scaler: str = "robust",
    max_iter: int = 1000,
) -> PropensityModel:
    """Class-balanced L2 logistic regression on one-hot and scaled features.

    Levels under ``min_frequency`` training rows share one column; a level not
    seen in training carries no weight. The rows are coded and written once; a
    few passes over them fit the model, and only sums per feature and pair of
    features leave the tasks. Raises unless the fit converges within
    ``max_iter``. The penalty equals that of a unit
    inverse strength on summed losses.
    """
    levels = level_table(train, categorical, min_frequency)
    blank = [F.max(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(categorical)]
    classes = train.groupBy(F.col(label).cast("double").alias("y")).agg(F.count("*").alias("n"), *blank).collect()
    counts = {r["y"]: r["n"] for r in classes}
    if not counts or not set(counts) <= {0.0, 1.0}:
        raise ValueError(f"{label} must be 0 or 1 and have rows, not {sorted(counts, key=str)}")
    total = sum(counts.values())
    folded = F.when(F.col("rare"), INFREQUENT).otherwise(F.col("level")).alias("level")
    seen = levels.select("name", folded).distinct().collect()  # as wide as the model
    own = [{r["level"] for r in seen if r["name"] == c} | ({MISSING} if any(r[f"n{i}"] for r in classes) else set()) for i, c in enumerate(categorical)]
    known = [sorted(x, key=lambda level: level.encode("utf-16-be")) for x in own]
    coded = _coded(train, levels, known, label, categorical, numeric)
    columns = [f"x{k}" for k in range(len(numeric))]
    if scaler == "robust":
        edges = exact_quantiles(coded, columns, (0.25, 0.5, 0.75))
        centre, scale = [e[1] for e in edges], [e[2] - e[0] for e in edges]
    else:
        stats = coded.agg(F.count("*"), *[f(c) for c in columns for f in (F.avg, F.stddev)]).first()[1:]
        centre, scale = [float(m) for m in stats[::2]], [float(d or 0.0) for d in stats[1::2]]
    if len(counts) == 1:  # nothing to tell apart: no weights, and an intercept without bound
        fitted, passes = [0.0] * (sum(map(len, known)) + len(numeric)) + [np.inf if 1.0 in counts else -np.inf], 0
    else:
        shares = {int(y): total / (len(counts) * n) for y, n in counts.items()}
        sizes, factor = [len(x) for x in known], [1 / s if s else 0.0 for s in scale]
        fit = _by_products if sum(sizes) + len(numeric) < MOST_FEATURES else _by_gradients
        fitted, passes = fit(coded, sizes, shares, centre, factor, total, max_iter)
    return PropensityModel(levels, categorical, numeric, label, known, centre, scale, fitted, passes)


def split_by_date(features: DataFrame, cut: dt.date) -> tuple[DataFrame, DataFrame]:
    return features.filter(F.col("order_date") < F.lit(cut)), features.filter(F.col("order_date") >= F.lit(cut))


def split_stratified(features: DataFrame, key: str, label: str, share: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """Repeatable split that takes exactly the rounded ``share`` of each class, at any partitioning.

    Rows are ordered by an integer draw from their whole-number key, then by the
    key. Per class the last row to take is found by running totals over cells of
    the draw, then among the rows of one cell. Copies of one key stay together, so
    they can move a count; a null key counts as 0, null labels are one class.
    """
    number = F.coalesce(F.col(key).cast("bigint"), F.lit(0))
    place = F.struct((F.pmod(number, F.lit(DRAWS)) * 48271 % DRAWS).alias("draw"), number.alias("key"))
    kind = F.coalesce(F.col(label).cast("string"), F.lit(""))
    slots = features.select(kind.alias("kind"), place.alias("place"))
    cell = F.floor(F.col("place.draw") / DRAW_CELL)
    cells = slots.groupBy("kind", cell.alias("cell")).agg(F.count("*").alias("n"))
    sizes = cells.groupBy("kind").agg(F.round(F.sum("n") * share).alias("wanted"))
    before = running_totals(cells, ["kind"], "cell", ["n"], (lambda c: F.floor(c / 1024),)).join(sizes, "kind")
    edge_cell = before.filter((F.col("n_before") < F.col("wanted")) & (F.col("wanted") <= F.col("n_before") + F.col("n")))
    inside = (
        slots.withColumn("cell", cell)
        .join(edge_cell.select("kind", "cell", "n_before", "wanted"), ["kind", "cell"])
        .groupBy("kind", "place", "n_before", "wanted")
        .agg(F.count("*").alias("n"))
    )
    upto = Window.partitionBy("kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        inside.withColumn("reached", F.col("n_before") + F.sum("n").over(upto))
        .filter(F.col("reached") >= F.col("wanted"))
        .groupBy("kind")
        .agg(F.min("place").alias("place"))
    )
    # a row per class, written once: both parts, and all that is done with them, would search them again
    edges = shared_table(last, "split-edges").agg(F.map_from_entries(F.collect_list(F.struct("kind", "place")))).scalar()
    taken = F.coalesce(place <= F.col("_edges")[kind], F.lit(False))
    drawn = features.withColumn("_edges", edges).withColumn("_taken", taken)
    return (
        drawn.filter(~F.col("_taken")).select(*features.columns),
        drawn.filter(F.col("_taken")).select(*features.columns),
    )


def risk_deciles(scored: DataFrame, score: str = "return_probability", parts: int = 10, name: str = "risk_decile") -> DataFrame:
    """Equal-frequency buckets on exact score quantiles, right-closed."""
    edges = percentile_edges(scored, score, parts, FINE_CELLS)
    return scored.withColumn("_edges", edges).withColumn(name, bucket_of(F.col(score), F.col("_edges"))).drop("_edges")


def decile_lift(deciles: DataFrame, score: str = "return_probability", label: str = "return_flag") -> DataFrame:
    """Observed rate per decile against the overall rate of the same rows."""
    sums = deciles.groupBy("risk_decile").agg(
        F.count("*").alias("items"),
        flag_sum(label).alias("returned_items"),
        F.avg(score).alias("avg_predicted_probability"),
        ratio(flag_sum(label), F.count("*")).alias("observed_return_rate"),
    )
    base = deciles.agg(ratio(flag_sum(label), F.count("*"))).scalar()
    return sums.withColumn("_base", base).select(
        *sums.columns, ratio("observed_return_rate", "_base").alias("lift_vs_baseline")
    )


def classifier_metrics(scored: DataFrame, score: str = "return_probability", label: str = "return_flag") -> DataFrame:
    """ROC AUC, average precision (step rule) and Brier score.

    Rows are counted per score, and the cumulative counts come from running
    totals over score cells.
    """
    positive = F.when(F.col(label) == 1, 1).otherwise(0)
    counts = scored.groupBy(F.col(score).alias("s")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    ranked = running_totals(counts, [], "s", ["pos", "neg"], FINE_CELLS).withColumn("_t", totals)
    p, n = F.col("_t.p").cast("double"), F.col("_t.n").cast("double")
    above_p, above_n = p - F.col("pos_before"), n - F.col("neg_before")
    s = F.col("s")
    return ranked.agg(
        F.sum(F.col("pos") / p * (F.col("neg_before") + F.col("neg") / 2) / n).alias("roc_auc"),
        F.sum(F.col("pos") / p * (above_p / (above_p + above_n))).alias("average_precision"),
        ratio(F.sum(F.col("pos") * (s - 1) * (s - 1) + F.col("neg") * s * s), F.sum(F.col("pos") + F.col("neg"))).alias(
            "brier_score"
        ),
    )


def confusion(scored: DataFrame, score: str = "return_probability", label: str = "return_flag", cut: float = 0.5) -> DataFrame:
    """Confusion counts with precision and recall of the positive class."""
    said, real = F.col(score) > cut, F.col(label) == 1
    return scored.agg(
        F.count_if(said & real).alias("true_positive"),
        F.count_if(said & ~real).alias("false_positive"),
        F.count_if(~said & real).alias("false_negative"),
        F.count_if(~said & ~real).alias("true_negative"),
    ).withColumns(
        {
            "precision": ratio(F.col("true_positive"), F.col("true_positive") + F.col("false_positive")),
            "recall": ratio(F.col("true_positive"), F.col("true_positive") + F.col("false_negative")),
        }
    )


def risk_bands(scored: DataFrame, score: str = "return_probability") -> DataFrame:
    """Low, Medium and High thirds of the score."""
    names = F.array(*[F.lit(x) for x in ("Low", "Medium", "High")])
    banded = risk_deciles(scored, score, 3, "_third")
    return banded.withColumn("risk_band", F.get(names, F.col("_third") - 1)).drop("_third")


def variant_features(items: DataFrame, products: DataFrame) -> DataFrame:
    """Eligible, delivered items for the second model."""
    wide = attach(items, products, "product_id", "product_id", ["category", "department", "price_band"])
    return wide.filter(
        (F.col("return_observation_eligible_flag") == 1) & F.col("delivery_lead_days").isNotNull()
    ).select(
        "order_item_id",
        F.col("returned_item_flag").alias("return_flag"),
        F.col("sale_price").cast("double").alias("sale_price"),
        "gross_margin_rate",
        "delivery_lead_days",
        "category",
        "department",
        "price_band",
        "acquisition_source",
    )
