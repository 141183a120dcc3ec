"""Monthly forecasts, rolling-origin backtest, scenarios and allocation.

A series is one row: its months folded into an array (one entry per calendar
month). Forecast formulas are array expressions, origins and steps are exploded
from it, and many series run side by side. Exponential smoothing folds its state
over that array; Python only searches the weights, on Arrow batches of (series,
origin) rows, and not at all where a table of weights is given.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.measures import exact_sum, money_sum, ratio
from ..functions.times import months_apart

SEASON = 12
ORIGINS = 24
MIN_TRAIN = 2 * SEASON + 1
DRIFT_RANGE = (0.5, 2.5)
NAIVE, DRIFT, SMOOTH = "seasonal_naive", "seasonal_naive_drift", "holt_winters_log"
MODELS = (NAIVE, DRIFT, SMOOTH)
# Scenario name, volume multiplier, margin change in points, assumption.
SCENARIOS = (
    ("Base", 1.00, 0.0, "Current trend continues; no change to pricing or promotion intensity."),
    ("Upside", 1.10, 0.5, "Peak-season sell-through runs 10% ahead with a modest mix benefit."),
    ("Downside", 0.90, -2.0, "Demand softens 10% and clearing aged stock costs 2 points of margin."),
)


def monthly_series(sales: DataFrame) -> DataFrame:
    """Complete months only."""
    return sales.filter(F.col("is_complete_month") == 1).select(
        "month_start", "net_sales_value", "net_margin_rate"
    )


def fold(series: DataFrame, by: Sequence[str] = (), value: str = "net_sales_value") -> DataFrame:
    """One row per series with its months and values in month order."""
    packed = series.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("month_start", F.col(value).cast("double").alias("v")))).alias("_s")
    )
    return packed.select(
        *by,
        F.transform("_s", lambda x: x["month_start"]).alias("months"),
        F.transform("_s", lambda x: x["v"]).alias("history"),
    )


def _at(array: str | Column, position: Column) -> Column:
    """Zero-based element; NULL outside the array."""
    return F.get(array, position.cast("int"))


def _naive(history: str, length: Column, step: Column) -> Column:
    """Value of the same month in the last season before the origin; step from 0."""
    return _at(history, length - SEASON + step % SEASON)


def _drift(history: str, length: Column) -> Column:
    recent, year_ago = _at(history, length - 1), _at(history, length - 1 - SEASON)
    held = F.greatest(F.lit(DRIFT_RANGE[0]), F.least(F.lit(DRIFT_RANGE[1]), ratio(recent, year_ago)))
    return F.when(length <= SEASON, 1.0).when(year_ago > 0, held).otherwise(F.lit(1.0))


def _run(y: np.ndarray, p: np.ndarray):
    """Smooth with several parameter rows at once: logits of the three weights, level, trend, season.

    Returns the one-step errors and the final level, trend and season of each row.
    """
    a, b, g = (0.001 + 0.998 / (1 + np.exp(-p[:, i])) for i in range(3))
    level, trend, season = p[:, 3].copy(), p[:, 4].copy(), p[:, 5:].copy()
    errors = np.empty((len(p), len(y)))
    for t, v in enumerate(y):
        s = season[:, t % SEASON].copy()
        errors[:, t] = v - (level + trend + s)
        before = level
        level = a * (v - s) + (1 - a) * (level + trend)
        trend = b * (level - before) + (1 - b) * trend
        season[:, t % SEASON] = g * (v - level) + (1 - g) * s
    return errors, level, trend, season


def _fit(y: np.ndarray) -> np.ndarray:
    """Weights and starting states with the least squared one-step error.

    The search starts from the best of a coarse grid of weights, with the first
    two seasons' means as states, and takes damped Gauss-Newton steps over all
    parameters until they gain nothing. No step makes the error larger.
    """
    level0 = y[:SEASON].mean()
    trend0 = (y[SEASON : 2 * SEASON].mean() - level0) / SEASON
    season0 = y[:SEASON] - level0 - trend0 * (np.arange(SEASON) - (SEASON - 1) / 2)
    states = np.concatenate(([level0 - trend0 * (SEASON + 1) / 2, trend0], season0))
    weights = np.stack(np.meshgrid(*[np.linspace(-5, 5, 6)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    grid = np.hstack((weights, np.tile(states, (len(weights), 1))))
    costs = (_run(y, grid)[0] ** 2).sum(axis=1)
    best, cost, damping = grid[int(np.argmin(costs))], float(costs.min()), 1e-3
    while damping < 1e9:
        step = 1e-6
        errors = _run(y, np.vstack((best, best + step * np.eye(best.size))))[0]
        slope = (errors[1:] - errors[0]).T / step
        normal, pull = slope.T @ slope, slope.T @ errors[0]
        moved = False
        while damping < 1e9:
            there = best - np.linalg.solve(normal + damping * (np.diag(np.diag(normal)) + 1e-9 * np.eye(best.size)), pull)
            there[:3] = np.clip(there[:3], -12, 12)
            now = float((_run(y, there[None, :])[0] ** 2).sum())
            if now < cost:
                moved = cost - now > 1e-7 * (cost + 1e-12)
                best, cost, damping = there, now, damping / 5
                break
            damping *= 4
        if not moved:
            break
    return best


FIT = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in ("alpha", "beta", "gamma", "level", "trend")]
    + [T.StructField("season", T.ArrayType(T.DoubleType()))]
)


@F.pandas_udf(FIT)
def _fitted(logs: pd.Series) -> pd.DataFrame:
    """Weights and starting states of each array of log values."""
    rows = []
    for y in logs:
        p = _fit(np.asarray(y, dtype=float))
        rows.append([*(0.001 + 0.998 / (1 + np.exp(-p[:3]))).tolist(), float(p[3]), float(p[4]), p[5:].tolist()])
    return pd.DataFrame(rows, columns=["alpha", "beta", "gamma", "level", "trend", "season"])


def _logs(history: str | Column) -> Column:
    return F.transform(history, lambda x: F.log(F.greatest(x, F.lit(1.0))))


def _mean(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda total, x: total + x) / F.size(array)


def starting_state(logs: Column) -> Column:
    """Level, trend and season before the first month, from the means of the first two seasons."""
    first, second = _mean(F.slice(logs, 1, SEASON)), _mean(F.slice(logs, SEASON + 1, SEASON))
    trend = (second - first) / SEASON
    season = F.transform(F.slice(logs, 1, SEASON), lambda x, i: x - first - trend * (i - F.lit((SEASON - 1) / 2)))
    return F.struct((first - trend * ((SEASON + 1) / 2)).alias("level"), trend.alias("trend"), season.alias("season"))


def smoothed(logs: Column, fit: Column, finish) -> Column:
    """Fold level, trend and season over log values and hand the last state to ``finish``.

    The season is a queue: its head is the month at hand, and the renewed value
    goes to the end. ``error`` is the sum of squared one-step errors.
    """
    a, b, g = fit["alpha"], fit["beta"], fit["gamma"]

    def step(state: Column, y: Column) -> Column:
        s, level, trend = F.get(state["season"], F.lit(0)), state["level"], state["trend"]
        now = a * (y - s) + (1 - a) * (level + trend)
        miss = y - (level + trend + s)
        return F.struct(
            now.alias("level"),
            (b * (now - level) + (1 - b) * trend).alias("trend"),
            F.concat(F.slice(state["season"], 2, SEASON - 1), F.array(g * (y - now) + (1 - g) * s)).alias("season"),
            (state["error"] + miss * miss).alias("error"),
        )

    zero = F.struct(
        fit["level"].alias("level"), fit["trend"].alias("trend"), fit["season"].alias("season"), F.lit(0.0).alias("error")
    )
    return F.aggregate(logs, zero, step, finish)


def _smooth_path(logs: Column, fit: Column, horizon: Column) -> Column:
    return smoothed(
        logs,
        fit,
        lambda state: F.transform(
            F.sequence(F.lit(1), horizon),
            lambda k: F.exp(state["level"] + state["trend"] * k + F.get(state["season"], (k - 1) % SEASON)),
        ),
    )


def _with_fit(rows: DataFrame, weights: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """Add ``_fit``: the searched weights of every row, or those of the given table."""
    logs = F.col("_logs")
    if weights is None:
        return rows.withColumn("_fit", _fitted(logs))
    names = ["alpha", "beta", "gamma"]
    stored = ["level", "trend", "season"] if "season" in weights.columns else []
    packed = weights.select(*by, F.struct(*[F.col(c) for c in names + stored]).alias("_w"))
    joined = rows.join(packed, list(by), "left") if by else rows.withColumn("_w", packed.scalar())
    start = F.col("_w") if stored else starting_state(logs)
    fit = F.struct(
        *[F.col("_w")[c].alias(c) for c in names], *[start[c].alias(c) for c in ("level", "trend", "season")]
    )
    return joined.withColumn("_fit", fit).drop("_w")


def smoothing_weights(series: DataFrame, by: Sequence[str] = (), value: str = "net_sales_value") -> DataFrame:
    """The searched weights and starting states, one row per series of at least ``MIN_TRAIN`` months."""
    rows = fold(series, by, value).filter(F.size("history") >= MIN_TRAIN).withColumn("_logs", _logs("history"))
    return _with_fit(rows, None, by).select(*by, "_fit.*")


def smoothing_error(
    series: DataFrame, weights: DataFrame, by: Sequence[str] = (), value: str = "net_sales_value"
) -> DataFrame:
    """Months and squared one-step error of log values of every series under each row of its weights.

    A weights table may hold several candidates per series.
    """
    rows = fold(series, by, value).filter(F.size("history") >= MIN_TRAIN).withColumn("_logs", _logs("history"))
    names = [c for c in ("alpha", "beta", "gamma", "level", "trend", "season") if c in weights.columns]
    sets = weights.groupBy(*by).agg(F.collect_list(F.struct(*names)).alias("_w"))
    joined = rows.join(sets, list(by)) if by else rows.withColumn("_w", sets.scalar())
    one = joined.select("*", F.explode("_w").alias("_one")).withColumn("_start", starting_state(F.col("_logs")))
    start = F.col("_one" if "season" in names else "_start")
    fit = F.struct(
        *[F.col("_one")[c].alias(c) for c in names[:3]], *[start[c].alias(c) for c in ("level", "trend", "season")]
    )
    return one.withColumn("_fit", fit).select(
        *by,
        *[F.col("_one")[c].alias(c) for c in names[:3]],
        F.size("_logs").alias("months"),
        smoothed(F.col("_logs"), F.col("_fit"), lambda state: state["error"]).alias("squared_error"),
    )


def _predictions(rows: DataFrame, models: Sequence[str], by: Sequence[str], weights: DataFrame | None) -> DataFrame:
    """Add one forecast path per model; ``rows`` has history, n (training length) and horizon."""
    n = F.col("n")
    steps = F.sequence(F.lit(0), F.col("horizon") - 1)
    naive = F.transform(steps, lambda s: _naive("history", n, s))
    drift = F.transform(steps, lambda s: _naive("history", n, s) * _drift("history", n))
    paths = {NAIVE: naive, DRIFT: drift}
    if SMOOTH in models:
        enough = n >= MIN_TRAIN
        # short series never reach the fit: they are cut to nothing and take the drift path
        fits = _with_fit(rows.filter(enough).withColumn("_logs", _logs(F.slice("history", 1, n))), weights, by)
        fits = fits.withColumn("_p", _smooth_path(F.col("_logs"), F.col("_fit"), F.col("horizon"))).drop("_logs", "_fit")
        rows = fits.unionByName(rows.filter(~enough).withColumn("_p", drift))
        paths[SMOOTH] = F.col("_p")
    packed = F.array(*[F.struct(F.lit(m).alias("model"), paths[m].alias("path")) for m in models])
    return rows.select("*", F.inline(packed)).drop("_p")


def forecast(
    series: DataFrame,
    end: dt.date,
    models: Sequence[str] = MODELS,
    by: Sequence[str] = (),
    value: str = "net_sales_value",
    weights: DataFrame | None = None,
) -> DataFrame:
    """Forecast of every model from the month after the last one to ``end``.

    ``weights`` holds one row per series: ``by``, alpha, beta, gamma and, where
    kept from a fit, level, trend and season. Without it they are searched.
    """
    last = F.element_at("months", -1)
    rows = fold(series, by, value).select(
        *by,
        "history",
        last.alias("last_month"),
        F.size("history").alias("n"),
        months_apart(last, F.lit(end)).alias("horizon"),
    ).filter(F.col("horizon") > 0)
    return _predictions(rows, models, by, weights).select(
        *by, "model", "last_month", F.posexplode("path").alias("step", "forecast_net_sales_usd")
    ).select(
        *by,
        "model",
        F.expr("add_months(last_month, step + 1)").alias("month_start"),
        (F.col("step") + 1).alias("step"),
        "forecast_net_sales_usd",
    )


def backtest(
    series: DataFrame,
    end: dt.date | None = None,
    horizon: int | None = None,
    origins: int = ORIGINS,
    models: Sequence[str] = MODELS,
    by: Sequence[str] = (),
    value: str = "net_sales_value",
    weights: DataFrame | None = None,
) -> DataFrame:
    """Every step of every origin scored at the production horizon.

    The horizon is given, or runs to ``end``. ``origin_month`` is the first
    forecast month. A series too short to be tested raises an error. Given
    ``weights`` serve all origins of a series; without them each origin is fitted
    on its own past.
    """
    if (end is None) == (horizon is None):
        raise ValueError("give either end or horizon")
    size = F.size("history")
    span = F.lit(horizon) if horizon is not None else months_apart(F.element_at("months", -1), F.lit(end))
    largest = F.least(F.lit(origins) + F.col("horizon") - 1, size - MIN_TRAIN)
    offsets = F.when(largest >= F.col("horizon"), F.sequence("horizon", largest)).otherwise(
        F.raise_error(F.concat(F.lit("series is too short for this backtest: months = "), size)).cast("array<int>")
    )
    folded = fold(series, by, value).withColumn("horizon", span.cast("int"))
    rows = folded.withColumn("offset", F.explode(offsets)).withColumn("n", size - F.col("offset"))
    spread = rows.repartition(*by, "offset") if SMOOTH in models and weights is None else rows
    scored = _predictions(spread, models, by, weights).select("*", F.posexplode("path").alias("i", "predicted"))
    actual = _at("history", F.col("n") + F.col("i"))
    return scored.select(
        *by,
        "model",
        _at("months", F.col("n")).alias("origin_month"),
        _at("months", F.col("n") + F.col("i")).alias("target_month"),
        (F.col("i") + 1).alias("step"),
        actual.alias("actual"),
        "predicted",
        ratio(F.abs(F.col("predicted") - actual), actual).alias("absolute_percentage_error"),
        "horizon",
    )


def forecast_accuracy(detail: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    ape, step = F.col("absolute_percentage_error"), F.col("step")
    return detail.groupBy(*by, "model").agg(
        F.avg(ape).alias("mape"),
        F.avg(F.when(step == 1, ape)).alias("mape_first_step"),
        F.avg(F.when(step == F.col("horizon"), ape)).alias("mape_final_step"),
        F.max(ape).alias("worst_month_ape"),
        F.avg(ratio("predicted", "actual") - 1).alias("bias"),
        F.max("horizon").alias("horizon"),
        F.countDistinct("origin_month").alias("origins"),
        F.count("*").alias("folds"),
    )


def alt_errors(detail: DataFrame) -> DataFrame:
    """Symmetric MAPE, relative RMSE and median APE per model."""
    p, a = F.col("predicted"), F.col("actual")
    return detail.groupBy("model").agg(
        F.avg(ratio(2 * F.abs(p - a), F.abs(p) + F.abs(a))).alias("smape"),
        (F.sqrt(F.avg((p - a) * (p - a))) / F.avg(a)).alias("rmse_pct"),
        F.percentile("absolute_percentage_error", 0.5).alias("median_ape"),
    )


def horizon_decay(detail: DataFrame) -> DataFrame:
    """Mean error in percent by step, one column per model."""
    ape = F.col("absolute_percentage_error")
    return detail.groupBy("step").agg(
        *[F.round(F.avg(F.when(F.col("model") == m, ape)) * 100, 1).alias(f"{m}_pct") for m in MODELS],
        F.count("*").alias("folds"),
    )


def champion(accuracy: DataFrame) -> Column:
    """Name of the model with the lowest error, as a scalar."""
    return accuracy.agg(F.min_by("model", "mape")).scalar()


def forecast_monthly(all_models: DataFrame, best: Column) -> DataFrame:
    return (
        all_models.withColumn("_best", best)
        .filter(F.col("model") == F.col("_best"))
        .select("month_start", "forecast_net_sales_usd", "model")
    )


def forecast_scenarios(monthly: DataFrame, series: DataFrame, scenarios=SCENARIOS) -> DataFrame:
    """Volume and margin cases; profit uses the last known margin plus the change."""
    margin = series.agg(F.max_by("net_margin_rate", "month_start")).scalar()
    cases = [
        F.struct(
            F.lit(n).alias("scenario"), F.lit(v).alias("volume_multiplier"), F.lit(d).alias("margin_delta_pp"),
            F.lit(t).alias("narrative"),
        )
        for n, v, d, t in scenarios
    ]
    value = F.col("base") * F.col("volume_multiplier")
    rate = F.col("_margin") + F.col("margin_delta_pp") / 100.0
    return (
        monthly.select("month_start", F.col("forecast_net_sales_usd").alias("base"), F.inline(F.array(*cases)))
        .withColumn("_margin", margin)
        .select(
            "scenario",
            "month_start",
            value.alias("forecast_net_sales_usd"),
            rate.alias("assumed_margin_rate"),
            (value * rate).alias("forecast_net_profit_usd"),
            "volume_multiplier",
            "margin_delta_pp",
            "narrative",
        )
    )


def forecast_country_month(monthly: DataFrame, actuals: DataFrame, trailing: int = 6) -> DataFrame:
    """Top-down split by each market's share of the trailing complete months."""
    done = actuals.filter(F.col("is_complete_month") == 1)
    latest = done.agg(F.max("month_start")).scalar()
    recent = (
        done.withColumn("_latest", latest)
        .filter(F.col("month_start") > F.add_months("_latest", -trailing))
        .groupBy("canonical_country")
        .agg(exact_sum("net_sales_value").alias("trailing"))
    )
    total = recent.agg(F.sum("trailing")).scalar()
    path = monthly.agg(F.collect_list(F.struct("month_start", F.col("forecast_net_sales_usd").alias("total")))).scalar()
    share = ratio("trailing", "_all")
    return (
        recent.withColumns({"_all": total, "_path": path})
        .select("canonical_country", share.alias("allocation_share"), F.inline("_path"))
        .select(
            "month_start",
            "canonical_country",
            "allocation_share",
            (F.col("total") * F.col("allocation_share")).alias("forecast_net_sales_usd"),
        )
    )


def allocation_tie(monthly: DataFrame, allocation: DataFrame) -> DataFrame:
    """The market split added back up, next to the total."""
    back = allocation.groupBy("month_start").agg(F.sum("forecast_net_sales_usd").alias("allocated"))
    joined = monthly.select("month_start", F.col("forecast_net_sales_usd").alias("total")).join(back, "month_start")
    return joined.select(
        "month_start",
        F.round("total", 2).alias("total"),
        F.round("allocated", 2).alias("allocated_to_markets"),
        F.round(F.col("allocated") - F.col("total"), 6).alias("delta"),
    )


def forecast_vs_plan(plan: DataFrame, monthly: DataFrame, actuals: DataFrame) -> DataFrame:
    """Actual where known, else forecast, against plan from the first plan month on."""
    p = plan.groupBy("plan_month").agg(exact_sum("plan_net_sales_usd").cast("double").alias("plan_net_sales_usd"))
    f = monthly.select(F.col("month_start").alias("f_month"), "forecast_net_sales_usd")
    a = (
        actuals.filter(F.col("is_complete_month") == 1)
        .groupBy(F.col("month_start").alias("a_month"))
        .agg(exact_sum("net_sales_value").cast("double").alias("actual_net_sales_usd"))
    )
    first = plan.agg(F.min("plan_month")).scalar()
    chain = p.join(f, F.col("plan_month") == F.col("f_month"), "outer").join(
        a, F.col("plan_month") == F.col("a_month"), "outer"
    )
    actual, target = F.col("actual_net_sales_usd"), F.col("plan_net_sales_usd")
    expected = F.coalesce(actual, F.col("forecast_net_sales_usd"))
    return (
        chain.withColumn("month_start", F.coalesce("plan_month", "f_month", "a_month"))
        .withColumn("_first", first)
        .filter(F.col("month_start") >= F.col("_first"))
        .select(
            "month_start",
            "actual_net_sales_usd",
            "forecast_net_sales_usd",
            expected.alias("expected_net_sales_usd"),
            "plan_net_sales_usd",
            F.when(actual.isNotNull(), "Actual").otherwise("Forecast").alias("basis"),
            (expected - target).alias("gap_to_plan_usd"),
            F.when(target > 0, expected / target).alias("expected_achievement_rate"),
        )
    )


def landing_achievement(outlook: DataFrame) -> DataFrame:
    """Expected against plan over the months that have a plan."""
    return (
        outlook.filter(F.col("plan_net_sales_usd").isNotNull())
        .agg(
            money_sum("expected_net_sales_usd").alias("expected_full_period"),
            money_sum("plan_net_sales_usd").alias("plan_full_period"),
        )
        .withColumn("achievement", ratio("expected_full_period", "plan_full_period"))
    )
