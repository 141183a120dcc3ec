"""Concentration, ranks, rules, forecasts and models against brute force."""

import datetime as dt
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import associations, concentration, experiments, forecasting, profiling, propensity, ranking, segmentation
from ledgerline.plans import catalog, queries_analytics

LIGHT = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


def money(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double").select(F.col("v").cast("decimal(18,4)").alias("v"))


def plain_gini(values):
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    return (2 * (np.arange(1, n + 1) * x).sum() - (n + 1) * x.sum()) / (n * x.sum())


@pytest.mark.parametrize("values, want", [([10] * 4, 0.0), ([0, 0, 0, 100], 0.75), ([8, 9, 10, 13], None), ([1, 1, 2, 2, 2, 50], None)])
def test_gini_known(spark, values, want):
    got = concentration.gini(money(spark, values), "v").first().gini
    assert got == pytest.approx(plain_gini(values) if want is None else want)


@LIGHT
@given(st.lists(st.integers(0, 30000), min_size=1, max_size=40).filter(lambda v: sum(v) > 0))
def test_gini_lorenz_top_share(spark, values):
    df = money(spark, values)
    g = concentration.gini(df, "v").first().gini
    assert g == pytest.approx(plain_gini(values), abs=1e-9) and -1e-12 <= g < 1
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    got = {r.point: r for r in concentration.lorenz(df, "v", 10).collect()}
    for k in range(1, 11):
        m = n * k // 10
        if m:
            assert got[k].value_share == pytest.approx(x[:m].sum() / x.sum())
    share = concentration.top_share(df, "v", [0.1]).first().value_share
    assert share == pytest.approx(x[int(n * 0.9):].sum() / x.sum())


@LIGHT
@given(st.lists(st.floats(-1000, 1000, width=32), min_size=1, max_size=50))
def test_percentiles_with_and_without_cells(spark, values):
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 1.0)], "k string, v double")
    for cells in ((), (lambda v: F.floor(v), lambda c: F.floor(c / 10))):
        got = {r.k: r for r in ranking.percentiles(df, ["k"], {"m": ("v", 0.5), "p": ("v", 0.9)}, cells).collect()}
        assert got["a"].m == pytest.approx(np.quantile(values, 0.5)) and got["a"].p == pytest.approx(np.quantile(values, 0.9))
        assert got["b"].m == 1.0


@LIGHT
@given(st.lists(st.sampled_from([0.1, 0.2, 0.25, 0.5, 0.9, 0.91]), min_size=3, max_size=40), st.integers(2, 10))
def test_buckets_match_brute_force(spark, values, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s double")
    got = {r.i: r.d for r in propensity.risk_deciles(df, "s", parts, "d").collect()}
    x, edges = sorted(values), set()
    for k in range(1, parts):
        place = k / parts * (len(x) - 1)
        lo, hi = x[int(np.floor(place))], x[int(np.ceil(place))]
        edges.add(lo + (hi - lo) * (place - np.floor(place)))
    edges = [e for e in edges if e > x[0]]
    assert [got[i] for i in range(len(values))] == [1 + sum(e < v for e in edges) for v in values]


def test_buckets_follow_qcut(spark):
    rng = random.Random(11)
    values = [round(rng.random(), 3) for _ in range(203)] + [0.0] * 60
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s double")
    got = {r.i: r.d for r in propensity.risk_deciles(df, "s", 10, "d").collect()}
    want = pd.qcut(pd.Series(values), 10, labels=False, duplicates="drop") + 1
    assert [got[i] for i in range(len(values))] == want.tolist()


def test_classifier_metrics(spark):
    rng = random.Random(1)
    rows = [(round(rng.random(), 2), rng.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "return_probability double, return_flag int")
    got = propensity.classifier_metrics(df).first()
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for cut in sorted({s for s, _ in rows}, reverse=True):
        kept = [y for s, y in rows if s >= cut]
        recall = sum(kept) / len(pos)
        ap, last = ap + (recall - last) * sum(kept) / len(kept), recall
    assert got.roc_auc == pytest.approx(auc) and got.average_precision == pytest.approx(ap)
    assert got.brier_score == pytest.approx(sum((s - y) ** 2 for s, y in rows) / len(rows))


def test_rules_match_brute_force_with_a_hot_order(spark):
    rng = random.Random(3)
    rows = [(1 if i % 3 == 0 else rng.randint(2, 60), rng.choice("ABCDE")) for i in range(600)]
    df = spark.createDataFrame(rows, "order_id long, category string").withColumns({"net_sales_value": F.lit(1), "product_id": F.lit(1)})
    got = {(r.antecedent, r.consequent): r for r in associations.basket_rules(df, df, 5).collect()}
    sets = {}
    for o, c in rows:
        sets.setdefault(o, set()).add(c)
    for a, b in itertools.permutations("ABCDE", 2):
        n = sum(a in s and b in s for s in sets.values())
        na, nb = (sum(x in s for s in sets.values()) for x in (a, b))
        assert ((a, b) in got) == (n >= 5)
        if n >= 5:
            r = got[(a, b)]
            assert (r.pair_orders, r.eligible_orders) == (n, len(sets))
            assert r.lift == pytest.approx((n / na) / (nb / len(sets)))


def test_chi_square(spark):
    table = {("a", 0): 10, ("a", 1): 20, ("b", 0): 30, ("b", 1): 5, ("c", 0): 12}
    rows = [(k, f) for (k, f), n in table.items() for _ in range(n)]
    r = experiments.chi_square_independence(spark.createDataFrame(rows, "k string, f int"), "k", "f").first()
    o = np.array([[10, 20], [30, 5], [12, 0]], dtype=float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    assert r.chi_square == pytest.approx(((o - e) ** 2 / e).sum()) and r.dof == 2
    assert r.p_value == pytest.approx(np.exp(-r.chi_square / 2))  # exact for two degrees of freedom


def test_chi_square_two_by_two_is_corrected(spark):
    rows = [("a", 0)] * 8 + [("a", 1)] * 4 + [("b", 0)] * 3 + [("b", 1)] * 9
    r = experiments.chi_square_independence(spark.createDataFrame(rows, "k string, f int"), "k", "f").first()
    e = np.array([[5.5, 6.5], [5.5, 6.5]])
    assert r.chi_square == pytest.approx(((np.abs(np.array([[8, 4], [3, 9]]) - e) - 0.5) ** 2 / e).sum())


def chi2_sums(x, dof):
    half = x / 2
    start = dof % 2 / 2
    terms = [math.exp((start + k) * math.log(half) - half - math.lgamma(start + k + 1)) for k in range(dof // 2)]
    return sum(terms) + (math.erfc(math.sqrt(half)) if dof % 2 else 0.0)


def test_chi2_tail(spark):
    known = [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (11.070497693516351, 5, 0.05)]
    grid = [(x, d, chi2_sums(x, d)) for d in (1, 2, 3, 4, 9, 24, 301) for x in (1e-9, 0.3, 2.0, 5.99, 6.01, 40.0, 310.0, 900.0)]
    edges = [(0.0, 3, 1.0), (0.0, 2, 1.0), (-1.0, 4, 1.0)]
    df = spark.createDataFrame(known + grid + edges, "x double, d int, p double")
    for r in df.select("*", experiments.chi2_tail(F.col("x"), F.col("d")).alias("got")).collect():
        assert r.got == pytest.approx(r.p, rel=1e-9, abs=1e-300), r
    odd = spark.createDataFrame([(None, 1), (1.0, None), (1.0, 0), (float("nan"), 2)], "x double, d int")
    assert all(math.isnan(r[0]) for r in odd.select(experiments.chi2_tail(F.col("x"), F.col("d"))).collect())


def test_kruskal(spark):
    rng = random.Random(5)
    rows = [(g, float(rng.randint(0, 6)) + (0.5 if g == 2 else 0)) for g in (1, 2, 3) for _ in range(40)]
    rows += [(4, 1.0)] * 29  # too small, left out
    r = experiments.kruskal_wallis(spark.createDataFrame(rows, "g int, v double"), "g", "v").first()
    x = pd.DataFrame([t for t in rows if t[0] != 4], columns=["g", "v"])
    x["r"] = x.v.rank()
    n = len(x)
    h = 12 / (n * (n + 1)) * sum(k.r.sum() ** 2 / len(k) for _, k in x.groupby("g")) - 3 * (n + 1)
    t = x.v.value_counts()
    assert r.groups == 3 and r.observations == n
    assert r.statistic == pytest.approx(h / (1 - (t**3 - t).sum() / (n**3 - n)))


def series(spark, values, start=(2020, 1)):
    months = [dt.date(start[0] + (start[1] - 1 + i) // 12, (start[1] - 1 + i) % 12 + 1, 1) for i in range(len(values))]
    return spark.createDataFrame([(m, float(v), 0.4) for m, v in zip(months, values)], "month_start date, net_sales_value double, net_margin_rate double"), months


def later(month, n):
    k = month.year * 12 + month.month - 1 + n
    return dt.date(k // 12, k % 12 + 1, 1)


@pytest.mark.parametrize("values, drift", [
    (list(range(100, 112)), 1.0),                       # 12 months: plain naive
    ([100] * 12 + [150] * 12, 1.5),
    ([100] * 12 + [900] * 12, 2.5),                     # held at the top
    ([100] * 12 + [10] * 12, 0.5),                      # held at the bottom
    ([0] * 12 + [5] * 12, 1.0),                         # year ago is zero
])
def test_drift(spark, values, drift):
    df, months = series(spark, values)
    got = forecasting.forecast(df, later(months[-1], 14), [forecasting.DRIFT]).orderBy("step").collect()
    last = values[-12:]
    assert [r.forecast_net_sales_usd for r in got] == pytest.approx([last[i % 12] * drift for i in range(14)])
    assert got[0].month_start == later(months[-1], 1)


def test_smoothing_falls_back_and_follows_a_season(spark):
    short, months = series(spark, list(range(100, 124)))
    got = {r.model: r.forecast_net_sales_usd for r in forecasting.forecast(short, later(months[-1], 1)).collect()}
    assert got[forecasting.SMOOTH] == got[forecasting.DRIFT]
    shape = [1 + 0.3 * np.sin(2 * np.pi * i / 12) for i in range(40)]
    long, months = series(spark, [1000 * 1.01**i * s for i, s in enumerate(shape)])
    path = forecasting.forecast(long, later(months[-1], 6), [forecasting.SMOOTH]).orderBy("step").collect()
    want = [1000 * 1.01**i * (1 + 0.3 * np.sin(2 * np.pi * i / 12)) for i in range(40, 46)]
    assert [r.forecast_net_sales_usd for r in path] == pytest.approx(want, rel=0.05)


def test_backtest_layout(spark):
    df, months = series(spark, [100 + i for i in range(40)])
    d = forecasting.backtest(df, horizon=3, models=forecasting.MODELS)
    # 40 months leave offsets 15 .. 3
    assert d.select("origin_month").distinct().count() == 13 and d.count() == 3 * 13 * 3
    first = d.filter("model = 'seasonal_naive'").orderBy("origin_month", "step").first()
    assert (first.origin_month, first.target_month, first.actual, first.predicted) == (months[25], months[25], 125.0, 113.0)
    acc = {r.model: r for r in forecasting.forecast_accuracy(d).collect()}
    assert all(r.folds == 39 and r.origins == 13 for r in acc.values())
    with pytest.raises(Exception, match="too short"):
        forecasting.backtest(series(spark, [1] * 26)[0], horizon=3).collect()
    with pytest.raises(ValueError):
        forecasting.backtest(df)


def test_backtest_many_series(spark):
    a, _ = series(spark, [100 + i for i in range(30)])
    b, _ = series(spark, [5] * 30)
    both = a.withColumn("k", F.lit("a")).unionByName(b.withColumn("k", F.lit("b")))
    acc = {(r.k, r.model): r.mape for r in forecasting.forecast_accuracy(
        forecasting.backtest(both, horizon=2, models=[forecasting.NAIVE], by=["k"]), ["k"]).collect()}
    assert acc[("b", forecasting.NAIVE)] == 0 and acc[("a", forecasting.NAIVE)] > 0


def test_profiling_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None)], "k int, v string")
    g = profiling.grain(df, "k", "v").first()
    assert (g["rows"], g.distinct_keys, g.duplicates, g.verdict) == (5, 3, 2, profiling.REPEATED)
    assert [r["rows"] for r in profiling.duplicates(df, "k", "v").collect()] == [2, 2]
    other = spark.createDataFrame([(9,), (None,)], "k int")
    o = profiling.overlap(df, "k", other, "k").first()
    assert tuple(o) == (2, 1, 0, 2, 1)
    assert [r[0] for r in profiling.unmatched(df, "k", other, "k").collect()] == [1, 2]
    exact = {r["column"]: r for r in profiling.columns(df).collect()}
    assert (exact["k"]["nulls"], exact["k"]["distinct"], exact["k"]["null_pct"]) == (2, 2, 0.4)
    assert {r["column"]: r["distinct"] for r in profiling.columns(df, approx=True).collect()} == {"k": 2, "v": 2}


def test_segments(warehouse):
    feats = segmentation.rfm_features(warehouse.customer_360)
    customers, profile = segmentation.rfm_segment(feats, restarts=1)
    rows = profile.orderBy(F.desc("value_score")).collect()
    assert [r.segment for r in rows] == list(segmentation.SEGMENTS)
    assert sum(r.customers for r in rows) == feats.count() == customers.count()
    costs = [r.inertia for r in segmentation.rfm_k_diagnostics(feats, ks=(2, 5), restarts=1).orderBy("k").collect()]
    assert costs[0] > costs[1]


def test_propensity(warehouse):
    feats = propensity.propensity_features(warehouse.wide_order_item, warehouse.fact_order, warehouse.dim_product, warehouse.dim_customer)
    train, test = propensity.split_by_date(feats, dt.date(2000, 1, 1))
    model = propensity.propensity_fit(train)
    scored = propensity.risk_deciles(model.score(test))
    assert scored.count() == test.count()
    lift = propensity.decile_lift(scored).collect()
    assert sum(r["items"] for r in lift) == test.count() and len(lift) == 10
    names = [r.feature for r in model.coefficients(test).collect()]
    assert "sale_price_scaled" in names and len(names) == len(set(names))
    assert not any(n.startswith("feature_") for n in names)


@pytest.mark.parametrize("parts", [1, 5])
def test_stratified_split_is_exact(spark, parts):
    rows = [(k, int(k % 7 == 0)) for k in range(1, 4001)] + [(10**12 + k, 2) for k in range(3)] + [(-5, None), (None, None)]
    df = spark.createDataFrame(rows, "k long, y int").repartition(parts)
    train, test = propensity.split_stratified(df, "k", "y")
    got, rest = [tuple(r) for r in test.collect()], [tuple(r) for r in train.collect()]
    assert sorted(got + rest, key=str) == sorted(rows, key=str)
    count = lambda found: {y: sum(r[1] == y for r in found) for y in (0, 1, 2, None)}
    sizes = count(rows)
    assert count(got) == {y: math.floor(n * 0.25 + 0.5) for y, n in sizes.items()}
    place = lambda r: ((r[0] or 0) % 2147483647 * 48271 % 2147483647, r[0] or 0)
    for y in sizes:
        assert max((place(r) for r in got if r[1] == y), default=(-1, 0)) < min(place(r) for r in rest if r[1] == y)
    train, test = propensity.split_stratified(df.limit(0), "k", "y")
    assert (train.count(), test.count()) == (0, 0)


def test_stratified_split_keeps_copies_together(spark):
    df = spark.createDataFrame([(k // 3, 1) for k in range(300)], "k int, y int")
    train, test = propensity.split_stratified(df, "k", "y")
    keys = {r.k for r in test.collect()}
    assert not keys & {r.k for r in train.collect()} and len(keys) == 25


@pytest.mark.parametrize("scaler", ["robust", "standard"])
def test_weights_score_as_the_model_and_are_its_optimum(spark, scaler):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        kind = [None, "a", "b", "c", f"rare{i}"][int(rng.choice(5, p=[0.1, 0.4, 0.3, 0.15, 0.05]))]
        x = float(rng.normal())
        rows.append((i, kind, x, 7.0, int(rng.random() < 1 / (1 + np.exp(-(x + (kind == "a"))))), i % 4 == 0))
    df = spark.createDataFrame(rows, "i int, kind string, x double, constant double, y int, held boolean")
    train, test = df.filter("not held"), df.filter("held")
    model = propensity.propensity_fit(train, "y", ("kind",), ("x", "constant"), scaler=scaler)
    want = {r.i: r.return_probability for r in model.score(test).collect()}
    weights = model.weights(spark)
    made = propensity.score_by_weights(model.prepare(test), weights, ("kind",), ("x", "constant"))
    assert {r.i: r.return_probability for r in made.collect()} == pytest.approx(want, rel=1e-9)
    assert propensity.optimality_certificate(model, train).first() == (450, 2, True)
    # the certificate tells other weights from the optimum
    off = weights.withColumn("weight", F.col("weight") + F.when(F.col("name") == "x", 0.001).otherwise(0.0))
    parts = propensity.penalised_gradient(model.prepare(train), off, "y", ("kind",), ("x", "constant"))
    assert max(abs(r.gradient) for r in parts.collect()) > 1e-5
    names = {r.feature: r.coefficient for r in propensity.coefficient_table(weights).collect()}
    fitted = {r.feature: r.coefficient for r in model.coefficients(train).collect()}
    assert {k: fitted[k] for k in names} == pytest.approx(names)
    assert all(v == 0 for k, v in fitted.items() if k not in names)


def test_gradient_takes_class_sizes_without_a_join(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 0), ("b", 3.0, 0), ("b", 1.0, None)], "kind string, x double, y int")
    rows = [("kind", "a", 0.3, None, None), ("x", None, 0.2, 1.0, 2.0), (propensity.INTERCEPT, None, 0.1, None, None)]
    weights = spark.createDataFrame(rows, propensity.WEIGHTS)
    made = propensity.penalised_gradient(df, weights, "y", ("kind",), ("x",))
    # a join on the label would bring all rows of a class into one task
    assert "Join Inner" not in made._jdf.queryExecution().optimizedPlan().toString()
    p = [1 / (1 + math.exp(-(0.1 + k + 0.2 * (x - 1) / 2))) for k, x in ((0.3, 1), (0.3, 2), (0, 3))]
    # three classes by count, the null one without a share
    res = [(p[0] - 1) / 3, p[1] / 6, p[2] / 6]
    want = {"kind": res[0] + res[1] + 0.3 / 4, "x": res[1] / 2 + res[2] + 0.2 / 4, propensity.INTERCEPT: sum(res)}
    assert {r.name: r.gradient for r in made.collect()} == pytest.approx(want)


def classed(spark, n=900):
    rng = np.random.default_rng(12)
    rows = []
    for i in range(n):
        kind, size = [None, "a", "b", "c", f"rare{i}"][int(rng.choice(5, p=[0.1, 0.4, 0.3, 0.15, 0.05]))], "SML"[int(rng.integers(3))]
        x = float(rng.lognormal())
        rows.append((i, kind, size, x, 7.0, int(rng.random() < 1 / (1 + np.exp(1 - 2 * x - (kind == "a"))))))
    return spark.createDataFrame(rows, "i int, kind string, size string, x double, c0 double, y int")


def test_a_fit_takes_few_passes_and_agrees_with_gradients_alone(spark, monkeypatch):
    train = classed(spark)
    fit = lambda: propensity.propensity_fit(train, "y", ("kind", "size"), ("x", "c0"))
    made = fit()
    monkeypatch.setattr(propensity, "MOST_FEATURES", 0)
    other = fit()
    assert made.passes <= 8 < other.passes and made.known == other.known == [["a", "b", "c", "infrequent", "missing"], ["L", "M", "S"]]
    assert made.fitted == pytest.approx(other.fitted, abs=2e-3)
    largest = lambda m: max(abs(r.gradient) for r in propensity.penalised_gradient(
        m.prepare(train), m.weights(spark), "y", ("kind", "size"), ("x", "c0")).collect())
    assert largest(made) < 1e-9 and largest(other) < 1e-4
    assert not train.sparkSession.sparkContext._jsc.getPersistentRDDs()


def test_a_fit_of_one_class_or_of_other_labels(spark):
    train = classed(spark, 60)
    model = propensity.propensity_fit(train.withColumn("y", F.lit(1)), "y", ("kind",), ("x",))
    assert model.fitted[-1] == float("inf") and set(model.fitted[:-1]) == {0.0}
    for odd in (train.limit(0), train.withColumn("y", F.col("y") + 1), train.withColumn("y", F.lit(None).cast("int"))):
        with pytest.raises(ValueError):
            propensity.propensity_fit(odd, "y", ("kind",), ("x",))


def test_exact_quantiles(spark):
    rng = np.random.default_rng(6)
    columns = {"a": rng.normal(size=701), "b": np.round(rng.normal(size=701), 1) * -1e9, "c": np.zeros(701), "d": 1 + rng.integers(0, 9, 701) * 2.0**-50}
    columns["c"][:200] = -0.0
    columns["a"][:2] = np.inf, -np.inf
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())], "a double, b double, c double, d double").repartition(5)
    shares = (0.001, 0.25, 0.5, 0.75, 1.0)
    want = [[np.sort(v)[max(int(np.ceil(q * 701)), 1) - 1] for q in shares] for v in columns.values()]
    assert propensity.exact_quantiles(df, list(columns), shares) == want


def test_a_split_searches_its_edges_once_and_scores_are_written_once(spark, warehouse):
    df = spark.createDataFrame([(k, k % 2) for k in range(300)], "k int, y int")
    for part in propensity.split_stratified(df, "k", "y"):
        assert "Window" not in part._jdf.queryExecution().optimizedPlan().toString()
    assert all("propensity-scores" in f for f in queries_analytics._score_table(warehouse).inputFiles())


@pytest.mark.parametrize("of, label", [("_dated", "propensity-features"), ("_variant_split", "variant-features")])
def test_a_fit_reads_features_from_files(warehouse, of, label):
    for part in getattr(queries_analytics, of)(warehouse):
        assert any(label in f for f in part.inputFiles())


def test_nearest_centre_of_many_is_the_first_of_the_nearest(spark):
    rng = np.random.default_rng(5)
    for k in (1, 2, 7):
        x, c = np.round(rng.normal(size=(500, 3)), 1), np.round(rng.normal(size=(k, 3)), 1)
        far = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        near, best = segmentation._nearest(np.ascontiguousarray(x.T), c)
        assert (near == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()


def test_rfm_axes_are_read_from_files(warehouse):
    assert all("rfm-logged" in f for f in segmentation.rfm_features(warehouse.customer_360).inputFiles())


def test_horizon_errors_of_all_models_match_brute_force(spark, monkeypatch):
    df, months = series(spark, [100 + 10 * (i % 12) + i for i in range(28)])
    monkeypatch.setattr(queries_analytics, "_series", lambda w: df)
    monkeypatch.setattr(queries_analytics, "FORECAST_END", later(months[-1], 2))
    queries = catalog.all_queries()
    detail = queries["N05_backtest_all_models"].build(None).collect()
    made = {r.step: r.asDict() for r in queries["N11_horizon_decay_all_models"].build(None).collect()}
    assert made and set(made) == {r.step for r in detail}
    for step, row in made.items():
        for m in forecasting.MODELS:
            apes = [abs(r.predicted - r.actual) / r.actual for r in detail if (r.step, r.model) == (step, m)]
            assert row[f"{m}_pct"] == pytest.approx(100 * sum(apes) / len(apes), abs=0.051)


def test_all_starts_in_one_pass_match_single_fits(spark, warehouse):
    feats = segmentation.rfm_features(warehouse.customer_360)
    assert [r.k for r in segmentation.rfm_k_diagnostics(feats, ks=(3, 6)).orderBy("k").collect()] == [3, 6]  # the real 20 starts
    table = np.array([tuple(r) for r in feats.select(*segmentation.SCALED).collect()])
    best = segmentation.best_centres(feats, [3, 6], 20, 42)
    sample = np.array([tuple(r) for r in segmentation.drawn(feats, segmentation.START_SAMPLE).select(*segmentation.SCALED).collect()])
    for k, (centres, cost) in best.items():
        costs = []
        for i in range(20):  # the same starts, one after the other
            c = segmentation._starts(sample, k, 42 + 1000 * k + i)
            while True:
                near = ((table[:, None] - c[None]) ** 2).sum(2).argmin(1)
                new = np.array([table[near == j].mean(0) if (near == j).any() else c[j] for j in range(k)])
                done, c = np.abs(new - c).max() <= segmentation.STILL, new
                if done:
                    break
            costs.append(((table[:, None] - c[None]) ** 2).sum(2).min(1).sum())
        assert cost == pytest.approx(min(costs), rel=1e-9)
        assert cost == pytest.approx(((table[:, None] - centres[None]) ** 2).sum(2).min(1).sum(), rel=1e-9)


def test_fits_go_on_until_they_stand_still(spark, monkeypatch):
    rounds = 700
    seen = []

    def creeping(points, sets):
        """Sums whose mean moves by 0.001 a round, then stands."""
        seen.append(len(sets))
        at = min(len(seen), rounds) / 1000
        return {i: np.array([[2.0, 2 * at, 0, 0, 5]]) for i in sets}

    monkeypatch.setattr(segmentation, "_one_round", creeping)
    (centre, cost), = segmentation.k_means(None, [np.zeros((1, 3))])
    assert centre.tolist() == [[rounds / 1000, 0, 0]] and cost == 5
    assert len(seen) == rounds + 2  # one that stands, one for the cost
    monkeypatch.setattr(segmentation, "_one_round", lambda points, sets: {i: np.array([[1.0, np.nan, 0, 0, 0]]) for i in sets})
    with pytest.raises(ValueError, match="finite"):
        segmentation.k_means(None, [np.zeros((1, 3))])


@pytest.mark.parametrize("squared", [False, True])
def test_silhouette_matches_definition(spark, squared):
    rng = np.random.default_rng(3)
    x = np.concatenate((rng.normal(0, 1, (300, 3)), rng.normal(3, 1, (250, 3)), [[50.0, 50, 50]]))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["customer_id", *segmentation.SCALED])
    centres = {2: [[0, 0, 0], [3, 3, 3]], 3: [[0, 0, 0], [3, 3, 3], [50, 50, 50]]}
    far = ((x[:, None] - x[None]) ** 2).sum(2) ** (1.0 if squared else 0.5)
    for r in segmentation.silhouette(df, centres, squared=squared).collect():
        label = ((x[:, None] - np.array(centres[r.k], float)[None]) ** 2).sum(2).argmin(1)
        scores = []
        for i in range(len(x)):
            means = [far[i, label == c].sum() / max((label == c).sum() - (c == label[i]), 1) for c in range(r.k)]
            a, b = means[label[i]], min(m for c, m in enumerate(means) if c != label[i])
            scores.append((b - a) / max(a, b) if (label == label[i]).sum() > 1 else 0.0)
        assert r.silhouette == pytest.approx(np.mean(scores), rel=1e-9)


def test_default_numbers_of_starts():
    import inspect

    asked = {f: inspect.signature(getattr(segmentation, f)).parameters["restarts"].default for f in ("rfm_k_diagnostics", "rfm_segment", "rfm_variant")}
    assert asked == {"rfm_k_diagnostics": 20, "rfm_segment": 30, "rfm_variant": 20}


def test_smoothing_fold_matches_a_loop(spark):
    rng = np.random.default_rng(5)
    values = [1000 * 1.01**i * (1 + 0.3 * np.sin(2 * np.pi * i / 12)) * rng.uniform(0.9, 1.1) for i in range(41)]
    df, months = series(spark, values)
    other = df.withColumn("net_sales_value", F.col("net_sales_value") * 3 + 50)
    both = df.withColumn("k", F.lit("a")).unionByName(other.withColumn("k", F.lit("b")))
    sets = {"a": (0.2, 0.02, 0.3), "b": (0.7, 0.4, 0.1)}
    weights = spark.createDataFrame([(k, *v) for k, v in sets.items()], "k string, alpha double, beta double, gamma double")
    got = forecasting.forecast(both, later(months[-1], 14), [forecasting.SMOOTH], ["k"], weights=weights)
    made = {(r.k, r.step): r.forecast_net_sales_usd for r in got.collect()}

    def walk(x, a, b, g):
        y = np.log(np.maximum(np.array(x), 1.0))
        m, t = y[:12].mean(), (y[12:24].mean() - y[:12].mean()) / 12
        level, trend, season, error = m - t * 6.5, t, [y[i] - m - t * (i - 5.5) for i in range(12)], 0.0
        for i, v in enumerate(y):
            s = season[i % 12]
            error += (v - level - trend - s) ** 2
            now = a * (v - s) + (1 - a) * (level + trend)
            trend, level = b * (now - level) + (1 - b) * trend, now
            season[i % 12] = g * (v - level) + (1 - g) * s
        return [float(np.exp(level + trend * k + season[(len(y) + k - 1) % 12])) for k in range(1, 15)], error

    for k, x in (("a", values), ("b", [3 * v + 50 for v in values])):
        path, error = walk(x, *sets[k])
        assert [made[(k, i + 1)] for i in range(14)] == pytest.approx(path, rel=1e-9)
        r = forecasting.smoothing_error(both, weights, ["k"]).filter(F.col("k") == k).first()
        assert (r.months, r.squared_error) == (41, pytest.approx(error, rel=1e-9))
    # weights kept from a fit give the forecast of the fit, and no candidate is better
    kept = forecasting.smoothing_weights(df)
    fit = forecasting.forecast(df, later(months[-1], 6), [forecasting.SMOOTH]).orderBy("step").collect()
    again = forecasting.forecast(df, later(months[-1], 6), [forecasting.SMOOTH], weights=kept).orderBy("step").collect()
    assert [r.forecast_net_sales_usd for r in again] == pytest.approx([r.forecast_net_sales_usd for r in fit])
    few = spark.createDataFrame([(a, b, g) for a in (0.1, 0.5) for b in (0.1, 0.5) for g in (0.1, 0.5)], "alpha double, beta double, gamma double")
    best = forecasting.smoothing_error(df, kept).first().squared_error
    assert best <= min(r.squared_error for r in forecasting.smoothing_error(df, few).collect())


def test_column_profile_counts_values_exactly(spark):
    rows = [(1, 0.0, "a", dt.datetime(2024, 10, 27, 1, 30), [1, 2], b"\x01"), (1, -0.0, "a", dt.datetime(2024, 10, 27, 1, 30), [1, 2], b"\x01"),
            (2, float("nan"), None, None, None, None), (2, float("nan"), "", dt.datetime(2024, 1, 1), [12], b"\x02"), (None, None, "b", None, [], b"\x02")]
    df = spark.createDataFrame(rows, "k int, d double, s string, t timestamp, l array<int>, x binary").withColumnRenamed("s", "s.x")
    made = {r["column"]: r for r in profiling.columns(df).collect()}
    assert {c: (r["rows"], r["nulls"], r["distinct"]) for c, r in made.items()} == {
        "k": (5, 1, 2), "d": (5, 1, 2), "s.x": (5, 1, 3), "t": (5, 2, 2), "l": (5, 1, 3), "x": (5, 1, 2)}
    assert (made["k"]["example"], made["s.x"]["example"], made["t"]["example"]) == ("1", "", "2024-01-01 00:00:00")
    plan = profiling.columns(df)._jdf.queryExecution().toString()
    assert "Expand" not in plan and "Sort [" not in plan
    empty = profiling.columns(df.filter("k > 9")).collect()
    assert [(r["rows"], r["nulls"], r["distinct"], r["null_pct"], r["example"]) for r in empty] == [(0, 0, 0, 0.0, None)] * 6
