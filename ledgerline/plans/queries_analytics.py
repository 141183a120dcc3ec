"""Queries for customer analytics, statistics, models and forecasts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.measures import money_sum
from ..operators import associations, concentration, experiments, forecasting, propensity, segmentation
from .driver_tables import FORECAST_END
from .oracle import ratio
from .registry import register
from .session import shared_table

SPLIT = dt.date(2000, 1, 1)

# --- segments and concentration ----------------------------------------------

_features = f"""
    WITH a AS (SELECT customer_id, recency_days, order_count, net_sales_value, observed_return_rate,
        ln(1 + greatest(recency_days, 0)::DOUBLE) AS recency, ln(1 + order_count::DOUBLE) AS frequency,
        ln(1 + net_sales_value::DOUBLE) AS monetary FROM w_c360 WHERE net_sales_value > 0 AND order_count > 0),
      q AS (SELECT {", ".join(f"quantile_cont({c}, {p}) AS {c}{i}" for c in segmentation.AXES
                              for i, p in ((1, 0.25), (2, 0.5), (3, 0.75)))} FROM a)
    SELECT a.*, {", ".join(f"({c} - {c}2) / CASE WHEN {c}3 = {c}1 THEN 1 ELSE {c}3 - {c}1 END AS {c}_scaled" for c in segmentation.AXES)}
    FROM a, q"""
register(
    "L01_rfm_features",
    lambda w: segmentation.rfm_features(w.customer_360),
    _features,
    doubles=["net_sales_value"],
    rounded=[*segmentation.AXES, *[f"{a}_scaled" for a in segmentation.AXES]],
)
register("L02_rfm_k_diagnostics", lambda w: segmentation.rfm_k_diagnostics(segmentation.rfm_features(w.customer_360)))
register("L03_rfm_segment", lambda w: segmentation.rfm_segment(segmentation.rfm_features(w.customer_360))[0])
register("L03_rfm_segment_profile", lambda w: segmentation.rfm_segment(segmentation.rfm_features(w.customer_360))[1])
register("L04_rfm_variant", lambda w: segmentation.rfm_variant(segmentation.rfm_features(w.customer_360))[1])

# Stored centres on the scaled axes: naming, profile and shares can then be checked apart from the fit.
CENTRES = ((0.9, -0.5, -0.6), (0.0, 0.0, 0.1), (-0.6, 0.7, 0.7))
_far = ", ".join(
    f"({i}, " + " + ".join(f"({a}_scaled - ({x})) * ({a}_scaled - ({x}))" for a, x in zip(segmentation.AXES, c)) + ")" for i, c in enumerate(CENTRES)
)
_nearest = f"""SELECT f.*, (SELECT arg_min(i, x) FROM (VALUES {_far}) d(i, x)) AS cluster_id, (SELECT min(x) FROM (VALUES {_far}) d(i, x)) AS distance
    FROM ({_features}) f"""
_profile = f"""
    WITH n AS ({_nearest}),
      p AS (SELECT cluster_id, COUNT(*) AS customers, AVG(order_count) AS mean_order_count, SUM(net_sales_value) AS total_net_sales,
          AVG(observed_return_rate) AS mean_return_rate, quantile_cont(recency_days::DOUBLE, 0.5) AS median_recency_days,
          quantile_cont(net_sales_value::DOUBLE, 0.5) AS median_net_sales FROM n GROUP BY 1),
      r AS (SELECT *, {" ".join(
          f"{sign} (rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE) / COUNT(*) OVER ()"
          for sign, c in (("", "mean_order_count"), ("+", "median_net_sales"), ("-", "median_recency_days")))} AS value_score FROM p)
    SELECT *, CASE row_number() OVER (ORDER BY value_score DESC, cluster_id)
      {" ".join(f"WHEN {i + 1} THEN '{name}'" for i, name in enumerate(segmentation.SEGMENTS))} END AS segment FROM r"""


def _at_centres(w):
    return segmentation.nearest_centre(segmentation.rfm_features(w.customer_360), CENTRES)


_SAMPLED = 300  # fewer than all even in small tables, so that the draw counts
register(
    "L02_silhouette_stored_centres",
    lambda w: segmentation.silhouette(segmentation.rfm_features(w.customer_360), {len(CENTRES): CENTRES}, _SAMPLED),
    f"""
    WITH n AS ({_nearest}), s AS (SELECT * FROM n ORDER BY customer_id % 2147483647 * 48271 % 2147483647, customer_id LIMIT {_SAMPLED}),
      d AS (SELECT x.customer_id, x.cluster_id AS mine, y.cluster_id AS theirs, SUM(sqrt({" + ".join(f"(x.{a}_scaled - y.{a}_scaled) ** 2" for a in segmentation.AXES)})) AS far,
          COUNT(*) AS c FROM s x, s y GROUP BY 1, 2, 3),
      ab AS (SELECT customer_id, MAX(CASE WHEN mine = theirs THEN CASE WHEN c > 1 THEN far / (c - 1) END END) AS a,
          MIN(CASE WHEN mine <> theirs THEN far / c END) AS b FROM d GROUP BY 1)
    SELECT {len(CENTRES)} AS k, AVG(coalesce((b - a) / CASE WHEN greatest(a, b) > 0 THEN greatest(a, b) END, 0)) AS silhouette FROM ab""",
    rounded=["silhouette"],
)
register(
    "L04_snake_stored_centres",
    lambda w: segmentation.snake_profile(
        segmentation.nearest_centre(segmentation.standard_scale(segmentation.rfm_features(w.customer_360)), CENTRES)
    ),
    f"""
    WITH f AS ({_features}),
      m AS (SELECT {", ".join(f"AVG({a}) AS m_{a}, stddev_pop({a}) AS s_{a}" for a in segmentation.AXES)} FROM f),
      g AS (SELECT f.* EXCLUDE ({", ".join(f"{a}_scaled" for a in segmentation.AXES)}),
          {", ".join(f"({a} - m_{a}) / CASE WHEN s_{a} > 0 THEN s_{a} ELSE 1 END AS {a}_scaled" for a in segmentation.AXES)} FROM f, m),
      n AS (SELECT g.*, (SELECT arg_min(i, x) FROM (VALUES {_far}) d(i, x)) AS cluster_id FROM g),
      p AS (SELECT cluster_id, COUNT(*) AS customers, {", ".join(f"AVG({c}::DOUBLE) AS mean_{c}" for c in segmentation.RAW.values())},
          {", ".join(f"AVG({a}_scaled) AS scaled_{a}" for a in segmentation.AXES)} FROM n GROUP BY 1),
      r AS (SELECT *, {", ".join(f"rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS r{i}"
                                 for i, c in enumerate(("mean_recency_days", "mean_order_count", "mean_net_sales_value")))} FROM p),
      q AS (SELECT * EXCLUDE (r0, r1, r2), (MAX(r0) OVER ()) - r0 + 1 + r1 + r2 AS quality FROM r)
    SELECT *, CASE row_number() OVER (ORDER BY quality DESC, cluster_id)
      {" ".join(f"WHEN {i + 1} THEN '{name}'" for i, name in enumerate(segmentation.SEGMENTS))} END AS segment FROM q""",
    rounded=["mean_recency_days", "mean_order_count", "mean_net_sales_value", *[f"scaled_{a}" for a in segmentation.AXES], "quality"],
)
register(
    "L03_rfm_segment_stored_centres",
    lambda w: _at_centres(w).select("customer_id", "cluster_id", "distance"),
    f"SELECT customer_id, cluster_id, distance FROM ({_nearest})",
    rounded=["distance"],
)
register(
    "L03_rfm_profile_stored_centres",
    lambda w: segmentation.cluster_profile(_at_centres(w)),
    _profile,
    rounded=["mean_order_count", "total_net_sales", "mean_return_rate", "median_recency_days", "median_net_sales", "value_score"],
)
register(
    "R15_rfm_shares_stored_centres",
    lambda w: segmentation.segment_shares(segmentation.cluster_profile(_at_centres(w))),
    f"""SELECT segment, customers, {ratio('customers', 'SUM(customers) OVER ()')} AS customer_share, median_recency_days, mean_order_count,
        median_net_sales, total_net_sales, {ratio('total_net_sales', 'SUM(total_net_sales) OVER ()')} AS revenue_share FROM ({_profile})""",
    rounded=["customer_share", "median_recency_days", "mean_order_count", "median_net_sales", "total_net_sales", "revenue_share"],
)

_spend = "SELECT customer_id, SUM(net_sales_value) AS v FROM w_items GROUP BY 1 HAVING SUM(net_sales_value) >= 0"
_gini = f"""COUNT(*) AS owners, {ratio('2 * SUM(i * v::DOUBLE) - (COUNT(*) + 1) * SUM(v)::DOUBLE', 'COUNT(*) * SUM(v)')} AS gini"""
register(
    "L05_gini",
    lambda w: concentration.gini(concentration.customer_spend(w.wide_order_item), "net_spend"),
    f"SELECT {_gini} FROM (SELECT v, row_number() OVER (ORDER BY v) AS i FROM ({_spend}))",
    rounded=["gini"], digits=9,
)
register(
    "L05_gini_positive_only",
    lambda w: concentration.gini(concentration.customer_spend(w.wide_order_item, positive_only=True), "net_spend"),
    f"SELECT {_gini} FROM (SELECT v, row_number() OVER (ORDER BY v) AS i FROM ({_spend}) WHERE v > 0)",
    rounded=["gini"], digits=9,
)
register(
    "L05_gini_by_country",
    lambda w: concentration.gini(w.customer_360, "net_sales_value", ["country"]),
    f"""SELECT country, {_gini} FROM (SELECT country, net_sales_value AS v,
          row_number() OVER (PARTITION BY country ORDER BY net_sales_value) AS i FROM w_c360) GROUP BY country""",
    rounded=["gini"], digits=9,
)
register(
    "L06_lorenz",
    lambda w: concentration.lorenz(concentration.customer_spend(w.wide_order_item), "net_spend", 100),
    f"""SELECT k::INTEGER AS point, i AS owners, {ratio('i', 'n')} AS owner_share, {ratio('cum', 'total')} AS value_share
        FROM (SELECT row_number() OVER o AS i, SUM(v) OVER (o ROWS UNBOUNDED PRECEDING) AS cum, COUNT(*) OVER () AS n,
                SUM(v) OVER () AS total FROM ({_spend}) WINDOW o AS (ORDER BY v, customer_id)), range(1, 101) g(k)
        WHERE i = n * k // 100""",
    rounded=["owner_share", "value_share"], digits=9,
)
register(
    "L07_top_share",
    lambda w: concentration.top_share(concentration.customer_spend(w.wide_order_item), "net_spend"),
    f"""SELECT p AS top_share, {ratio('SUM(v) FILTER (i > floor(n * (1 - p)))', 'SUM(v)')} AS value_share
        FROM (SELECT v, row_number() OVER (ORDER BY v) AS i, COUNT(*) OVER () AS n FROM ({_spend})),
          (VALUES (0.1::DOUBLE), (0.2::DOUBLE)) t(p) GROUP BY p""",
    rounded=["value_share"], digits=9,
)

# --- return propensity -------------------------------------------------------


def _features(w):
    return propensity.propensity_features(w.wide_order_item, w.fact_order, w.dim_product, w.dim_customer)


def _dated(w):
    """(train, test) of features written once: a fit, its levels and its scores read them several times."""
    return propensity.split_by_date(shared_table(_features(w), "propensity-features"), SPLIT)


def _scored(w):
    train, test = _dated(w)
    return propensity.propensity_fit(train).score(test)


def _score_table(w):
    """The scores, written once: quantiles, buckets and metrics read them several times."""
    return shared_table(_scored(w).select("order_item_id", "order_date", "return_flag", "return_probability"), "propensity-scores")


def _fixed_score(w):
    """A score that needs no fit, so that ranking metrics can be checked exactly."""
    return _features(w).withColumn(
        "return_probability", F.round(F.coalesce(F.col("gross_margin_rate"), F.lit(0.0)) / 2 + 0.5, 9)
    )


PARTS = {
    "w_features": """
      SELECT i.order_item_id, CAST(order_item_created_at AS DATE) AS order_date, returned_item_flag AS return_flag,
        i.sale_price::DOUBLE AS sale_price, i.unit_cost::DOUBLE AS unit_cost, gross_margin_rate, o.item_count AS order_item_count,
        i.category, i.department, CASE WHEN b.r <= 100 THEN i.brand ELSE 'Other brands' END AS brand_group,
        CAST(i.distribution_center_id AS VARCHAR) AS distribution_center, c.age, c.age_band, c.gender, c.country,
        i.acquisition_source, CAST(month(order_item_created_at) AS VARCHAR) AS order_month,
        CAST(isodow(order_item_created_at) AS VARCHAR) AS order_weekday
      FROM w_items i JOIN w_orders o ON o.order_id = i.order_id JOIN w_customers c ON c.user_id = i.customer_id
      JOIN (SELECT brand, rank() OVER (ORDER BY COUNT(*) DESC, brand) AS r FROM w_items GROUP BY brand) b ON b.brand = i.brand
      WHERE return_observation_eligible_flag = 1""",
    "w_fixed": "SELECT *, round(COALESCE(gross_margin_rate, 0) / 2 + 0.5, 9) AS s FROM w_features",
    "w_edges": "SELECT quantile_cont(s, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e, MIN(s) AS lo FROM w_fixed",
    "w_deciles": """SELECT f.*, len(list_filter(list_distinct(e), lambda x: x > lo AND x < s)) + 1 AS risk_decile
      FROM w_fixed f, w_edges""",
}
register("L08_propensity_features", _features, "SELECT * FROM w_features", parts=PARTS)
register(
    "L09_propensity_fit",
    lambda w: (lambda parts: propensity.propensity_fit(parts[0]).coefficients(parts[0]))(
        _dated(w)
    ),
)
register(
    "L10_propensity_scores",
    lambda w: propensity.risk_deciles(_score_table(w)).select(
        "order_item_id", "order_date", "return_flag", "return_probability", "risk_decile"
    ),
)
register(
    "L10_deciles_fixed_score",
    lambda w: propensity.risk_deciles(_fixed_score(w)).groupBy("risk_decile").agg(
        F.count("*").alias("items"), F.min("return_probability").alias("lowest"), F.max("return_probability").alias("highest")
    ),
    "SELECT risk_decile, COUNT(*) AS items, MIN(s) AS lowest, MAX(s) AS highest FROM w_deciles GROUP BY 1",
    parts=PARTS,
)
register("L11_decile_lift", lambda w: propensity.decile_lift(propensity.risk_deciles(_score_table(w))))
register(
    "L11_decile_lift_fixed_score",
    lambda w: propensity.decile_lift(propensity.risk_deciles(_fixed_score(w))),
    f"""SELECT risk_decile, COUNT(*) AS items, CAST(SUM(return_flag) AS BIGINT) AS returned_items,
          AVG(s) AS avg_predicted_probability, AVG(return_flag) AS observed_return_rate,
          {ratio('AVG(return_flag)', '(SELECT AVG(return_flag) FROM w_fixed)')} AS lift_vs_baseline
        FROM w_deciles GROUP BY 1""",
    rounded=["avg_predicted_probability", "lift_vs_baseline", "observed_return_rate"],
    parts=PARTS,
)
register(
    "L12_coefficients",
    lambda w: (lambda parts: propensity.propensity_fit(parts[0]).coefficients(parts[0], odds=True))(
        _dated(w)
    ).orderBy(F.desc("absolute_coefficient")),
)
register("L13_classifier_metrics", lambda w: propensity.classifier_metrics(_score_table(w)))
register(
    "L13_classifier_metrics_fixed_score",
    lambda w: propensity.classifier_metrics(_fixed_score(w)),
    """
    WITH g AS (SELECT s, SUM(return_flag)::DOUBLE AS p, COUNT(*)::DOUBLE - SUM(return_flag) AS n FROM w_fixed GROUP BY s),
      c AS (SELECT *, SUM(p) OVER up AS p_in, SUM(n) OVER up AS n_in, SUM(p) OVER () AS pt, SUM(n) OVER () AS nt
            FROM g WINDOW up AS (ORDER BY s DESC))
    SELECT SUM(p * (nt - n_in + n / 2)) / MAX(pt * nt) AS roc_auc, SUM(p / pt * p_in / (p_in + n_in)) AS average_precision,
      (SELECT AVG((s - return_flag) * (s - return_flag)) FROM w_fixed) AS brier_score FROM c""",
    rounded=["roc_auc", "average_precision", "brier_score"],
    parts=PARTS,
)


V_CATEGORICAL = ("category", "department", "price_band", "acquisition_source")
V_NUMERIC = ("sale_price", "gross_margin_rate", "delivery_lead_days")


def _variant_features(w):
    return shared_table(propensity.variant_features(w.wide_order_item, w.dim_product), "variant-features")


def _variant(w):
    feats = _variant_features(w)
    train, test = propensity.split_stratified(feats, "order_item_id", "return_flag")
    return _variant_fit(train), feats, test


def _variant_fit(train):
    return propensity.propensity_fit(train, categorical=V_CATEGORICAL, numeric=V_NUMERIC, min_frequency=1, scaler="standard")


register("L14_variant_confusion", lambda w: (lambda m, f, t: propensity.confusion(m.score(t)))(*_variant(w)))
register("L14_variant_odds_ratios", lambda w: (lambda m, f, t: m.coefficients(f, odds=True))(*_variant(w)))
register(
    "L14_variant_risk_bands",
    lambda w: (lambda m, f, t: propensity.risk_bands(m.score(f)).groupBy("risk_band").agg(
        F.count("*").alias("items"), F.avg("return_probability").alias("mean_probability")))(*_variant(w)),
)
register(
    "L14_confusion_fixed_score",
    lambda w: propensity.confusion(_fixed_score(w), cut=0.97),
    f"""SELECT *, {ratio('true_positive', 'true_positive + false_positive')} AS precision,
          {ratio('true_positive', 'true_positive + false_negative')} AS recall
        FROM (SELECT COUNT(*) FILTER (s > 0.97 AND return_flag = 1) AS true_positive,
          COUNT(*) FILTER (s > 0.97 AND return_flag = 0) AS false_positive,
          COUNT(*) FILTER (s <= 0.97 AND return_flag = 1) AS false_negative,
          COUNT(*) FILTER (s <= 0.97 AND return_flag = 0) AS true_negative FROM w_fixed)""",
    parts=PARTS,
)

# Weights by a rule over the trained levels: everything after the fit can then be checked, and so can the fit's own optimum.
NUMBER_WEIGHTS = {
    "sale_price": (0.2, 50.0, 40.0), "unit_cost": (-0.3, 25.0, 20.0), "gross_margin_rate": (0.4, 0.5, 0.1),
    "order_item_count": (-0.1, 2.0, 1.0), "age": (0.05, 40.0, 15.0), "delivery_lead_days": (0.15, 4.0, 2.0),
}
START = -0.1


def _stored_weights(prepared, categorical, numeric):
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("level")) for c in categorical])
    levels = prepared.select(F.inline(pairs)).distinct().withColumn(
        "weight", (F.pmod(F.length("level") + F.length("name"), F.lit(7)) - 3) / 10
    )
    levels = shared_table(levels, "stored-weights")  # by its own size, so that joins to it need not shuffle the rows
    rows = [(c, None, *NUMBER_WEIGHTS[c]) for c in numeric] + [(propensity.INTERCEPT, None, START, None, None)]
    fixed = prepared.sparkSession.createDataFrame(rows, propensity.WEIGHTS)
    return fixed.unionByName(levels, allowMissingColumns=True)


def _by_stored_weights(train, rows, categorical=propensity.CATEGORICAL, numeric=propensity.NUMERIC, minimum=20):
    """(rows with a score, weights): prepared as the fit prepares them, without fitting."""
    levels = propensity.level_table(train, categorical, minimum)
    ready = lambda df: propensity.prepare(df, levels, categorical, numeric)
    weights = _stored_weights(ready(train), categorical, numeric)
    return propensity.score_by_weights(ready(rows), weights, categorical, numeric), weights


def _stored_sql(source, train, categorical, numeric, minimum, prefix):
    """Views over ``source``: level counts, prepared rows, trained levels with their weights, scores."""
    levels = " UNION ALL ".join(
        f"SELECT '{c}' AS name, {c} AS level FROM {source} WHERE {train} AND {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) < {minimum}"
        for c in categorical
    )
    folded = ", ".join(
        f"CASE WHEN {c} IN (SELECT level FROM {prefix}_rare WHERE name = '{c}') THEN 'infrequent' ELSE COALESCE({c}, 'missing') END AS {c}"
        for c in categorical
    )
    trained = " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS name, {c} AS level FROM {prefix}_ready WHERE {train}" for c in categorical)
    joins = " ".join(f"LEFT JOIN {prefix}_levels l{i} ON l{i}.name = '{c}' AND l{i}.level = r.{c}" for i, c in enumerate(categorical))
    dot = " + ".join(f"COALESCE(l{i}.weight, 0)" for i in range(len(categorical)))
    dot += "".join(
        f" + COALESCE(({w}::DOUBLE) * (r.{c} - ({m}::DOUBLE)) / {d}::DOUBLE, ({w}::DOUBLE) * (0 - ({m}::DOUBLE)) / {d}::DOUBLE)"
        for c, (w, m, d) in ((c, NUMBER_WEIGHTS[c]) for c in numeric)
    )
    return {
        f"{prefix}_rare": levels,
        f"{prefix}_ready": f"SELECT * REPLACE ({folded}) FROM {source}",
        f"{prefix}_levels": f"SELECT name, level, ((length(level) + length(name)) % 7 - 3) / 10.0::DOUBLE AS weight FROM ({trained})",
        f"{prefix}_scores": f"SELECT r.*, 1 / (1 + exp(-({dot} + ({START}::DOUBLE)))) AS p FROM {prefix}_ready r {joins}",
    }


_BEFORE, _AFTER = f"order_date < DATE '{SPLIT}'", f"order_date >= DATE '{SPLIT}'"
PARTS |= _stored_sql("w_features", _BEFORE, propensity.CATEGORICAL, propensity.NUMERIC, 20, "w_dated")
_VARIANT = {
    "w_variant": """
      SELECT *, rank() OVER (PARTITION BY return_flag ORDER BY order_item_id % 2147483647 * 48271 % 2147483647, order_item_id)
          <= round(COUNT(*) OVER (PARTITION BY return_flag) * 0.25::DOUBLE) AS held_out
      FROM (SELECT order_item_id, returned_item_flag AS return_flag, i.sale_price::DOUBLE AS sale_price, gross_margin_rate,
          delivery_lead_days, i.category, i.department, CASE WHEN p.retail_price < 25 THEN 'Under $25' WHEN p.retail_price < 50 THEN '$25-$49'
            WHEN p.retail_price < 100 THEN '$50-$99' WHEN p.retail_price < 200 THEN '$100-$199' ELSE '$200+' END AS price_band,
          acquisition_source FROM w_items i JOIN w_products p ON p.product_id = i.product_id
        WHERE return_observation_eligible_flag = 1 AND delivery_lead_days IS NOT NULL)""",
}
_VARIANT |= _stored_sql("w_variant", "NOT held_out", V_CATEGORICAL, V_NUMERIC, 1, "w_split")


def _stored_gradient(train, _):
    levels = propensity.level_table(train, propensity.CATEGORICAL, 20)
    ready = propensity.prepare(train, levels, propensity.CATEGORICAL, propensity.NUMERIC)
    return propensity.penalised_gradient(ready, _stored_weights(ready, propensity.CATEGORICAL, propensity.NUMERIC))


def _variant_split(w):
    return propensity.split_stratified(_variant_features(w), "order_item_id", "return_flag")


def _variant_scores(w):
    return (lambda train, test: _by_stored_weights(train, test, V_CATEGORICAL, V_NUMERIC, 1)[0])(*_variant_split(w))


def _certificate_sql(source, train):
    return f"SELECT COUNT(*) AS n_rows, COUNT(DISTINCT return_flag) AS classes, true AS optimal FROM {source} WHERE {train}"


register(
    "L09_optimality_certificate",
    lambda w: (lambda train, _: propensity.optimality_certificate(propensity.propensity_fit(train), train))(*_dated(w)),
    _certificate_sql("w_features", _BEFORE),
    parts=PARTS,
)
register(
    "L09_gradient_stored_weights",
    lambda w: _stored_gradient(*_dated(w)),
    f"""
    WITH t AS (SELECT *, (p - return_flag) / (COUNT(*) OVER (PARTITION BY return_flag) * (SELECT COUNT(DISTINCT return_flag) FROM w_dated_ready
            WHERE {_BEFORE})) AS res FROM w_dated_scores WHERE {_BEFORE}),
      g AS ({" UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS level, SUM(res) AS slope FROM t GROUP BY {c}" for c in propensity.CATEGORICAL)})
    SELECT name, level, slope + weight / (SELECT COUNT(*) FROM t) AS gradient FROM g JOIN w_dated_levels USING (name, level)
    UNION ALL SELECT '{propensity.INTERCEPT}', NULL, SUM(res) FROM t
    {" ".join(f"UNION ALL SELECT '{c}', NULL, SUM(res * (COALESCE({c}, 0) - {m}::DOUBLE) / {d}::DOUBLE) + ({x}::DOUBLE) / COUNT(*) FROM t"
              for c, (x, m, d) in ((c, NUMBER_WEIGHTS[c]) for c in propensity.NUMERIC))}""",
    rounded=["gradient"], digits=9, parts=PARTS,
)
register(
    "L10_propensity_scores_stored_weights",
    lambda w: _by_stored_weights(*_dated(w))[0].select("order_item_id", "order_date", "return_flag", "return_probability"),
    f"SELECT order_item_id, order_date, return_flag, p AS return_probability FROM w_dated_scores WHERE {_AFTER}",
    rounded=["return_probability"], digits=9, parts=PARTS,
)
register(
    "L12_coefficients_stored_weights",
    lambda w: propensity.coefficient_table(_by_stored_weights(*_dated(w))[1], odds=True),
    f"""SELECT *, abs(coefficient) AS absolute_coefficient, exp(coefficient) AS odds_ratio FROM (
          SELECT name || '_' || level AS feature, weight AS coefficient FROM w_dated_levels
          UNION ALL SELECT * FROM (VALUES {", ".join(f"('{c}_scaled', {NUMBER_WEIGHTS[c][0]}::DOUBLE)" for c in propensity.NUMERIC)}))""",
    rounded=["odds_ratio"], parts=PARTS,
)
register(
    "L14_stratified_split",
    lambda w: _variant_split(w)[1].select("order_item_id", "return_flag"),
    "SELECT order_item_id, return_flag FROM w_variant WHERE held_out",
    parts=_VARIANT,
)
register(
    "L14_optimality_certificate",
    lambda w: (lambda train, _: propensity.optimality_certificate(_variant_fit(train), train))(*_variant_split(w)),
    _certificate_sql("w_variant", "NOT held_out"),
    parts=_VARIANT,
)
register(
    "L14_confusion_stored_weights",
    lambda w: propensity.confusion(_variant_scores(w).withColumn("return_probability", F.round("return_probability", 9))),
    f"""SELECT *, {ratio('true_positive', 'true_positive + false_positive')} AS precision,
          {ratio('true_positive', 'true_positive + false_negative')} AS recall
        FROM (SELECT COUNT(*) FILTER (round(p, 9) > 0.5 AND return_flag = 1) AS true_positive,
          COUNT(*) FILTER (round(p, 9) > 0.5 AND return_flag = 0) AS false_positive,
          COUNT(*) FILTER (round(p, 9) <= 0.5 AND return_flag = 1) AS false_negative,
          COUNT(*) FILTER (round(p, 9) <= 0.5 AND return_flag = 0) AS true_negative FROM w_split_scores WHERE held_out)""",
    parts=_VARIANT,
)

# --- baskets and tests -------------------------------------------------------

_RULES = {
    "w_order_cats": "SELECT order_id, category FROM w_items WHERE net_sales_value > 0 GROUP BY ALL",
    "w_cat_orders": "SELECT category, COUNT(*) AS n FROM w_order_cats GROUP BY 1",
    "w_rules": f"""
      SELECT p.a AS antecedent, p.b AS consequent, p.n AS pair_orders, {ratio('p.n', 't.n')} AS support,
        {ratio('p.n', 'ca.n')} AS confidence, {ratio('p.n', 'ca.n')} / ({ratio('cb.n', 't.n')}) AS lift,
        ca.n AS antecedent_orders, cb.n AS consequent_orders, t.n AS eligible_orders
      FROM (SELECT x.category AS a, y.category AS b, COUNT(*) AS n FROM w_order_cats x JOIN w_order_cats y
            ON y.order_id = x.order_id AND y.category <> x.category GROUP BY ALL HAVING COUNT(*) >= 25) p
      JOIN w_cat_orders ca ON ca.category = p.a JOIN w_cat_orders cb ON cb.category = p.b,
      (SELECT COUNT(DISTINCT order_id) AS n FROM w_order_cats) t""",
}
register("L15_basket_rules", lambda w: associations.basket_rules(w.wide_order_item, w.dim_product),
         "SELECT * FROM w_rules", parts=_RULES)
register(
    "L16_top_rules",
    lambda w: associations.top_rules(associations.basket_rules(w.wide_order_item, w.dim_product)),
    """SELECT * FROM w_rules WHERE support >= (SELECT quantile_cont(support, 0.5) FROM w_rules)
       ORDER BY lift DESC, pair_orders DESC, antecedent, consequent LIMIT 15""",
    parts=_RULES,
)
register(
    "L17_experiment_power_plan",
    lambda w: experiments.experiment_power_plan(w.fact_session),
    """
    SELECT p1 AS baseline_cart_to_purchase_rate, d AS absolute_mde, d / p1 AS relative_mde, 0.05::DOUBLE AS alpha, pw AS power, n AS sample_per_variant,
      2 * n AS total_sample
    FROM (SELECT *, CAST(ceil(pow(1.959963984540054 * sqrt(2 * m * (1 - m)) + zb * sqrt(p1 * (1 - p1) + p2 * (1 - p2)), 2) / (d * d)) AS BIGINT) AS n
      FROM (SELECT *, (p1 + p2) / 2 AS m FROM (SELECT *, least(0.999::DOUBLE, p1 + d) AS p2
        FROM (SELECT COUNT(*) FILTER (cart_flag + purchase_flag = 2) / SUM(cart_flag)::DOUBLE AS p1 FROM w_visits),
          (VALUES (0.8::DOUBLE, 0.8416212335729143::DOUBLE), (0.9::DOUBLE, 1.2815515655446004::DOUBLE)) z(pw, zb),
          (VALUES (0.01::DOUBLE), (0.02::DOUBLE), (0.03::DOUBLE)) e(d))))""",
)
_CHI = """
    WITH o AS (SELECT category AS a, returned_item_flag AS b, COUNT(*)::DOUBLE AS n FROM w_items
               WHERE return_observation_eligible_flag = 1 GROUP BY ALL),
      e AS (SELECT a, b, n, SUM(n) OVER (PARTITION BY a) * SUM(n) OVER (PARTITION BY b) / SUM(n) OVER () AS x, SUM(n) OVER () AS t FROM o)
    SELECT SUM((n - x) * (n - x) / x) AS chi_square, CAST((COUNT(DISTINCT a) - 1) * (COUNT(DISTINCT b) - 1) AS INTEGER) AS dof,
      sqrt(SUM((n - x) * (n - x) / x) / MAX(t) / least(COUNT(DISTINCT a) - 1, COUNT(DISTINCT b) - 1)) AS cramers_v FROM e"""
_KRUSKAL = """
    WITH x AS (SELECT distribution_center_id AS g, ship_lead_days AS v FROM w_items
               WHERE valid_timeline_flag = 1 AND ship_lead_days IS NOT NULL
               QUALIFY COUNT(*) OVER (PARTITION BY distribution_center_id) >= 30),
      r AS (SELECT g, v, rank() OVER (ORDER BY v) + (COUNT(*) OVER (PARTITION BY v) - 1) / 2.0::DOUBLE AS rk, COUNT(*) OVER () AS n FROM x),
      s AS (SELECT SUM(q * q / m) AS s, COUNT(*) AS k, MAX(n)::DOUBLE AS n FROM (SELECT g, SUM(rk) AS q, COUNT(*) AS m, MAX(n) AS n FROM r GROUP BY g)),
      t AS (SELECT SUM(c * c * c - c) AS t FROM (SELECT COUNT(*)::DOUBLE AS c FROM x GROUP BY v))
    SELECT (12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - t / (n * n * n - n)) AS statistic, k AS groups, n::BIGINT AS observations FROM s, t"""


def _tail_sql(x, dof):
    """P(chi-square > x): the finite sums with log-gamma, and the error function in its two expansions."""
    h, down = f"({x} / 2)", "list_transform(range(80, 0, -1), lambda k: k::DOUBLE)"
    series = f"list_reduce(list_prepend(1::DOUBLE, {down}), lambda a, n: 1 + a * {h} * 2 / (2 * n + 1))"
    fraction = f"list_reduce(list_prepend(0::DOUBLE, {down}), lambda a, n: n / (2 * {h}) / (a + 1))"
    root = f"CASE WHEN {h} < 3 THEN 1 - 2 * sqrt({h} / pi()) * exp(-{h}) * {series} ELSE exp(-{h}) / sqrt({h} * pi()) / ({fraction} + 1) END"
    terms = f"list_transform(range(0, {dof} // 2), lambda i: exp((i + {dof} % 2 / 2) * ln({h}) - {h} - lgamma(i + {dof} % 2 / 2 + 1)))"
    return f"least(1, COALESCE(list_sum({terms}), 0) + CASE WHEN {dof} % 2 = 1 THEN {root} ELSE 0 END)"


register("L18_chi_square", lambda w: experiments.returns_by_category(w.wide_order_item, w.dim_product).drop("p_value"), _CHI,
         rounded=["chi_square", "cramers_v"])
register("L19_kruskal_wallis", lambda w: experiments.ship_lead_by_center(w.wide_order_item).drop("p_value"), _KRUSKAL,
         rounded=["statistic"])
register(
    "L18_chi_square_p_value",
    lambda w: experiments.returns_by_category(w.wide_order_item, w.dim_product),
    f"SELECT *, {_tail_sql('chi_square', 'dof')} AS p_value FROM ({_CHI})",
    rounded=["chi_square", "cramers_v", "p_value"],
)
register(
    "L19_kruskal_wallis_p_value",
    lambda w: experiments.ship_lead_by_center(w.wide_order_item),
    f"SELECT *, {_tail_sql('statistic', '(groups - 1)')} AS p_value FROM ({_KRUSKAL})",
    rounded=["statistic", "p_value"],
)

# --- forecasts ---------------------------------------------------------------

CLOSED = (forecasting.NAIVE, forecasting.DRIFT)


def _series(w):
    return forecasting.monthly_series(w.sales_monthly)


def _backtest(w, models=CLOSED, weights=None):
    return forecasting.backtest(_series(w), end=FORECAST_END, models=models, weights=weights)


def _monthly(w, models=CLOSED, weights=None):
    best = forecasting.champion(forecasting.forecast_accuracy(_backtest(w, models, weights)))
    return forecasting.forecast_monthly(forecasting.forecast(_series(w), FORECAST_END, models, weights=weights), best)


def _outlook(w, models=CLOSED, weights=None):
    return forecasting.forecast_vs_plan(w.fact_plan, _monthly(w, models, weights), w.actual_country_month)


FORECAST_PARTS = {
    "w_series": "SELECT month_start, net_sales_value, net_margin_rate, row_number() OVER (ORDER BY month_start) - 1 AS i FROM w_sales WHERE is_complete_month = 1",
    "w_len": f"SELECT COUNT(*) AS n, date_diff('month', MAX(month_start), DATE '{FORECAST_END}') AS h, MAX(month_start) AS m FROM w_series",
    "w_steps": "SELECT unnest(range(0, h)) AS s, n, h, m FROM w_len",
    "w_drift": """SELECT o, CASE WHEN b.net_sales_value > 0 THEN greatest(0.5::DOUBLE, least(2.5::DOUBLE, a.net_sales_value / b.net_sales_value))
        ELSE 1.0::DOUBLE END AS d
      FROM (SELECT unnest(range(0, least(24 + h - 1, n - 25) + 1)) AS o, n FROM w_len)
      JOIN w_series a ON a.i = n - o - 1 JOIN w_series b ON b.i = n - o - 13""",
    "w_future": """SELECT model, CAST(m + to_months((s + 1)::INTEGER) AS DATE) AS month_start, (s + 1)::INTEGER AS step,
        CASE model WHEN 'seasonal_naive' THEN x.net_sales_value ELSE x.net_sales_value * d END AS forecast_net_sales_usd
      FROM w_steps JOIN w_series x ON x.i = n - 12 + s % 12 JOIN w_drift ON o = 0,
        (VALUES ('seasonal_naive'), ('seasonal_naive_drift')) k(model)""",
    "w_backtest": """SELECT model, f.month_start AS origin_month, y.month_start AS target_month, (s + 1)::INTEGER AS step, y.net_sales_value AS actual,
        CASE model WHEN 'seasonal_naive' THEN x.net_sales_value ELSE x.net_sales_value * d END AS predicted, h AS horizon
      FROM w_steps JOIN w_drift ON o >= h JOIN w_series x ON x.i = n - o - 12 + s % 12 JOIN w_series y ON y.i = n - o + s
      JOIN w_series f ON f.i = n - o, (VALUES ('seasonal_naive'), ('seasonal_naive_drift')) k(model)""",
    "w_detail": "SELECT * REPLACE (horizon::INTEGER AS horizon), abs(predicted - actual) / NULLIF(actual, 0) AS absolute_percentage_error FROM w_backtest",
    "w_accuracy": """SELECT model, AVG(absolute_percentage_error) AS mape, AVG(absolute_percentage_error) FILTER (step = 1) AS mape_first_step,
        AVG(absolute_percentage_error) FILTER (step = horizon) AS mape_final_step, MAX(absolute_percentage_error) AS worst_month_ape,
        AVG(predicted / NULLIF(actual, 0) - 1) AS bias, MAX(horizon) AS horizon, COUNT(DISTINCT origin_month) AS origins, COUNT(*) AS folds
      FROM w_detail GROUP BY model""",
    "w_best": "SELECT month_start, forecast_net_sales_usd, model FROM w_future WHERE model = (SELECT arg_min(model, mape) FROM w_accuracy)",
    "w_scenarios": """SELECT scenario, month_start, forecast_net_sales_usd * v AS forecast_net_sales_usd, g + d / 100 AS assumed_margin_rate,
        forecast_net_sales_usd * v * (g + d / 100) AS forecast_net_profit_usd, v AS volume_multiplier, d AS margin_delta_pp, narrative
      FROM w_best, (SELECT arg_max(net_margin_rate, month_start) AS g FROM w_series), (VALUES """
    + ", ".join(f"('{n}', {v}::DOUBLE, {d}::DOUBLE, '{t}')" for n, v, d, t in forecasting.SCENARIOS)
    + ") k(scenario, v, d, narrative)",
    "w_shares": """SELECT canonical_country, SUM(net_sales_value)::DOUBLE / (SUM(SUM(net_sales_value)) OVER ())::DOUBLE AS share
      FROM w_market_months WHERE is_complete_month = 1 AND month_start > (SELECT MAX(month_start) FROM w_market_months
        WHERE is_complete_month = 1) - INTERVAL 6 MONTH GROUP BY 1""",
    "w_split": "SELECT month_start, canonical_country, share AS allocation_share, forecast_net_sales_usd * share AS forecast_net_sales_usd FROM w_best, w_shares",
    "w_outlook": """SELECT COALESCE(p.plan_month, f.month_start, a.m) AS month_start, a.v AS actual_net_sales_usd, f.forecast_net_sales_usd,
        COALESCE(a.v, f.forecast_net_sales_usd) AS expected_net_sales_usd, p.plan_net_sales_usd,
        CASE WHEN a.v IS NULL THEN 'Forecast' ELSE 'Actual' END AS basis,
        COALESCE(a.v, f.forecast_net_sales_usd) - p.plan_net_sales_usd AS gap_to_plan_usd,
        CASE WHEN p.plan_net_sales_usd > 0 THEN COALESCE(a.v, f.forecast_net_sales_usd) / p.plan_net_sales_usd END AS expected_achievement_rate
      FROM w_plan_months p FULL JOIN w_best f ON f.month_start = p.plan_month
      FULL JOIN (SELECT month_start AS m, SUM(net_sales_value)::DOUBLE AS v FROM w_market_months WHERE is_complete_month = 1 GROUP BY 1) a
        ON a.m = p.plan_month
      WHERE COALESCE(p.plan_month, f.month_start, a.m) >= (SELECT MIN(plan_month) FROM w_targets)""",
}


def _forecast(key, build, sql=None, **kw):
    register(key, build, sql, parts=FORECAST_PARTS, **kw)


_DECAY = (
    "SELECT step, "
    + ", ".join(f"round(AVG(absolute_percentage_error) FILTER (model = '{m}') * 100, 1) AS {m}_pct" for m in forecasting.MODELS)
    + ", COUNT(*) AS folds FROM w_detail GROUP BY step"
)
_TIE = """SELECT b.month_start, round(FIRST(b.forecast_net_sales_usd), 2) AS total, round(SUM(s.forecast_net_sales_usd), 2) AS allocated_to_markets,
    round(SUM(s.forecast_net_sales_usd) - FIRST(b.forecast_net_sales_usd), 6) + 0.0 AS delta
  FROM w_best b JOIN w_split s ON s.month_start = b.month_start GROUP BY 1"""
_LANDING = f"""SELECT SUM(e)::DOUBLE AS expected_full_period, SUM(p)::DOUBLE AS plan_full_period, {ratio('SUM(e)', 'SUM(p)')} AS achievement
  FROM (SELECT CAST(expected_net_sales_usd AS DECIMAL(18,4)) AS e, CAST(plan_net_sales_usd AS DECIMAL(18,4)) AS p
        FROM w_outlook WHERE plan_net_sales_usd IS NOT NULL)"""
_ALT = """SELECT model, AVG(2 * abs(predicted - actual) / (abs(predicted) + abs(actual))) AS smape,
    sqrt(AVG((predicted - actual) * (predicted - actual))) / AVG(actual) AS rmse_pct,
    quantile_cont(absolute_percentage_error, 0.5) AS median_ape FROM w_detail GROUP BY model"""
_errors = ["mape", "mape_first_step", "mape_final_step", "worst_month_ape", "bias"]
_forecast("N01_monthly_series", _series, "SELECT month_start, net_sales_value, net_margin_rate FROM w_series")
_forecast("N02_seasonal_naive", lambda w: forecasting.forecast(_series(w), FORECAST_END, [forecasting.NAIVE]),
          "SELECT * FROM w_future WHERE model = 'seasonal_naive'")
_forecast("N03_seasonal_naive_drift", lambda w: forecasting.forecast(_series(w), FORECAST_END, [forecasting.DRIFT]),
          "SELECT * FROM w_future WHERE model = 'seasonal_naive_drift'", rounded=["forecast_net_sales_usd"])
_forecast("N04_holt_winters_log", lambda w: forecasting.forecast(_series(w), FORECAST_END, [forecasting.SMOOTH]))
_forecast("N05_backtest", _backtest, "SELECT * FROM w_detail", rounded=["predicted", "absolute_percentage_error"])
_forecast("N05_backtest_all_models", lambda w: _backtest(w, forecasting.MODELS))
_forecast("N06_forecast_accuracy", lambda w: forecasting.forecast_accuracy(_backtest(w)), "SELECT * FROM w_accuracy", rounded=_errors)
_forecast("N06_forecast_accuracy_all_models", lambda w: forecasting.forecast_accuracy(_backtest(w, forecasting.MODELS)))
_forecast("N07_forecast_monthly", _monthly, "SELECT * FROM w_best", rounded=["forecast_net_sales_usd"])
_forecast("N07_forecast_monthly_all_models", lambda w: _monthly(w, forecasting.MODELS))
_forecast("N08_forecast_scenarios", lambda w: forecasting.forecast_scenarios(_monthly(w), _series(w)), "SELECT * FROM w_scenarios",
          rounded=["forecast_net_sales_usd", "forecast_net_profit_usd", "assumed_margin_rate"], digits=4)
_forecast("N09_forecast_country_month", lambda w: forecasting.forecast_country_month(_monthly(w), w.actual_country_month),
          "SELECT * FROM w_split", rounded=["forecast_net_sales_usd"], digits=4)
_forecast("N10_forecast_vs_plan", _outlook, "SELECT * FROM w_outlook",
          rounded=["forecast_net_sales_usd", "expected_net_sales_usd", "gap_to_plan_usd"], digits=4)
_forecast("N11_horizon_decay", lambda w: forecasting.horizon_decay(_backtest(w)),
          _DECAY)
_forecast("N12_allocation_tie",
          lambda w: forecasting.allocation_tie(_monthly(w), forecasting.forecast_country_month(_monthly(w), w.actual_country_month)),
          _TIE, rounded=["delta"], digits=4)
_forecast("N13_landing_achievement", lambda w: forecasting.landing_achievement(_outlook(w)),
          _LANDING)
_forecast("N14_alt_errors", lambda w: forecasting.alt_errors(_backtest(w)),
          _ALT, rounded=["smape", "rmse_pct", "median_ape"])


def _countries(w, monthly):
    return forecasting.forecast_country_month(monthly, w.actual_country_month)


# The whole set with searched Holt-Winters weights, a search that SQL cannot follow; the names without suffix choose between the closed forms.
_ALL = forecasting.MODELS
_forecast("N08_forecast_scenarios_all_models", lambda w: forecasting.forecast_scenarios(_monthly(w, _ALL), _series(w)))
_forecast("N09_forecast_country_month_all_models", lambda w: _countries(w, _monthly(w, _ALL)))
_forecast("N10_forecast_vs_plan_all_models", lambda w: _outlook(w, _ALL))
_forecast("N11_horizon_decay_all_models", lambda w: forecasting.horizon_decay(_backtest(w, _ALL)))
_forecast("N12_allocation_tie_all_models",
          lambda w: forecasting.allocation_tie(_monthly(w, _ALL), _countries(w, _monthly(w, _ALL))))
_forecast("N13_landing_achievement_all_models", lambda w: forecasting.landing_achievement(_outlook(w, _ALL)))
_forecast("N14_alt_errors_all_models", lambda w: forecasting.alt_errors(_backtest(w, _ALL)))

# The whole set again with Holt-Winters weights from a table: the same fold and choice, which SQL follows month by month.
SMOOTHING = (0.2, 0.02, 0.3)
_GRID = (0.1, 0.3, 0.5, 0.7, 0.9)
_KEPT = ("alpha", "beta", "gamma")


def _stored_smoothing(w):
    return _series(w).sparkSession.range(1).select(*[F.lit(v).alias(c) for c, v in zip(_KEPT, SMOOTHING)])


def _weight_grid(w):
    out = _series(w).sparkSession.range(1)
    for c in _KEPT:
        out = out.withColumn(c, F.explode(F.array(*[F.lit(v) for v in _GRID])))
    return out.drop("id")


def _fit_certificate(w):
    """Squared error of the searched weights against the best of the grid."""
    series = _series(w)
    fitted = forecasting.smoothing_error(series, forecasting.smoothing_weights(series)).agg(F.min("squared_error")).scalar()
    grid = forecasting.smoothing_error(series, _weight_grid(w))
    return grid.agg(F.max("months").alias("months"), F.min("squared_error").alias("grid_error")).withColumn(
        "fit_not_worse", fitted <= F.col("grid_error")
    )


def _folded_sql(sets):
    """State after every month for each weight set of the relation ``sets`` (a, b, g)."""
    return f"""WITH RECURSIVE logs AS (SELECT i, ln(greatest(net_sales_value::DOUBLE, 1.0::DOUBLE)) AS y FROM w_series),
      means AS (SELECT AVG(y) FILTER (i < 12) AS m, (AVG(y) FILTER (i BETWEEN 12 AND 23) - AVG(y) FILTER (i < 12)) / 12 AS t FROM logs),
      begun AS (SELECT m - t * 6.5 AS level, t AS trend, list(y - m - t * (i - 5.5) ORDER BY i) AS season
        FROM logs, means WHERE i < 12 GROUP BY m, t),
      walk AS (
        SELECT a, b, g, 0::BIGINT AS n, level, trend, season, 0::DOUBLE AS error FROM begun, ({sets})
        UNION ALL
        SELECT a, b, g, n + 1, now, b * (now - level) + (1 - b) * trend, list_append(season[2:12], g * (y - now) + (1 - g) * season[1]),
          error + (y - (level + trend + season[1])) * (y - (level + trend + season[1]))
        FROM (SELECT walk.*, y, a * (y - season[1]) + (1 - a) * (level + trend) AS now FROM walk JOIN logs ON logs.i = walk.n)
      )
    SELECT * FROM walk"""


_given = ", ".join(f"{v}::DOUBLE AS {c}" for c, v in zip("abg", SMOOTHING))
_levels = ", ".join(f"({v}::DOUBLE)" for v in _GRID)
SMOOTHED_PARTS = FORECAST_PARTS | {
    "w_folded": _folded_sql(f"SELECT {_given}"),
    "w_grid": _folded_sql("SELECT a, b, g FROM " + ", ".join(f"(VALUES {_levels}) v{c}({c})" for c in "abg"))
    + " WHERE n = (SELECT n FROM w_len)",
    "w_closed_future": FORECAST_PARTS["w_future"],
    "w_closed_backtest": FORECAST_PARTS["w_backtest"],
    "w_future": """SELECT * FROM w_closed_future UNION ALL
      SELECT 'holt_winters_log', CAST(m + to_months((s + 1)::INTEGER) AS DATE), (s + 1)::INTEGER, exp(level + trend * (s + 1) + season[1 + s % 12])
      FROM w_steps JOIN w_folded USING (n)""",
    "w_backtest": """SELECT * FROM w_closed_backtest UNION ALL
      SELECT 'holt_winters_log', f.month_start, y.month_start, (s + 1)::INTEGER, y.net_sales_value, exp(level + trend * (s + 1) + season[1 + s % 12]), h
      FROM w_steps JOIN w_drift ON o >= h JOIN w_folded k ON k.n = w_steps.n - o JOIN w_series y ON y.i = w_steps.n - o + s
      JOIN w_series f ON f.i = w_steps.n - o""",
}


def _smoothed(key, build, sql, **kw):
    """Register a query whose smoothing weights come from the stored table; ``build`` gets models and weights."""
    register(f"{key}_stored_weights", lambda w: build(w, (_ALL, _stored_smoothing(w))), sql, parts=SMOOTHED_PARTS, **kw)


_smoothed("N04_holt_winters_log",
          lambda w, m: forecasting.forecast(_series(w), FORECAST_END, [forecasting.SMOOTH], weights=m[1]),
          "SELECT * FROM w_future WHERE model = 'holt_winters_log'", rounded=["forecast_net_sales_usd"], digits=3)
_smoothed("N05_backtest_all_models", lambda w, m: _backtest(w, *m), "SELECT * FROM w_detail",
          rounded=["predicted", "absolute_percentage_error"], digits=3)
_smoothed("N06_forecast_accuracy_all_models", lambda w, m: forecasting.forecast_accuracy(_backtest(w, *m)), "SELECT * FROM w_accuracy",
          rounded=_errors)
_smoothed("N07_forecast_monthly_all_models", lambda w, m: _monthly(w, *m), "SELECT * FROM w_best", rounded=["forecast_net_sales_usd"], digits=3)
_smoothed("N08_forecast_scenarios_all_models", lambda w, m: forecasting.forecast_scenarios(_monthly(w, *m), _series(w)),
          "SELECT * FROM w_scenarios", rounded=["forecast_net_sales_usd", "forecast_net_profit_usd", "assumed_margin_rate"], digits=3)
_smoothed("N09_forecast_country_month_all_models", lambda w, m: _countries(w, _monthly(w, *m)), "SELECT * FROM w_split",
          rounded=["forecast_net_sales_usd", "allocation_share"], digits=3)
_smoothed("N10_forecast_vs_plan_all_models", lambda w, m: _outlook(w, *m), "SELECT * FROM w_outlook",
          rounded=["forecast_net_sales_usd", "expected_net_sales_usd", "gap_to_plan_usd", "expected_achievement_rate"], digits=3)
_smoothed("N11_horizon_decay_all_models", lambda w, m: forecasting.horizon_decay(_backtest(w, *m)), _DECAY)
_smoothed("N12_allocation_tie_all_models",
          lambda w, m: forecasting.allocation_tie(_monthly(w, *m), _countries(w, _monthly(w, *m))), _TIE, rounded=["delta"], digits=4)
_smoothed("N13_landing_achievement_all_models", lambda w, m: forecasting.landing_achievement(_outlook(w, *m)), _LANDING,
          rounded=["expected_full_period", "plan_full_period", "achievement"], digits=3)
_smoothed("N14_alt_errors_all_models", lambda w, m: forecasting.alt_errors(_backtest(w, *m)), _ALT, rounded=["smape", "rmse_pct", "median_ape"])
register("N04_weight_grid_errors", lambda w: forecasting.smoothing_error(_series(w), _weight_grid(w)),
         "SELECT a AS alpha, b AS beta, g AS gamma, n::INTEGER AS months, error AS squared_error FROM w_grid",
         parts=SMOOTHED_PARTS, rounded=["squared_error"])
register("N04_fit_certificate", _fit_certificate,
         "SELECT MAX(n)::INTEGER AS months, MIN(error) AS grid_error, TRUE AS fit_not_worse FROM w_grid",
         parts=SMOOTHED_PARTS, rounded=["grid_error"])
