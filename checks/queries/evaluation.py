"""Error measures and breakdowns."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as T
from checks.registry import fixed, query
from checks.sqltext import MAE, MAPE, RMSE, r
from checks.tables import PANEL
from tidepanel.operators import aggregates as A
from tidepanel.operators import evaluation as E
from tidepanel.plans import forecasting as P

# Every event's value against its index: large groups, zero actuals among them.
_PAIRS = f"SELECT event_type AS city, value AS y, {T.pm25('value')} AS yhat FROM events"


def _pairs(t):
    return t.readings.select("city", F.col("pm2_5").alias("y"), F.col("aqi").alias("yhat"))


@query("mape", f"SELECT city, {r(MAPE)} AS mape FROM ({_PAIRS}) GROUP BY city")
def _(t):
    return fixed(_pairs(t).groupBy("city").agg(E.mape().alias("mape")))


@query("rmse", f"SELECT city, {r(RMSE)} AS rmse FROM ({_PAIRS}) GROUP BY city")
def _(t):
    return fixed(_pairs(t).groupBy("city").agg(E.rmse().alias("rmse")))


@query("mae", f"SELECT city, {r(MAE)} AS mae FROM ({_PAIRS}) GROUP BY city")
def _(t):
    return fixed(_pairs(t).groupBy("city").agg(E.mae().alias("mae")))


_SCORES = f"{r(MAPE)} AS mape, {r(RMSE)} AS rmse, {r(MAE)} AS mae, count(*) AS n_test"


@query("evaluate_forecast", f"SELECT city, {_SCORES} FROM ({_PAIRS}) GROUP BY city")
def _(t):
    return fixed(E.evaluate(_pairs(t), ["city"]))


@query("evaluate_baselines", f"SELECT city, model, {_SCORES} FROM preds GROUP BY city, model")
def _(t):
    return fixed(t.metrics)


@query("cross_entity_eval", f"""
SELECT city, model, {_SCORES} FROM preds
WHERE city IN (SELECT city FROM series GROUP BY city HAVING count(*) >= 200) GROUP BY city, model""")
def _(t):
    from checks.tables import CUTOFF, SERIES
    from tidepanel.operators import windows as W

    big = E.large_enough(t.series, PANEL)
    rows = W.moving_average(big, SERIES, CUTOFF).unionByName(W.seasonal_naive(big, SERIES, CUTOFF))
    return fixed(E.evaluate(rows, ["city", "model"]))


_REL = """SELECT *, y - yhat AS err, abs(y - yhat) / (y + 1) * 100 AS ape FROM preds
WHERE y IS NOT NULL AND yhat IS NOT NULL"""
_PARTS = f"count(*) AS count, {r('avg(ape)')} AS mape, {r('avg(err)')} AS bias"


@query("error_by_band", f"""
SELECT city, model, {T.band('y')} AS band, {_PARTS} FROM ({_REL}) GROUP BY 1, 2, 3""")
def _(t):
    return fixed(E.error_by_band(t.predictions, ["city", "model"]))


@query("error_by_season", f"""
SELECT city, model, {T.error_seasons('month(ds)')} AS season, {_PARTS} FROM ({_REL}) GROUP BY 1, 2, 3""")
def _(t):
    return fixed(E.error_by_season(t.predictions, ["city", "model"]))


@query("error_overall", f"""
SELECT city, model, {r('avg(ape)')} AS overall_mape, {r('avg(err)')} AS overall_bias,
       arg_max(ds, ape) AS worst_ds, arg_min(ds, ape) AS best_ds FROM ({_REL}) GROUP BY 1, 2""")
def _(t):
    return fixed(E.error_overall(t.predictions, ["city", "model"]))


@query("cv_summary", f"""
WITH f AS (SELECT city, model, year(ds) AS fold, {MAPE} AS mape, {RMSE} AS rmse,
                  avg(CASE WHEN y >= yhat * 0.8 AND y <= yhat * 1.2 THEN 1e0
                           WHEN yhat IS NOT NULL AND y IS NOT NULL THEN 0e0 END) AS cov
           FROM preds GROUP BY 1, 2, 3)
SELECT city, model, count(*) AS folds, {r('avg(mape)')} AS mape, {r('stddev_samp(mape)')} AS mape_std,
       {r('avg(rmse)')} AS rmse, {r('stddev_samp(rmse)')} AS rmse_std, {r('avg(cov)')} AS coverage
FROM f GROUP BY 1, 2""")
def _(t):
    rows = E.error_band(t.predictions).withColumnsRenamed(
        {"band_low": "yhat_lower", "band_high": "yhat_upper"}).withColumn("fold", F.year("ds"))
    return fixed(E.fold_scores(rows, ["city", "model"]))


@query("model_compare", f"""
WITH b AS (SELECT city, max(CASE WHEN model = 'Seasonal Naive' THEN mape END) AS base,
                  arg_min(model, mape) AS best FROM metrics GROUP BY city)
SELECT city, model, {r('mape')} AS mape, {r('(base - mape) / nullif(base, 0) * 100')} AS gain_pct,
       model = best AS selected FROM metrics JOIN b USING (city)""")
def _(t):
    return fixed(E.improvement(t.metrics, ["city"], "Seasonal Naive"))


@query("expected_range", f"""
SELECT city, model, {r('100 * (1 - mape / 100)')} AS low, {r('100 * (1 + mape / 100)')} AS high FROM metrics""")
def _(t):
    low, high = E.expected_range(F.lit(100.0), "mape")
    return fixed(t.metrics.select("city", "model", low.alias("low"), high.alias("high")))


@query("error_band", f"""
SELECT city, model, ds, {r('yhat * 0.8')} AS band_low, {r('yhat * 1.2')} AS band_high FROM preds""")
def _(t):
    return fixed(E.error_band(t.predictions).drop("y", "yhat"))


_BATCH = f"""
SELECT city, model, {r('mape', 2)} AS mape,
       CASE WHEN p IS NULL OR a IS NULL THEN 'unknown' WHEN p < a THEN 'improving' ELSE 'worsening' END AS trend
FROM metrics JOIN (SELECT city, model, avg(yhat) AS p, avg(y) AS a FROM preds GROUP BY city, model) USING (city, model)"""


@query("batch_summary", f"""
WITH b AS ({_BATCH})
SELECT model, count(*) AS entities, {r('avg(mape)')} AS mean_mape, {r('min(mape)')} AS min_mape,
       {r('max(mape)')} AS max_mape, min(CASE WHEN up = 1 THEN city END) AS best, min(CASE WHEN down = 1 THEN city END) AS worst,
       CAST(count_if(trend = 'improving') AS BIGINT) AS improving,
       CAST(count_if(trend = 'worsening') AS BIGINT) AS worsening,
       {r("count_if(trend = 'improving') * 100e0 / count(*)")} AS improving_pct,
       {r("count_if(trend = 'worsening') * 100e0 / count(*)")} AS worsening_pct
FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mape, city) AS up,
             row_number() OVER (PARTITION BY model ORDER BY mape DESC, city) AS down FROM b) GROUP BY model""")
def _(t):
    from tidepanel.functions import scalars as S

    rows = t.predictions.groupBy("city", "model").agg(E.mape().alias("mape"), F.avg("yhat").alias("p"),
                                                      F.avg("y").alias("a"))
    batch = rows.select("city", "model", F.round(F.col("mape") + 1e-9, 2).alias("mape"),
                        S.trend_label("p", "a").alias("trend"))
    return fixed(A.batch_summary(batch, PANEL, ["model"]))


@query("comparison_report", f"""
SELECT city, model, {r('mape')} AS mape, {r('a')} AS year_avg,
       CASE WHEN mape < 20 THEN 'High' WHEN mape < 30 THEN 'Medium' ELSE 'Low' END AS data_quality
FROM metrics LEFT JOIN (SELECT city, avg(y) AS a FROM series WHERE year(ds) = 2000 GROUP BY city)
USING (city) WHERE n_test > 30""")
def _(t):
    return fixed(P.comparison_report(t.predictions, t.series, PANEL, 2000, by=["model"]))


@query("validation_rows", f"""
SELECT city, model, CASE WHEN test_days < 30 THEN 'insufficient_test' WHEN mape IS NULL THEN 'invalid_mape'
       ELSE 'ok' END AS status, {r('mape', 2)} AS mape, {r('rmse', 2)} AS rmse, {r('mae', 2)} AS mae,
       {T.quality('mape')} AS quality, train_days, test_days
FROM metrics JOIN (SELECT city, CAST(count_if(ds < DATE '2000-01-01') AS BIGINT) AS train_days,
                          CAST(count_if(ds >= DATE '2000-01-01') AS BIGINT) AS test_days
                   FROM series GROUP BY city) USING (city)""")
def _(t):
    """The validation report's shaping over the baselines' errors."""
    from checks.tables import CUTOFF

    sizes = P._sizes(t.series, PANEL, CUTOFF)
    return P.report_rows(sizes.join(t.metrics, "city"), PANEL, by=["model"])
