"""Forecast flows with a plain trend line, whose ridge system SQL solves by Cramer's rule."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from checks.queries.forecasting import HORIZON
from checks.registry import fixed, query
from checks.sqltext import MAE, MAPE, RMSE, r
from checks.tables import CUTOFF, SERIES
from tidepanel.models import trend
from tidepanel.models.trend import TrendModel
from tidepanel.operators import evaluation as E
from tidepanel.operators import filters as FL
from tidepanel.plans import forecasting as FC

LINE = TrendModel(order=0, changes=0)
BROKEN = TrendModel(order=0, changes=1)
CURVE = TrendModel(order=0, changes=0, floor=20.0, cap=500.0, steps=0)
STEPPED = TrendModel(order=0, changes=0, floor=20.0, cap=500.0, steps=2)
_RIDGE = (LINE.noise / LINE.level_scale) ** 2
_Z = NormalDist().inv_cdf(0.5 + LINE.interval / 2)
_T = "((ds - t0) / greatest(span, 1))"


def _fit(rows: str, keys: str = "city", link: str = "y") -> str:
    """One row per group: line, residual deviation and scaling of ``rows`` (keys, ds, y)."""
    return f"""(
SELECT {keys}, t0, span, scale, n, b0, b1, sqrt(greatest(
    yy - 2 * (b0 * sv + b1 * stv) + b0 * b0 * n + 2 * b0 * b1 * st + b1 * b1 * stt, 0) / n) AS sigma
FROM (SELECT *, ((stt + {_RIDGE}) * sv - st * stv) / det AS b0, ((n + {_RIDGE}) * stv - st * sv) / det AS b1
 FROM (SELECT *, (n + {_RIDGE}) * (stt + {_RIDGE}) - st * st AS det
  FROM (SELECT {keys}, t0, span, scale, CAST(count(*) AS DOUBLE) AS n, sum(t) AS st, sum(t * t) AS stt,
               sum(v) AS sv, sum(t * v) AS stv, sum(v * v) AS yy
   FROM (SELECT {keys}, t0, span, scale, {_T} AS t, ({link}) / scale AS v
    FROM (SELECT * FROM {rows} WHERE y IS NOT NULL)
    JOIN (SELECT {keys}, min(ds) AS t0, CAST(max(ds) - min(ds) AS DOUBLE) AS span,
                 greatest(max(abs({link})), 1e-9) AS scale
          FROM {rows} WHERE y IS NOT NULL GROUP BY {keys}) USING ({keys}))
   GROUP BY {keys}, t0, span, scale))))"""


def _predicted(fit: str, dates: str, keys: str = "city") -> str:
    line, half = f"(b0 + b1 * {_T}) * scale", f"{_Z!r} * sigma * scale"
    return f"""(
SELECT d.*, {line} AS yhat, {line} - {half} AS yhat_lower, {line} + {half} AS yhat_upper
FROM {dates} AS d JOIN {fit} AS f USING ({keys}))"""


def _broken(rows: str) -> str:
    """A line with one change of slope, whose absolute penalty cuts it towards zero."""
    knot, half = BROKEN.change_range / 2, BROKEN.lasso()[2] / 2
    solve = lambda x, y: (f"((stt + {_RIDGE}) * {x} - st * {y}) / det", f"((n + {_RIDGE}) * {y} - st * {x}) / det")
    (c0, c1), (v0, v1) = solve("sh", "sth"), solve("sv", "stv")
    return f"""(
SELECT city, t0, span, scale, b0, b1, d, sqrt(greatest(yy - 2 * (b0 * sv + b1 * stv + d * shv) + b0 * b0 * n + b1 * b1 * stt
    + d * d * shh + 2 * (b0 * b1 * st + b0 * d * sh + b1 * d * sth), 0) / n) AS sigma
FROM (SELECT *, v0 - c0 * d AS b0, v1 - c1 * d AS b1
 FROM (SELECT *, sign(b) * greatest(abs(b) - {half}, 0) / (shh + 1e-9 - c0 * sh - c1 * sth) AS d
  FROM (SELECT *, shv - v0 * sh - v1 * sth AS b
   FROM (SELECT *, {c0} AS c0, {c1} AS c1, {v0} AS v0, {v1} AS v1
    FROM (SELECT *, (n + {_RIDGE}) * (stt + {_RIDGE}) - st * st AS det
     FROM (SELECT city, t0, span, scale, CAST(count(*) AS DOUBLE) AS n, sum(t) AS st, sum(t * t) AS stt, sum(v) AS sv,
                  sum(t * v) AS stv, sum(v * v) AS yy, sum(h) AS sh, sum(h * t) AS sth, sum(h * h) AS shh, sum(h * v) AS shv
      FROM (SELECT *, greatest(t - {knot}, 0) AS h
       FROM (SELECT city, t0, span, scale, {_T} AS t, y / scale AS v
        FROM (SELECT * FROM {rows} WHERE y IS NOT NULL)
        JOIN (SELECT city, min(ds) AS t0, CAST(max(ds) - min(ds) AS DOUBLE) AS span,
                     greatest(max(abs(y)), 1e-9) AS scale
              FROM {rows} WHERE y IS NOT NULL GROUP BY city) USING (city)))
      GROUP BY city, t0, span, scale)))))))"""


_TRAIN = f"(SELECT * FROM series WHERE ds < DATE '{CUTOFF}')"
_TEST = f"(SELECT * FROM series WHERE ds >= DATE '{CUTOFF}')"
_VALID = _predicted(_fit(_TRAIN), _TEST)
_SPINE = f"""(SELECT city, CAST(unnest(generate_series(min(ds), max(ds) + {HORIZON}, INTERVAL 1 DAY)) AS DATE) AS ds
              FROM series GROUP BY city)"""
_AHEAD = _predicted(_fit("series"), _SPINE)
_BOUNDS = f"{r('yhat')} AS yhat, {r('yhat_lower')} AS yhat_lower, {r('yhat_upper')} AS yhat_upper"
_ERRORS = f"{MAPE} AS mape, {RMSE} AS rmse, {MAE} AS mae"


@query("line_fit", f"SELECT city, {r('b0', 6)} AS b0, {r('b1', 6)} AS b1, {r('sigma', 6)} AS sigma FROM {_fit('series')}")
def _(t):
    fits = trend.fit(t.stored_series, SERIES, LINE)
    return fixed(fits.select("city", F.col("beta")[0].alias("b0"), F.col("beta")[1].alias("b1"), "sigma"), 6)


@query("line_validate", f"SELECT city, 'Line' AS model, ds, {r('y')} AS y, {_BOUNDS} FROM {_VALID}")
def _(t):
    return fixed(FC.validate_entities(t.stored_series, SERIES, CUTOFF, LINE, "Line"))


@query("line_forecast", f"SELECT city, ds, {_BOUNDS} FROM {_AHEAD}")
def _(t):
    return fixed(FC.forecast_entities(t.stored_series, SERIES, HORIZON, LINE))


_LOGIT = "ln(least(greatest((y - 20) / 480e0, 1e-3), 0.999e0) / (1 - least(greatest((y - 20) / 480e0, 1e-3), 0.999e0)))"
_CURVE = "20 + 480e0 / (1 + exp(-({x})))"


@query("line_logistic", f"""
SELECT city, ds, {r('y')} AS y, {r(_CURVE.format(x='yhat'))} AS yhat,
       {r(_CURVE.format(x='yhat_lower'))} AS yhat_lower, {r(_CURVE.format(x='yhat_upper'))} AS yhat_upper
FROM {_predicted(_fit(_TRAIN, link=_LOGIT), _TEST)}""")
def _(t):
    fits = trend.fit(FL.before(t.stored_series, "ds", CUTOFF), SERIES, CURVE)
    return fixed(trend.predict(fits, FL.since(t.stored_series, "ds", CUTOFF), SERIES, CURVE))


_ONCE = f"""(
SELECT *, ((tt + {_RIDGE}) * u - x * w) / det AS c0, ((o + {_RIDGE}) * w - x * u) / det AS c1,
       rr + {_RIDGE} * (a0 * a0 + a1 * a1) AS cost
FROM (SELECT *, (o + {_RIDGE}) * (tt + {_RIDGE}) - x * x AS det
 FROM (SELECT city, t0, span, n, a0, a1, sum(g * g) AS o, sum(g * g * t) AS x, sum(g * g * t * t) AS tt,
              sum(g * z) AS u, sum(g * t * z) AS w, sum(v_e * v_e) AS rr
  FROM (SELECT *, v_e + g * (a0 + a1 * t) AS z
   FROM (SELECT *, e * (1 - e) AS g, (y - 20) / 480e0 - e AS v_e
    FROM (SELECT *, 1 / (1 + exp(-(a0 + a1 * t))) AS e
     FROM (SELECT s.city, y, t0, span, n, b0 * scale AS a0, b1 * scale AS a1, {_T} AS t
           FROM {_TRAIN} AS s JOIN {_fit(_TRAIN, link=_LOGIT)} AS f USING (city) WHERE y IS NOT NULL))))
  GROUP BY city, t0, span, n, a0, a1)))"""
_SETTLED = f"""(
SELECT city, t0, span, better, CASE WHEN better THEN c0 ELSE a0 END AS a0, CASE WHEN better THEN c1 ELSE a1 END AS a1,
       sqrt(CASE WHEN better THEN again ELSE rr END / n) AS sigma
FROM (SELECT *, again + {_RIDGE} * (c0 * c0 + c1 * c1) <= cost AS better
 FROM (SELECT city, any_value(t0) AS t0, any_value(span) AS span, any_value(n) AS n, any_value(a0) AS a0, any_value(a1) AS a1,
              any_value(c0) AS c0, any_value(c1) AS c1, any_value(cost) AS cost, any_value(rr) AS rr,
              sum(((y - 20) / 480e0 - 1 / (1 + exp(-(c0 + c1 * {_T})))) ** 2) AS again
       FROM {_TRAIN} AS s JOIN {_ONCE} AS o USING (city) WHERE y IS NOT NULL GROUP BY city)))"""


@query("line_curve", f"""
SELECT city, ds, {r('y')} AS y, {r('20 + 480 * e')} AS yhat,
       {r(f'20 + 480 * least(greatest(e - {_Z!r} * sigma, 0), 1)')} AS yhat_lower,
       {r(f'20 + 480 * least(greatest(e + {_Z!r} * sigma, 0), 1)')} AS yhat_upper
FROM (SELECT city, ds, y, sigma, 1 / (1 + exp(-(a0 + a1 * {_T}))) AS e FROM {_TEST} JOIN {_SETTLED} USING (city))""")
def _(t):
    """A saturating trend after one step from the logit line."""
    fits = trend.fit(FL.before(t.stored_series, "ds", CUTOFF), SERIES, STEPPED)
    return fixed(trend.predict(fits, FL.since(t.stored_series, "ds", CUTOFF), SERIES, STEPPED))


@query("line_change_fit", f"""
SELECT city, {r('b0', 6)} AS b0, {r('b1', 6)} AS b1, {r('d', 6)} AS d, {r('sigma', 6)} AS sigma FROM {_broken('series')}""")
def _(t):
    fits = trend.fit(t.stored_series, SERIES, BROKEN)
    b = [F.col("beta")[i].alias(c) for i, c in enumerate(("b0", "b1", "d"))]
    return fixed(fits.select("city", *b, "sigma"), 6)


@query("line_change_forecast", f"""
SELECT city, ds, {r('yhat')} AS yhat, {r('yhat - half')} AS yhat_lower, {r('yhat + half')} AS yhat_upper
FROM (SELECT city, ds, (b0 + b1 * t + d * greatest(t - {BROKEN.change_range / 2}, 0)) * scale AS yhat,
             {_Z!r} * scale * sqrt(sigma * sigma + 2e0 / 3 * d * d * greatest(t - 1, 0) ** 3) AS half
      FROM (SELECT *, {_T} AS t FROM {_SPINE} JOIN {_broken('series')} USING (city)))""")
def _(t):
    return fixed(FC.forecast_entities(t.stored_series, SERIES, HORIZON, BROKEN))


@query("line_batch", f"""
WITH g AS (SELECT city, count(*) AS days,
                  CASE WHEN count(*) < 1000 THEN 'insufficient_data' WHEN max(ds) < DATE '{CUTOFF}' THEN 'no_recent_data'
                       WHEN count_if(ds >= DATE '{CUTOFF}') < 30 THEN 'insufficient_test' ELSE 'success' END AS status
           FROM series GROUP BY city),
e AS (SELECT city, {_ERRORS} FROM {_VALID} GROUP BY city),
a AS (SELECT city, avg(yhat) AS predicted FROM {_AHEAD} WHERE year(ds) = 2002 GROUP BY city),
n AS (SELECT city, avg(y) AS recent FROM series WHERE ds >= DATE '2001-01-01' GROUP BY city)
SELECT city, status, days, CASE WHEN status = 'success' THEN {r('round(mape, 2)', 1)} END AS mape,
       CASE WHEN status = 'success' THEN {r('round(rmse, 2)', 1)} END AS rmse,
       CASE WHEN status = 'success' THEN {r('round(recent, 1)', 0)} END AS recent,
       CASE WHEN status = 'success' THEN {r('round(predicted, 1)', 0)} END AS predicted,
       CASE WHEN status <> 'success' THEN NULL WHEN recent IS NULL THEN 'unknown'
            WHEN round(predicted, 9) < round(recent, 9) THEN 'improving' ELSE 'worsening' END AS trend
FROM g LEFT JOIN e USING (city) LEFT JOIN a USING (city) LEFT JOIN n USING (city)""")
def _(t):
    got = FC.batch_forecast(t.stored_series, SERIES, CUTOFF, "2001-01-01", 2002, HORIZON, LINE)
    # The reports round themselves; one digit less, so that their last digit decides nothing.
    return fixed(fixed(got, 1, ("recent", "predicted")), 0, ("mape", "rmse"))


@query("line_report", f"""
SELECT city, data_points, {r('current_avg')} AS current_avg, {r('predicted')} AS predicted,
       CASE WHEN current_avg IS NULL THEN 'unknown' WHEN predicted < current_avg THEN 'improving'
            ELSE 'worsening' END AS trend
FROM (SELECT city, count(*) AS data_points, avg(y) FILTER (WHERE year(ds) = 2000) AS current_avg FROM series GROUP BY city)
LEFT JOIN (SELECT city, avg(yhat) AS predicted FROM {_AHEAD} WHERE year(ds) = 2002 GROUP BY city) USING (city)""")
def _(t):
    ahead = FC.forecast_entities(t.stored_series, SERIES, HORIZON, LINE)
    return fixed(FC.forecast_report(t.stored_series, SERIES, ahead, 2000, 2002))


@query("line_report_points", f"""
SELECT city, 'historical' AS part, ds, {r('y')} AS yhat, {r('y')} AS yhat_lower, {r('y')} AS yhat_upper
FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY ds DESC) AS place FROM series) WHERE place <= 1000
UNION ALL
SELECT city, 'forecast', ds, {_BOUNDS} FROM {_AHEAD} JOIN (SELECT city, max(ds) AS last FROM series GROUP BY city) USING (city)
WHERE ds > last""")
def _(t):
    ahead = FC.forecast_entities(t.stored_series, SERIES, HORIZON, LINE)
    return fixed(FC.report_points(t.stored_series, SERIES, ahead, 1000))


_ORIGINS = """(
SELECT city, CAST(k AS INTEGER) AS fold, CAST(b - CAST(365 + 365 * k AS INTEGER) AS DATE) AS cut,
       CAST(b - CAST(365 * k AS INTEGER) AS DATE) AS until
FROM (SELECT city, min(ds) AS a, max(ds) AS b FROM series GROUP BY city), range(0, 20) AS g(k)
WHERE b - CAST(365 + 365 * k AS INTEGER) >= a + 1095)"""
_FOLDS = _predicted(
    _fit(f"(SELECT city, fold, ds, y FROM series JOIN {_ORIGINS} USING (city) WHERE ds <= cut)", "city, fold"),
    f"(SELECT city, fold, ds, y FROM series JOIN {_ORIGINS} USING (city) WHERE ds > cut AND ds <= until)", "city, fold")


@query("line_folds", f"""
SELECT city, count(*) AS folds, {r('avg(mape)')} AS mape, {r('stddev_samp(mape)')} AS mape_std,
       {r('avg(rmse)')} AS rmse, {r('stddev_samp(rmse)')} AS rmse_std, {r('avg(coverage)')} AS coverage
FROM (SELECT city, fold, {_ERRORS},
             avg(CASE WHEN y >= yhat_lower AND y <= yhat_upper THEN 1e0 ELSE 0e0 END) AS coverage
      FROM {_FOLDS} GROUP BY city, fold) GROUP BY city""")
def _(t):
    folds = FC.cross_validation(t.stored_series, SERIES, initial_days=1095, m=LINE)
    return fixed(E.fold_scores(folds, ["city"]))


_ERA = ("1998-03-01", "1999-06-30")
_VARIANT = f"""(
SELECT city, 'Full' AS model, ds, y FROM {_TRAIN}
UNION ALL SELECT city, 'Before era', ds, y FROM {_TRAIN} WHERE ds < DATE '{_ERA[0]}'
UNION ALL SELECT city, 'Skip era', ds, y FROM {_TRAIN} WHERE ds < DATE '{_ERA[0]}' OR ds > DATE '{_ERA[1]}')"""


@query("line_variants", f"""
WITH e AS (SELECT city, model, {_ERRORS} FROM {_predicted(
    _fit(_VARIANT, 'city, model'),
    f"(SELECT city, model, ds, y FROM {_TEST}, (SELECT DISTINCT model FROM {_VARIANT}))", 'city, model')} GROUP BY city, model),
b AS (SELECT city, arg_min(model, mape) AS best FROM e GROUP BY city)
SELECT city, model, {r('mape')} AS mape, {r('rmse')} AS rmse, {r('mae')} AS mae,
       {r('100 * (1 - mape / 100)')} AS low, {r('100 * (1 + mape / 100)')} AS high, model = best AS selected
FROM e JOIN b USING (city)""")
def _(t):
    return fixed(FC.training_variants(t.stored_series, SERIES, CUTOFF, _ERA, LINE))


@query("line_horizon_range", f"""
SELECT city, {r('level')} AS level, {r('lo')} AS lower, {r('hi')} AS upper,
       {r('level * (1 - mape / 100)')} AS expected_low, {r('level * (1 + mape / 100)')} AS expected_high
FROM (SELECT city, avg(yhat) AS level, avg(yhat_lower) AS lo, avg(yhat_upper) AS hi FROM {_AHEAD}
      WHERE year(ds) = 2002 GROUP BY city)
JOIN (SELECT city, {MAPE} AS mape FROM {_VALID} GROUP BY city) USING (city)""")
def _(t):
    errors = E.evaluate(FC.validate_entities(t.stored_series, SERIES, CUTOFF, LINE), ["city"])
    ahead = FC.forecast_entities(t.stored_series, SERIES, HORIZON, LINE)
    return fixed(FC.expected_horizon_range(ahead, errors.select("city", "mape"), SERIES, 2002))


@query("line_report_validation", f"""
SELECT city, CASE WHEN test_days < 30 THEN 'insufficient_test' WHEN mape IS NULL THEN 'invalid_mape' ELSE 'ok' END AS status,
       CASE WHEN test_days >= 30 THEN {r('round(mape, 2)', 1)} END AS mape, CASE WHEN test_days >= 30 THEN {r('round(rmse, 2)', 1)} END AS rmse,
       CASE WHEN test_days >= 30 THEN {r('round(mae, 2)', 1)} END AS mae, train_days, test_days
FROM (SELECT city, count_if(ds < DATE '{CUTOFF}')::BIGINT AS train_days, count_if(ds >= DATE '{CUTOFF}')::BIGINT AS test_days
      FROM series GROUP BY city) LEFT JOIN (SELECT city, {_ERRORS} FROM {_VALID} GROUP BY city) USING (city)""")
def _(t):
    return fixed(FC.validation_report(t.stored_series, SERIES, CUTOFF, LINE).drop("quality"), 1)
