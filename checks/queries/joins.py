"""Joins of predictions, regressors and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import fixed, query
from checks.sqltext import MAPE, r
from checks.tables import PANEL, SERIES
from tidepanel.operators import filters as FL
from tidepanel.operators import joins as J
from tidepanel.operators import windows as W
from tidepanel.operators.evaluation import evaluate
from tidepanel.panel import entity_means


# Predictions start at the cutoff, so earlier actual rows have none.
def _actual_and_pred(t):
    return t.series, t.predictions.where("yhat is not null").select("city", "model", "ds", "yhat")


_T = "series AS s"
_P = "(SELECT city, model, ds, yhat FROM preds WHERE yhat IS NOT NULL) AS p"


@query("join_actual_pred_inner", f"""
SELECT city, ds, {r('y')} AS y, model, {r('yhat')} AS yhat FROM {_T} JOIN {_P} USING (city, ds)""")
def _(t):
    return fixed(J.actual_predicted(*_actual_and_pred(t), PANEL))


@query("join_actual_pred_left", f"""
SELECT city, model, {r(MAPE)} AS mape, count(*) AS n_test FROM {_T} LEFT JOIN {_P} USING (city, ds) GROUP BY city, model""")
def _(t):
    rows = J.actual_predicted(*_actual_and_pred(t), PANEL, "left")
    return fixed(evaluate(rows, ["city", "model"]).select("city", "model", "mape", "n_test"))


@query("join_semi_dates", f"""
SELECT city, model, ds, {r('yhat')} AS yhat FROM {_P}
WHERE EXISTS (SELECT 1 FROM series x WHERE x.city = p.city AND x.ds = p.ds AND x.ds >= DATE '2001-01-01')""")
def _(t):
    _, pred = _actual_and_pred(t)
    return fixed(J.within_dates(pred, FL.since(t.series, "ds", "2001-01-01"), ["city", "ds"]))


@query("join_regressors_inner", f"""
SELECT s.city, s.ds, {r('s.y')} AS y, {r('d.no2')} AS no2, {r('d.co')} AS co
FROM series s JOIN (SELECT date, avg(no2) AS no2, avg(co) AS co FROM daily GROUP BY date) d ON d.date = s.ds""")
def _(t):
    weather = t.daily.groupBy(F.col("date").alias("ds")).agg(F.avg("no2").alias("no2"), F.avg("co").alias("co"))
    return fixed(J.with_regressors(t.series, weather, ["ds"]))


@query("join_regressors_left", f"""
WITH spine AS (SELECT city, unnest(generate_series(max(ds) + 1, max(ds) + 120, INTERVAL 1 DAY)) AS ts
               FROM series GROUP BY city)
SELECT s.city, CAST(s.ts AS DATE) AS ds, {r('d.no2')} AS no2 FROM spine s
LEFT JOIN (SELECT date, avg(no2) AS no2 FROM daily GROUP BY date) d ON d.date = CAST(s.ts AS DATE)""")
def _(t):
    from tidepanel.sources.readers import future_spine

    weather = t.daily.groupBy(F.col("date").alias("ds")).agg(F.avg("no2").alias("no2"))
    return fixed(J.with_regressors(future_spine(t.series, SERIES, 120), weather, ["ds"], "left"))


@query("join_station_dim", f"""
SELECT n.n_name AS place, {r('avg(l.aqi)')} AS mean, count(*) AS n
FROM lines l LEFT JOIN supplier s ON l.station_id = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY 1""")
def _(t):
    stations = t.raw("supplier").select(F.col("s_suppkey").alias("station_id"), "s_nationkey")
    nations = t.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    rows = J.with_dimension(J.with_dimension(t.lines, stations, "station_id"), nations, "s_nationkey")
    return fixed(rows.groupBy(F.col("n_name").alias("place")).agg(
        F.avg("aqi").alias("mean"), F.count("*").alias("n")))


@query("join_ref_integrity", """
SELECT count(*) AS keys, CAST(count_if(NOT EXISTS
  (SELECT 1 FROM supplier s WHERE s.s_suppkey = k AND s.s_acctbal > 0)) AS BIGINT) AS missing
FROM (SELECT DISTINCT station_id AS k FROM lines)""")
def _(t):
    known = t.raw("supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("station_id"))
    return J.unmatched(t.lines, known, "station_id")


@query("join_group_broadcast_back", f"""
SELECT city, ds, {r('y - m')} AS above_mean FROM series
JOIN (SELECT city, avg(y) AS m FROM series GROUP BY city) USING (city)""")
def _(t):
    rows = entity_means(t.series, SERIES, {"m": F.avg("y")})
    return fixed(rows.select("city", "ds", (F.col("y") - F.col("m")).alias("above_mean")))


@query("join_cross_horizon", f"""
SELECT city, CAST(date + CAST(i AS INTEGER) AS DATE) AS ds, {r('aqi')} AS aqi
FROM (SELECT city, max(date) AS date, arg_max(aqi, date) AS aqi FROM daily GROUP BY city),
     range(1, 31) AS g(i)""")
def _(t):
    last = W.last_features(t.daily, PANEL, ["aqi"])
    return fixed(J.over_horizon(last, PANEL, 30).select("city", "ds", "aqi"))


@query("entity_state_means", f"""
SELECT r_name AS region, {r('avg(aqi)')} AS mean, count(*) AS n FROM lines
JOIN supplier ON station_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def _(t):
    """Readings rolled up to the region of their station."""
    dim = (t.raw("supplier").join(t.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
           .join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.col("s_suppkey").alias("station_id"), F.col("r_name").alias("region")))
    rows = J.with_dimension(t.lines, dim, "station_id")
    return fixed(rows.groupBy("region").agg(F.avg("aqi").alias("mean"), F.count("*").alias("n")))
