"""Row-frame operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import fixed, query
from checks.sqltext import r
from checks.tables import CUTOFF, EVENT_BLOCKS, EVENTS, PANEL, SERIES
from tidepanel.operators import windows as W

_W = "PARTITION BY city ORDER BY date"
_LAGS = ", ".join(f"{r(f'lag({c}, {n}) OVER ({_W})')} AS {c}_lag{n}"
                  for c in ("aqi", "pm2_5", "no2", "co", "o3") for n in (1, 2, 3, 7))


@query("add_lags", f"SELECT city, date, {_LAGS} FROM daily")
def _(t):
    out = W.add_lags(t.daily, PANEL)
    return fixed(out.select("city", "date", *[c for c in out.columns if "_lag" in c]))


def rolls(columns, widths, order, ahead=0):
    out = []
    for c in columns:
        for n in widths:
            f = f"OVER (PARTITION BY city ORDER BY {order} ROWS BETWEEN {n - 1 + ahead} PRECEDING AND " \
                + ("CURRENT ROW)" if not ahead else f"{ahead} PRECEDING)")
            out += [f"{r(f'avg({c}) {f}')} AS {c}_roll{n}_mean",
                    f"{r(f'coalesce(stddev_samp({c}) {f}, 0)')} AS {c}_roll{n}_std",
                    f"{r(f'max({c}) {f}')} AS {c}_roll{n}_max"]
    return ", ".join(out)


@query("add_rolling", f"""
SELECT city, date, {rolls(('aqi', 'pm2_5'), (3, 7, 30), 'date')} FROM daily""")
def _(t):
    out = W.add_rolling(t.daily, PANEL)
    return fixed(out.select("city", "date", *[c for c in out.columns if "_roll" in c]))


@query("long_lags_and_min", f"""
SELECT city, date, {r(f'lag(aqi, 30) OVER ({_W})')} AS aqi_lag30, {r(f'lag(aqi, 365) OVER ({_W})')} AS aqi_lag365,
       {r(f'min(aqi) OVER ({_W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS aqi_roll7_min FROM daily""")
def _(t):
    rows = W.add_lags(t.daily.select("city", "date", "aqi"), PANEL, ["aqi"], [30, 365])
    return fixed(W.add_rolling_min(rows, PANEL, ["aqi"], [7]).drop("aqi"))


@query("add_rolling_leak_free", f"""
SELECT city, date, {rolls(('aqi',), (7,), 'date', 1)} FROM daily""")
def _(t):
    out = W.add_rolling(t.daily, PANEL, ["aqi"], [7], leak_free=True)
    return fixed(out.select("city", "date", *[c for c in out.columns if "_roll" in c]))


_E = "OVER (PARTITION BY city ORDER BY datetime, event_id"


@query("events_lags_sized", f"""
SELECT event_id, {r(f'lag(pm2_5, 1) {_E})')} AS pm2_5_lag1, {r(f'lag(pm2_5, 7) {_E})')} AS pm2_5_lag7
FROM readings""")
def _(t):
    """Raw events, declared to come in blocks."""
    out = W.add_lags(t.readings, EVENT_BLOCKS, ["pm2_5"], [1, 7])
    return fixed(out.select("event_id", "pm2_5_lag1", "pm2_5_lag7"))


@query("events_rolling_blocked", f"""
SELECT event_id, {rolls(('pm2_5',), (3, 30), 'datetime, event_id')} FROM readings""")
def _(t):
    """Raw events split into runs of rows with copied edges: no entity is one task."""
    spec = EVENTS.with_(block_seconds=6 * 3600, block_rows=500)
    out = W.add_rolling(t.readings, spec, ["pm2_5"], [3, 30])
    return fixed(out.select("event_id", *[c for c in out.columns if "_roll" in c]))


@query("zscore", f"""
SELECT city, date, {r('(aqi - m) / CASE WHEN s = 0 THEN 1 ELSE s END', 3)} AS aqi_city_zscore
FROM daily JOIN (SELECT city, avg(aqi) AS m, stddev_samp(aqi) AS s FROM daily GROUP BY city) USING (city)""")
def _(t):
    out = W.add_zscore(t.daily, PANEL, digits=9).select("city", "date", "aqi_city_zscore")
    return fixed(out, 3)


@query("trend_decomp", f"""
SELECT city, date, {r('aqi')} AS aqi, {r('trend')} AS trend, {r('aqi - trend')} AS seasonal_30,
       {r('seasonal_avg')} AS seasonal_avg
FROM (SELECT city, date, aqi, CASE WHEN count(aqi) OVER w >= 30 THEN avg(aqi) OVER w END AS trend,
        avg(aqi) OVER (PARTITION BY city, dayofyear(date)) AS seasonal_avg FROM daily
      WINDOW w AS ({_W} ROWS BETWEEN 45 PRECEDING AND 44 FOLLOWING))""")
def _(t):
    rows = t.daily.select("city", "date", "aqi")
    return fixed(W.trend_decomposition(rows, PANEL))


@query("rolling_mean_line", f"""
SELECT city, ds, {r('avg(y) OVER (PARTITION BY city ORDER BY ds ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)')}
       AS y_avg14 FROM series""")
def _(t):
    return fixed(W.rolling_mean(t.series, SERIES, "y", 14).drop("y"))


@query("rolling_calendar", f"""
SELECT city, ds, {r('avg(y) OVER (PARTITION BY city ORDER BY ds RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)')}
       AS y_avg7d FROM series""")
def _(t):
    return fixed(W.rolling_calendar(t.series, SERIES, "y", 7).drop("y"))


def _gaps(entity: str, hours: int) -> str:
    length = "(epoch_us(datetime) - epoch_us(prev)) / 3600000000e0"
    return f"""
SELECT {entity}, count(*) AS gaps, {r(f'max({length})')} AS largest, {r(f'sum({length})')} AS total
FROM (SELECT {entity}, datetime, lag(datetime) OVER (PARTITION BY {entity} ORDER BY datetime) AS prev
      FROM readings WHERE aqi IS NOT NULL)
WHERE {length} > {hours} GROUP BY {entity}"""


@query("detect_gaps", _gaps("user_id", 2))
def _(t):
    """Gaps in each user's events, by blocks of time."""
    return fixed(W.detect_gaps(t.readings, EVENT_BLOCKS.with_(entity="user_id")))


@query("detect_gaps_blocked", _gaps("user_id", 3))
def _(t):
    """Day slots scanned apart, joined by their first and last readings."""
    spec = EVENTS.with_(entity="user_id", block_seconds=86_400)
    return fixed(W.detect_gaps(t.readings, spec, hours=3))


_PRED = "SELECT city, model, ds, {y} AS y, {p} AS yhat FROM {t}"


@query("baseline_ma", _PRED.format(y=r("y"), p=r("yhat"), t="ma"))
def _(t):
    return fixed(W.moving_average(t.series, SERIES, CUTOFF))


@query("baseline_seasonal_naive", _PRED.format(y=r("y"), p=r("yhat"), t="naive"))
def _(t):
    return fixed(W.seasonal_naive(t.series, SERIES, CUTOFF))


@query("baseline_persistence", f"""
SELECT city, 'Persistence' AS model, ds, {r('y')} AS y, {r('p')} AS yhat
FROM (SELECT *, lag(y) OVER (PARTITION BY city ORDER BY ds) AS p FROM series)
WHERE ds >= DATE '{CUTOFF}'""")
def _(t):
    return fixed(W.persistence(t.series, SERIES, CUTOFF))


@query("last_row_features", f"""
SELECT city, date, {r('coalesce(no2, 0)')} AS no2, {r('coalesce(co, 0)')} AS co,
       {r('coalesce(aqi, 0)')} AS aqi
FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS rn FROM daily) WHERE rn = 1""")
def _(t):
    return fixed(W.last_features(t.daily, PANEL, ["no2", "co", "aqi"]))


@query("missing_runs", """
SELECT city, min(date) AS "start", max(date) AS "end", count(*) AS length
FROM (SELECT city, date, no2, count(no2) OVER (PARTITION BY city ORDER BY date) AS seen
      FROM (SELECT city, date, CASE WHEN day(date) % 9 < 3 THEN NULL ELSE no2 END AS no2 FROM daily))
WHERE no2 IS NULL GROUP BY city, seen""")
def _(t):
    holes = t.daily.withColumn("no2", F.when(F.day("date") % 9 >= 3, F.col("no2")))
    return W.missing_runs(holes, PANEL, "no2")


@query("events_missing_runs", """
SELECT city, min(datetime) AS "start", max(datetime) AS "end", count(*) AS length
FROM (SELECT city, datetime, k, count(k) OVER (PARTITION BY city ORDER BY datetime, event_id) AS seen
      FROM (SELECT city, datetime, event_id, CASE WHEN k % 3 = 0 THEN k END AS k FROM readings))
WHERE k IS NULL GROUP BY city, seen""")
def _(t):
    """Runs of raw events, counted within days and joined across them."""
    holes = t.readings.withColumn("k", F.when(F.col("k") % 3 == 0, F.col("k")))
    return W.missing_runs(holes, EVENT_BLOCKS, "k")


@query("events_rolling_calendar", f"""
SELECT event_id, {r('avg(pm2_5) OVER (PARTITION BY city ORDER BY CAST(datetime AS DATE) RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)')}
       AS pm2_5_avg7d FROM readings""")
def _(t):
    """Raw events, averaged over the sums of the last seven days."""
    out = W.rolling_calendar(t.readings, EVENT_BLOCKS, "pm2_5", 7)
    return fixed(out.select("event_id", "pm2_5_avg7d"))
