"""Tables behind charts."""

from __future__ import annotations

from checks import sqltext as T
from pyspark.sql import functions as F

from checks.registry import fixed, query
from checks.sqltext import r
from checks.tables import PANEL, SERIES
from tidepanel.operators import distribution as D

_PERIOD = {
    "ME": ("last_day(ds)", "CAST(last_day(ds) AS DATE)",
           "generate_series(CAST(date_trunc('month', min(p)) AS DATE), max(p), INTERVAL 1 MONTH)",
           "last_day(CAST(s AS DATE))"),
    "W": ("", "CAST(ds + CAST((7 - isodow(ds)) AS INTEGER) AS DATE)",
          "generate_series(min(p), max(p), INTERVAL 7 DAYS)", "CAST(s AS DATE)"),
    "QE": ("", "CAST(last_day(CAST(date_trunc('quarter', ds) AS DATE) + INTERVAL 2 MONTHS) AS DATE)",
           "generate_series(CAST(date_trunc('month', min(p)) AS DATE), max(p), INTERVAL 3 MONTHS)",
           "last_day(CAST(s AS DATE))"),
}


def _resample_sql(freq: str) -> str:
    _, end, spine, step = _PERIOD[freq]
    return f"""
WITH g AS (SELECT city, {end} AS p,
                  avg(CASE WHEN ds < DATE '1996-05-01' OR ds > DATE '1997-02-10' THEN y END) AS y
           FROM series GROUP BY 1, 2),
e AS (SELECT city, unnest({spine}) AS s FROM g GROUP BY city)
SELECT e.city, {step} AS period, {r('g.y')} AS y FROM e LEFT JOIN g ON g.city = e.city AND g.p = {step}"""


def _resample(t, freq):
    known = ~F.col("ds").between("1996-05-01", "1997-02-10")
    rows = t.series.withColumn("y", F.when(known, F.col("y")))
    return fixed(D.resample_mean(rows, SERIES, freq))


@query("resample_month", _resample_sql("ME"))
def _(t):
    return _resample(t, "ME")


@query("resample_week", _resample_sql("W"))
def _(t):
    return _resample(t, "W")


@query("resample_quarter", _resample_sql("QE"))
def _(t):
    return _resample(t, "QE")


def _histogram_sql(bins: int) -> str:
    return f"""
WITH e AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n,
                  (max(value) - min(value)) / {bins} AS w FROM events),
g AS (SELECT CAST(least(floor((value - lo) / w), {bins - 1}) AS INTEGER) AS bin, count(*) AS c
      FROM events, e WHERE value IS NOT NULL GROUP BY 1)
SELECT CAST(b AS INTEGER) AS bin, {r('lo + b * w')} AS low, {r('lo + b * w + w')} AS high,
       coalesce(c, 0) AS count, {r('coalesce(c, 0) / (n * w)', 9)} AS density
FROM range(0, {bins}) AS s(b) CROSS JOIN e LEFT JOIN g ON g.bin = b"""


@query("histogram", _histogram_sql(40))
def _(t):
    out = D.histogram(t.raw("events"), "value", 40)
    return fixed(fixed(out, 9, ("low", "high")), 4, ("density",))


@query("kde_grid", f"""
WITH e AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n,
                  stddev_samp(value) * pow(count(value), -0.2) AS h,
                  (max(value) - min(value)) / 400 AS w FROM events),
g AS (SELECT CAST(least(floor((value - lo) / w), 399) AS INTEGER) AS bin, count(*) AS c
      FROM events, e WHERE value IS NOT NULL GROUP BY 1)
SELECT {r('lo - (hi - lo) * 0.5e0 + (hi - lo) * 2e0 * i / 199')} AS x,
       {r('sum(c * exp(-0.5e0 * pow((lo - (hi - lo) * 0.5e0 + (hi - lo) * 2e0 * i / 199 - (lo + bin * w + w / 2)) / h, 2)) / (n * h * sqrt(2 * pi())))', 9)} AS density
FROM g, e, range(0, 200) AS s(i) GROUP BY lo, hi, i""")
def _(t):
    out = D.kde_grid(t.raw("events"), "value", 400, 200)
    return fixed(fixed(out, 9, ("x",)), 4, ("density",))


@query("seasonal_box", f"""
WITH q AS (SELECT city, {T.four_seasons('month(ds)')} AS season, y,
                  quantile_cont(y, 0.25) OVER w AS p25, quantile_cont(y, 0.5) OVER w AS p50,
                  quantile_cont(y, 0.75) OVER w AS p75 FROM series
           WINDOW w AS (PARTITION BY city, {T.four_seasons('month(ds)')}))
SELECT city, season, {r('p25')} AS p25, {r('p50')} AS p50, {r('p75')} AS p75,
       {r('min(y) FILTER (WHERE y >= p25 - 1.5 * (p75 - p25) AND y <= p75 + 1.5 * (p75 - p25))')} AS whisker_low,
       {r('max(y) FILTER (WHERE y >= p25 - 1.5 * (p75 - p25) AND y <= p75 + 1.5 * (p75 - p25))')} AS whisker_high,
       CAST(count_if(y < p25 - 1.5 * (p75 - p25) OR y > p75 + 1.5 * (p75 - p25)) AS BIGINT) AS outliers
FROM q GROUP BY city, season, p25, p50, p75""")
def _(t):
    return fixed(D.seasonal_box(t.series, SERIES))


@query("scatter_pairs", f"""
SELECT city, {r('no2')} AS no2, {r('co')} AS co FROM lines WHERE no2 IS NOT NULL AND co IS NOT NULL""")
def _(t):
    return fixed(D.scatter_pairs(t.lines, PANEL, "no2", "co"))
