"""Aggregations, ranking and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import fixed, query
from checks.sqltext import MEASURES, r
from checks.tables import CUTOFF, HOURS, PANEL, SERIES
from tidepanel.operators import aggregates as A
from tidepanel.operators import correlation as C
from tidepanel.operators import filters as FL
from tidepanel.operators import ranking as R
from tidepanel.operators import reshape as X
from tidepanel.sources.readers import legacy_view


@query("agg_city_summary", f"""
SELECT city, {r('avg(aqi)')} AS avg_aqi, {r('min(aqi)')} AS min_aqi, {r('max(aqi)')} AS max_aqi,
       count(aqi) AS days_recorded
FROM lines WHERE aqi IS NOT NULL GROUP BY city""")
def _(t):
    return fixed(A.entity_summary(t.lines, PANEL))


@query("agg_month_season", f"""
SELECT CAST(month(date) AS INTEGER) AS month, strftime(date, '%b') AS month_name,
       {r('avg(aqi)')} AS avg_aqi, {r('avg(pm2_5)')} AS avg_pm25
FROM lines WHERE aqi IS NOT NULL GROUP BY 1, 2""")
def _(t):
    legacy = legacy_view(t.lines, "legacy_lines")
    return fixed(A.month_season(legacy, PANEL, ["aqi", "pm25"]))


@query("agg_year_trend", f"""
SELECT CAST(year(date) AS INTEGER) AS year, {r('avg(aqi)')} AS avg_aqi, {r('avg(pm2_5)')} AS avg_pm2_5,
       count(DISTINCT city) AS entities_reporting
FROM lines WHERE aqi IS NOT NULL GROUP BY 1""")
def _(t):
    return fixed(A.year_trend(t.lines, PANEL, ["aqi", "pm2_5"]))


@query("agg_month_mean", f"""
SELECT CAST(month(date) AS INTEGER) AS month, {r('avg(no2)')} AS mean
FROM lines WHERE no2 IS NOT NULL GROUP BY 1""")
def _(t):
    return fixed(A.month_mean(t.lines, PANEL, "no2"))


@query("agg_entity_mean", f"SELECT city, {r('avg(co)')} AS mean FROM lines WHERE co IS NOT NULL GROUP BY 1")
def _(t):
    return fixed(A.entity_mean(t.lines, PANEL, "co"))


@query("month_profile", f"""
SELECT CAST(month(ds) AS INTEGER) AS month, {r('avg(y)')} AS mean FROM series GROUP BY 1""")
def _(t):
    return fixed(A.month_mean(t.series, SERIES, "y"))


@query("entities_recent", """
SELECT DISTINCT city FROM lines
WHERE aqi IS NOT NULL AND date >= DATE '2001-06-01' AND NOT is_synthetic""")
def _(t):
    return A.recent_entities(t.lines, PANEL, "2001-06-01")


@query("entities_summary", """
SELECT city, count(*) AS days, min(date) AS start_date, max(date) AS end_date
FROM lines WHERE aqi IS NOT NULL AND NOT is_synthetic GROUP BY city HAVING count(*) >= 1000""")
def _(t):
    return A.coverage_summary(t.lines, PANEL, 1000)


@query("entities_eligible", """
SELECT city, count(*) AS total_days, max(date) AS end_date
FROM lines WHERE aqi IS NOT NULL GROUP BY city
HAVING count(*) >= 1000 AND max(date) >= DATE '2001-01-01'""")
def _(t):
    return A.eligible_entities(t.lines, PANEL, 1000, "2001-01-01", use_synthetic=True)


@query("count_recent", """
SELECT count(*) AS n FROM lines WHERE date >= DATE '2000-07-01' AND NOT is_synthetic""")
def _(t):
    return A.count_recent(t.lines, PANEL, "2000-07-01")


@query("freshness", """
SELECT count(*) AS total_rows, CAST(count_if(NOT is_synthetic) AS BIGINT) AS real_rows,
       CAST(count_if(is_synthetic) AS BIGINT) AS synthetic_rows, count(DISTINCT city) AS entities,
       max(ingested_at) AS last_ingested_at,
       max(CASE WHEN NOT is_synthetic THEN date END) AS latest_real_date
FROM lines""")
def _(t):
    return A.freshness(t.lines, PANEL)


@query("freshness_sources", "SELECT data_source, count(*) AS rows FROM lines GROUP BY 1")
def _(t):
    return A.source_counts(t.lines, PANEL)


@query("freshness_report", """
SELECT data_source, n, total, real FROM
 (SELECT data_source, count(*) AS n FROM lines GROUP BY 1),
 (SELECT count(*) AS total, CAST(count_if(NOT is_synthetic) AS BIGINT) AS real FROM lines)""")
def _(t):
    out = A.freshness_report(t.lines, PANEL)
    return out.select(F.explode("data_sources").alias("data_source", "n"),
                      F.col("total_rows").alias("total"), F.col("real_rows").alias("real"))


_FIVE = ("{mean} AS mean, {std} AS std, {lo} AS min, {hi} AS max, count({c}) AS obs")


def five(c: str) -> str:
    return _FIVE.format(mean=r(f"avg({c})"), std=r(f"stddev_samp({c})"), lo=r(f"min({c})"),
                        hi=r(f"max({c})"), c=c)


@query("city_ranking", f"SELECT city, {five('aqi')} FROM lines GROUP BY city")
def _(t):
    return fixed(A.entity_ranking(t.lines, PANEL))


@query("year_over_year", f"""
SELECT city, CAST(year(date) AS INTEGER) AS year, {five('no2')} FROM lines GROUP BY 1, 2""")
def _(t):
    return fixed(A.year_over_year(t.lines, PANEL, "no2"))


@query("yearly_stats", f"""
SELECT city, CAST(year(ds) AS INTEGER) AS year, {r('avg(y)')} AS mean, {r('min(y)')} AS min,
       {r('max(y)')} AS max, count(y) AS count FROM series GROUP BY 1, 2""")
def _(t):
    return fixed(A.yearly_stats(t.series, SERIES))


@query("monthly_trends", f"""
SELECT city, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       {r('avg(aqi)')} AS aqi, CAST(date_trunc('month', date) AS DATE) AS ym
FROM lines GROUP BY ALL""")
def _(t):
    return fixed(A.monthly_trends(t.lines, PANEL))


@query("weekday_analysis", f"""
SELECT city, CAST(isodow(date) - 1 AS INTEGER) AS dow, dayname(date) AS day_name,
       {r('avg(aqi)')} AS aqi FROM lines GROUP BY ALL""")
def _(t):
    return fixed(A.weekday_profile(t.lines, PANEL))


@query("hourly_diurnal", f"""
SELECT city, CAST(hour(datetime) AS INTEGER) AS hour, {r('avg(aqi)')} AS aqi
FROM readings GROUP BY 1, 2""")
def _(t):
    return fixed(A.hourly_profile(t.readings, HOURS))


@query("diurnal_mean_std", f"""
SELECT city, hour, {r('m')} AS mean, {r('s')} AS std, {r('m - s')} AS low, {r('m + s')} AS high
FROM (SELECT city, CAST(hour(datetime) AS INTEGER) AS hour, avg(aqi) AS m, stddev_samp(aqi) AS s
      FROM readings GROUP BY 1, 2)""")
def _(t):
    return fixed(A.hourly_band(t.readings, HOURS))


_MISS = ", ".join(f"{r(f'avg(CASE WHEN {m} IS NULL THEN 1e0 ELSE 0e0 END) * 100')} AS {m}"
                  for m in ("pm2_5", "pm10", "no2", "co", "so2", "o3", "aqi"))


@query("missing_pct", f"SELECT city, {_MISS} FROM lines GROUP BY city")
def _(t):
    return fixed(A.missing_pct(t.lines, PANEL))


_PAIRS = [(a, b) for a in MEASURES for b in MEASURES]
_CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, "
    + ("1e0" if a == b else r(f"corr({min(a, b)}, {max(a, b)})")) + " AS r FROM lines"
    + (" HAVING count(*) > 1" if a == b else "") for a, b in _PAIRS)


@query("correlation_pairs", _CORR)
def _(t):
    return fixed(C.correlation_pairs(t.lines))


@query("correlation_matrix", "".join(
    f"{' UNION ALL ' if i else ''}SELECT '{a}' AS measure, " + ", ".join(
        (f"1e0 AS {b}" if a == b else f"{r(f'corr({min(a, b)}, {max(a, b)})', 3)} AS {b}") for b in MEASURES)
    + " FROM lines HAVING count(*) > 1" for i, a in enumerate(MEASURES)))
def _(t):
    return fixed(C.correlation_matrix(t.lines, digits=6), 3)


@query("correlation_with_target", " UNION ALL ".join(
    f"SELECT '{c}' AS regressor, {r(f'corr(aqi, {c})')} AS r FROM lines"
    for c in ("pm2_5", "no2", "co")))
def _(t):
    return fixed(C.correlation_with_target(t.lines, "aqi", ["pm2_5", "no2", "co"]))


def _side(c: str, cond: str) -> str:
    return f"corr(aqi, {c}) FILTER (WHERE date {cond} DATE '{CUTOFF}')"


_STABLE = " UNION ALL ".join(f"""
SELECT '{c}' AS regressor, {_side(c, '<')} AS a, {_side(c, '>=')} AS b FROM daily"""
                             for c in ("pm2_5", "no2", "co"))


@query("correlation_stability", f"""
SELECT regressor, {r('a')} AS train_r, {r('b')} AS test_r, {r('abs(a - b)')} AS diff,
       CASE WHEN abs(a - b) < 0.1 THEN 'Stable' ELSE 'Unstable' END AS status FROM ({_STABLE})""")
def _(t):
    return fixed(C.correlation_stability(t.daily, PANEL, ["pm2_5", "no2", "co"], CUTOFF))


_SUMMARY = " UNION ALL ".join(f"""
SELECT '{m}' AS measure, count({m}) AS count, {r(f'avg({m})')} AS mean,
  {r(f'stddev_samp({m})')} AS std, {r(f'min({m})')} AS min,
  {r(f'quantile_cont({m}, 0.25)')} AS p25, {r(f'quantile_cont({m}, 0.5)')} AS p50,
  {r(f'quantile_cont({m}, 0.75)')} AS p75, {r(f'max({m})')} AS max,
  {r(f'(count(*) - count({m})) * 100.0 / count(*)')} AS missing_pct FROM lines"""
                              for m in MEASURES)


@query("measure_summary", _SUMMARY)
def _(t):
    return fixed(X.measure_summary(t.lines, PANEL))


@query("measure_summary_by_entity", f"""
SELECT city, count(no2) AS count, {r('quantile_cont(no2, 0.5)')} AS p50,
       {r('(count(*) - count(no2)) * 100.0 / count(*)')} AS missing_pct
FROM lines GROUP BY city""")
def _(t):
    out = X.measure_summary(t.lines, PANEL, ["no2"], by=["city"])
    return fixed(out.select("city", "count", "p50", "missing_pct"))


@query("worst_best", f"""
WITH m AS (SELECT city, avg(aqi) AS m FROM lines
           WHERE date >= DATE '2000-01-01' AND date < DATE '2001-01-01' GROUP BY city)
SELECT (SELECT city FROM m ORDER BY m DESC, city LIMIT 1) AS worst,
       (SELECT city FROM m ORDER BY m, city LIMIT 1) AS best,
       {r('max(m)')} AS worst_aqi, {r('min(m)')} AS best_aqi FROM m""")
def _(t):
    return fixed(R.worst_best(t.lines, PANEL, 2000))


@query("summer_winter", f"""
SELECT city, summer, winter, {r('winter / nullif(summer, 0)')} AS winter_summer_ratio FROM (
  SELECT city, {r('avg(CASE WHEN month(date) IN (4,5,6) THEN aqi END)', 1)} AS summer,
         {r('avg(CASE WHEN month(date) IN (11,12,1,2) THEN aqi END)', 1)} AS winter
  FROM lines GROUP BY city)""")
def _(t):
    return fixed(X.summer_winter(t.lines, PANEL))


@query("season_pivot", f"""
SELECT city, {r("avg(CASE WHEN month(date) IN (4,5,6) THEN no2 END)")} AS summer,
       {r("avg(CASE WHEN month(date) IN (11,12,1,2) THEN no2 END)")} AS winter
FROM lines GROUP BY city""")
def _(t):
    return fixed(X.season_pivot(t.lines, PANEL, metric="no2"))


@query("conditional_counts", f"""
SELECT city, count(*) AS rows, min(date) AS "start", max(date) AS "end",
       CAST(count_if(aqi IS NULL) AS BIGINT) AS null_target,
       {r('count(*) FILTER (WHERE no2 IS NOT NULL) * 100.0 / count(*)')} AS no2_pct,
       {r('count(*) FILTER (WHERE co IS NOT NULL) * 100.0 / count(*)')} AS co_pct
FROM lines GROUP BY city""")
def _(t):
    return fixed(A.coverage(t.lines, PANEL, ["no2", "co"]))


# Actual values stand in for a forecast here; the fitted one is in the forecasting checks.
def _as_forecast(t):
    y = F.col("y")
    return t.series.select("city", "ds", y.alias("yhat"), (y * 0.5).alias("yhat_lower"),
                           (y * 1.5).alias("yhat_upper"))


@query("forecast_monthly", f"""
WITH spine AS (SELECT city, CAST(m AS INTEGER) AS month
               FROM (SELECT DISTINCT city FROM series), range(1, 13) AS g(m)),
got AS (SELECT city, month(ds) AS month, avg(y) AS a, avg(y * 0.5) AS b, avg(y * 1.5) AS c
        FROM series WHERE year(ds) = 2001 GROUP BY 1, 2)
SELECT city, month, coalesce({r('a')}, 0e0) AS yhat, coalesce({r('b')}, 0e0) AS yhat_lower,
       coalesce({r('c')}, 0e0) AS yhat_upper
FROM spine LEFT JOIN got USING (city, month)""")
def _(t):
    return fixed(A.forecast_by_month(_as_forecast(t), PANEL, 2001))


@query("forecast_yearly", f"""
SELECT city, CAST(year(ds) AS INTEGER) AS year, {r('avg(y)')} AS predicted,
       {r('avg(y * 0.5)')} AS lower_bound, {r('avg(y * 1.5)')} AS upper_bound
FROM series WHERE ds >= DATE '1998-01-01' GROUP BY 1, 2""")
def _(t):
    return fixed(A.forecast_by_year(_as_forecast(t), PANEL, 1998))


@query("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM lines"
    for c in ("no2", "co", "aqi_bucket")))
def _(t):
    return A.null_counts(t.lines, ["no2", "co", "aqi_bucket"])


@query("distinct_gap", """
SELECT city, count(*) - count(DISTINCT date) AS repeated FROM lines GROUP BY city""")
def _(t):
    return A.distinct_gap(t.lines, PANEL)


@query("threshold_days", """
SELECT city, CAST(count_if(aqi > 100) AS BIGINT) AS above_100,
       CAST(count_if(aqi > 200) AS BIGINT) AS above_200 FROM daily GROUP BY city""")
def _(t):
    return A.threshold_days(t.daily, PANEL)


@query("kpi_cards", f"""
WITH e AS (SELECT city, count(*) AS n, count(y) AS k, sum(y) AS s, avg(y) AS m, min(ds) AS f,
                  max(ds) AS l FROM series GROUP BY city)
SELECT count(*) AS entities, min(f) AS start_date, max(l) AS end_date,
       CAST(sum(n) AS BIGINT) AS rows, {r('sum(s) / sum(k)')} AS mean,
       (SELECT city FROM e ORDER BY m DESC, city LIMIT 1) AS highest,
       (SELECT city FROM e ORDER BY m, city LIMIT 1) AS lowest,
       (SELECT {r('y')} FROM series ORDER BY ds DESC, city DESC LIMIT 1) AS latest
FROM e""")
def _(t):
    return fixed(A.headline(t.series, SERIES))


@query("last_per_entity", f"""
SELECT city, {r("(arg_max(no2, date) FILTER (WHERE no2 IS NOT NULL))")} AS no2,
       {r("(arg_max(co, date) FILTER (WHERE co IS NOT NULL))")} AS co
FROM daily GROUP BY city""")
def _(t):
    return fixed(A.last_values(t.daily, PANEL, ["no2", "co"]))


@query("current_level", f"""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY ds DESC) AS rn FROM series)
SELECT city, {r("coalesce(avg(y) FILTER (WHERE ds >= DATE '2024-01-01'), avg(y) FILTER (WHERE rn <= 365))")}
       AS current FROM n GROUP BY city""")
def _(t):
    return fixed(A.current_level(t.series, SERIES))


@query("overall_trend", f"""
WITH y AS (SELECT city, year(ds) AS yr, avg(y) AS m FROM series GROUP BY 1, 2)
SELECT city, {r('arg_max(m, yr) - arg_min(m, yr)')} AS change,
       CASE WHEN arg_max(m, yr) - arg_min(m, yr) < 0 THEN 'improving' ELSE 'worsening' END AS trend
FROM y GROUP BY city HAVING count(*) > 1""")
def _(t):
    return fixed(A.overall_trend(t.series, SERIES))


# Ranking, limits, set operations -------------------------------------------------------


@query("top_n_entities", f"""
SELECT city, {r('avg(no2)')} AS mean FROM lines GROUP BY city ORDER BY avg(no2) DESC, city LIMIT 2""")
def _(t):
    return fixed(R.top_entities(t.lines, PANEL, 2, "no2"))


@query("tail_n", f"""
SELECT city, ds, {r('y')} AS y FROM
 (SELECT *, row_number() OVER (PARTITION BY city ORDER BY ds DESC) AS rn FROM series)
WHERE rn <= 60""")
def _(t):
    return fixed(R.tail_rows(t.series, SERIES, 60))


@query("head_n", f"SELECT city, {r('avg(y)')} AS mean FROM series GROUP BY city ORDER BY city LIMIT 3")
def _(t):
    means = t.series.groupBy("city").agg(F.avg("y").alias("mean"))
    return fixed(R.head_rows(means, [F.col("city")], 3))


@query("sort_result", f"SELECT city, {r('avg(y)')} AS mean FROM series GROUP BY city ORDER BY avg(y)")
def _(t):
    means = t.series.groupBy("city").agg(F.avg("y").alias("mean"))
    return fixed(R.sorted_by(means, F.col("mean"), F.col("city")))


@query("model_rankings", f"""
SELECT city, model, {r('rmse')} AS rmse,
       CAST(row_number() OVER (PARTITION BY city ORDER BY rmse, model) AS INTEGER) AS place
FROM metrics WHERE rmse IS NOT NULL""")
def _(t):
    return fixed(R.model_rankings(t.metrics, PANEL))


@query("best_model", f"""
SELECT city, arg_min(model, rmse) AS best_model, {r('min(rmse)')} AS rmse FROM metrics GROUP BY city""")
def _(t):
    return fixed(R.best_model(t.metrics, PANEL))


@query("union_all", f"""
SELECT city, ds, {r('y')} AS y, CAST(NULL AS DOUBLE) AS pm2_5 FROM series
UNION ALL SELECT city, date, NULL, {r('pm2_5')} FROM daily""")
def _(t):
    other = t.daily.select("city", F.col("date").alias("ds"), "pm2_5")
    return fixed(X.union_all(t.series, other))


@query("distinct_entities", "SELECT DISTINCT city FROM readings")
def _(t):
    return X.distinct_entities(t.readings, PANEL)


_LEVELS = ("Good", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe")


@query("bucket_distribution", "SELECT city, " + ", ".join(
    f"CAST(count_if(aqi_bucket = '{b}') AS BIGINT) AS \"{b}\", "
    + r(f"count_if(aqi_bucket = '{b}') * 100.0 / count(*)") + f" AS \"{b}_pct\"" for b in _LEVELS)
    + ", count(*) AS \"Total\" FROM lines WHERE aqi_bucket IS NOT NULL GROUP BY city")
def _(t):
    return fixed(X.bucket_distribution(t.lines, PANEL))


@query("describe_to_rows", " UNION ALL ".join(
    f"SELECT '{m}' AS measure, '{s}' AS statistic, {r(f'CAST({f}({m}) AS DOUBLE)')} AS value FROM lines"
    for m in ("no2", "co")
    for s, f in (("count", "count"), ("mean", "avg"), ("std", "stddev_samp"), ("min", "min"),
                 ("max", "max"))))
def _(t):
    return fixed(X.described(t.lines, ["no2", "co"]))


# Filters and projections ---------------------------------------------------------------


@query("flt_provenance", """
SELECT city, count(*) AS n FROM lines WHERE NOT is_synthetic GROUP BY city""")
def _(t):
    return FL.provenance(t.lines, PANEL).groupBy("city").agg(F.count("*").alias("n"))


@query("load_entity_series", f"""
SELECT city, CAST(date AS DATE) AS ds, {r('aqi')} AS y FROM lines
WHERE city = 'A' AND aqi IS NOT NULL AND NOT is_synthetic""")
def _(t):
    return fixed(FL.entity_series(t.lines, PANEL, ["A"]))


@query("load_entity_measures", f"""
SELECT city, date, {r('pm2_5')} AS pm2_5, {r('pm10')} AS pm10, {r('no2')} AS no2, {r('co')} AS co,
       {r('so2')} AS so2, {r('o3')} AS o3, {r('aqi')} AS aqi, aqi_bucket, is_synthetic, data_source
FROM lines WHERE city IN ('A', 'R') AND NOT is_synthetic""")
def _(t):
    return fixed(FL.entity_measures(t.lines, PANEL, ["A", "R"]))


@query("load_hourly", f"""
SELECT city, datetime, {r('pm2_5')} AS pm2_5, {r('aqi')} AS aqi FROM readings WHERE k % 4 <> 0""")
def _(t):
    marked = t.readings.withColumn("is_synthetic", F.col("k") % 4 == 0)
    return fixed(FL.hourly_measures(marked, HOURS))


@query("flt_recent", """
SELECT city, date, count(*) AS n FROM lines WHERE date >= DATE '2001-10-01' GROUP BY 1, 2""")
def _(t):
    return FL.since(t.lines, "date", "2001-10-01").groupBy("city", "date").agg(
        F.count("*").alias("n"))


@query("flt_cutoff", """
SELECT city, CAST(count_if(ds < DATE '2000-01-01') AS BIGINT) AS train,
       CAST(count_if(ds >= DATE '2000-01-01') AS BIGINT) AS test FROM series GROUP BY city""")
def _(t):
    n = F.count("*")
    train = FL.before(t.series, "ds", CUTOFF).groupBy("city").agg(n.alias("train"))
    return train.join(FL.since(t.series, "ds", CUTOFF).groupBy("city").agg(n.alias("test")), "city")


@query("flt_exclude_period", f"""
SELECT city, ds, {r('y')} AS y FROM series
WHERE ds < DATE '1996-03-01' OR ds > DATE '2001-06-30'""")
def _(t):
    return fixed(FL.outside(t.series, "ds", "1996-03-01", "2001-06-30"))


@query("flt_year", f"SELECT city, ds, {r('y')} AS y FROM series WHERE year(ds) = 1999")
def _(t):
    return fixed(FL.in_year(t.series, "ds", 1999))


@query("flt_month", f"""
SELECT city, ds, {r('y')} AS yhat, CAST(year(ds) AS INTEGER) AS year
FROM series WHERE month(ds) = 6 AND year(ds) >= 1999""")
def _(t):
    rows = t.series.withColumnRenamed("y", "yhat")
    return fixed(A.forecast_of_month(rows, 6, 1999))


@query("flt_dropna", """
SELECT city, count(*) AS n FROM lines WHERE no2 IS NOT NULL AND co IS NOT NULL GROUP BY city""")
def _(t):
    return FL.complete(t.lines, ["no2", "co"]).groupBy("city").agg(F.count("*").alias("n"))


@query("flt_threshold", f"""
SELECT city, model, {r('mape')} AS mape FROM metrics WHERE mape < 1000 AND mape > 1""")
def _(t):
    return fixed(FL.above(FL.below(t.metrics, "mape", 1000), "mape", 1)
                 .select("city", "model", "mape"))


@query("prj_rename", f"SELECT city AS place, ds AS day, {r('y')} AS level FROM series")
def _(t):
    return fixed(FL.renamed(t.series, {"city": "place", "ds": "day", "y": "level", "gone": "x"}))


@query("prj_literal", """
SELECT city, data_source, is_synthetic, count(*) AS n FROM
 (SELECT city, 'CPCB' AS data_source, false AS is_synthetic FROM series) GROUP BY ALL""")
def _(t):
    out = FL.stamped(t.series, {"data_source": "CPCB", "is_synthetic": False})
    return out.groupBy("city", "data_source", "is_synthetic").agg(F.count("*").alias("n"))


@query("prj_numeric_features", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n FROM lines"
    for c in ("pm2_5", "pm10", "no2", "co", "so2", "o3", "station_id")))
def _(t):
    names = FL.numeric_features(t.lines)
    one = t.lines.agg(*[F.count(c).alias(c) for c in names])
    return one.unpivot([], names, "feature", "n")
