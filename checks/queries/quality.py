"""Data quality checks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from checks import sqltext as T
from checks.registry import fixed, query
from checks.sqltext import r
from checks.tables import MEASURES, PANEL
from tidepanel.functions.quantiles import exact_quantiles
from tidepanel.operators import correlation as C
from tidepanel.operators import quality as Q

_COVER = "avg(CASE WHEN {c} IS NULL THEN 0e0 ELSE 1e0 END) * 100"


@query("completeness_warnings", """
SELECT city, unnest(['no2', 'co', 'aqi']) AS measure, unnest([a, b, c]) > 4 AS mostly_missing,
       a < 20 AND b < 20 AND c < 20 AS well_covered
FROM (SELECT city, avg(CASE WHEN no2 IS NULL THEN 1e0 ELSE 0e0 END) * 100 AS a,
             avg(CASE WHEN co IS NULL THEN 1e0 ELSE 0e0 END) * 100 AS b,
             avg(CASE WHEN aqi IS NULL THEN 1e0 ELSE 0e0 END) * 100 AS c FROM lines GROUP BY city)""")
def _(t):
    out = Q.completeness_warnings(t.lines, PANEL, ["no2", "co", "aqi"], high=4.0)
    names = F.explode(F.array(F.lit("no2"), F.lit("co"), F.lit("aqi"))).alias("measure")
    flat = out.select("city", "mostly_missing", "well_covered", names)
    return flat.withColumn("mostly_missing", F.array_contains("mostly_missing", F.col("measure")))


@query("dq_completeness_grade", " UNION ALL ".join(f"""
SELECT city, '{c}' AS measure, {r('p')} AS coverage,
  CASE WHEN p < 60 THEN 'F' WHEN p < 70 THEN 'D' WHEN p < 85 THEN 'C' WHEN p < 90 THEN 'B'
       WHEN p < 93 THEN 'B+' WHEN p < 94 THEN 'A-' WHEN p < 99 THEN 'A' ELSE 'A+' END AS grade
FROM (SELECT city, count({c}) * 100e0 / count(*) AS p FROM lines GROUP BY city)"""
                                                   for c in ("no2", "co", "aqi")))
def _(t):
    return fixed(Q.completeness_grade(t.lines, PANEL, ["no2", "co", "aqi"]))


@query("dq_duplicates", """
SELECT CAST(count_if(n > 1) AS BIGINT) AS duplicate_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT count(*) AS n FROM lines GROUP BY city, date, data_source)""")
def _(t):
    return Q.duplicates(t.lines, ["city", "date", "data_source"])


@query("dq_timestamps", """
SELECT count(*) AS rows, CAST(count_if(event_id % 7 = 0) AS BIGINT) AS invalid,
       CAST(count_if(event_id % 7 <> 0 AND ts > TIMESTAMP '2024-01-25') AS BIGINT) AS future,
       CAST(count_if(event_id % 7 <> 0 AND ts < TIMESTAMP '2024-01-05') AS BIGINT) AS early,
       min(CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END) AS first_day,
       max(CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END) AS last_day FROM events""")
def _(t):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    broken = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("on "), text)).otherwise(text)
    rows = t.raw("events").select(broken.alias("at"))
    return Q.timestamp_validity(rows, "at", "2024-01-05", "2024-01-25")


@query("dq_ranges", " UNION ALL ".join(f"""
SELECT '{m}' AS measure, CAST(count_if({m} < {lo}) AS BIGINT) AS negative,
       CAST(count_if({m} > {hi}) AS BIGINT) AS above, {r(f'max({m})')} AS highest FROM lines"""
                                       for m, (lo, hi) in Q.RANGES.items()))
def _(t):
    return fixed(Q.range_check(t.lines))


@query("dq_bucket_consistency", f"""
SELECT count(*) AS labelled, CAST(count_if(aqi_bucket <> {T.level('aqi')}) AS BIGINT) AS mismatches
FROM lines WHERE aqi IS NOT NULL AND aqi_bucket IS NOT NULL""")
def _(t):
    return Q.bucket_mismatches(t.lines, PANEL)


@query("dq_cross_dataset", """
SELECT 'orders in customer' AS "check", count(*) AS keys, CAST(count_if(NOT EXISTS
  (SELECT 1 FROM customer c WHERE c.c_custkey = k)) AS BIGINT) AS missing
FROM (SELECT DISTINCT o_custkey AS k FROM orders)
UNION ALL
SELECT 'orders in lineitem', count(*), CAST(count_if(NOT EXISTS
  (SELECT 1 FROM lineitem l WHERE l.l_orderkey = k)) AS BIGINT)
FROM (SELECT DISTINCT o_orderkey AS k FROM orders)""")
def _(t):
    orders = t.raw("orders")
    cust = t.raw("customer").select(F.col("c_custkey").alias("o_custkey"))
    items = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return Q.cross_dataset({"orders in customer": (orders, cust, "o_custkey"),
                            "orders in lineitem": (orders, items, "o_orderkey")})


@query("dq_missing_by_month", f"""
SELECT CAST(month(date) AS INTEGER) AS month,
       {r('avg(CASE WHEN no2 IS NULL THEN 1e0 ELSE 0e0 END) * 100')} AS no2,
       {r('avg(CASE WHEN co IS NULL THEN 1e0 ELSE 0e0 END) * 100')} AS co FROM lines GROUP BY 1""")
def _(t):
    return fixed(Q.missing_by_month(t.lines, PANEL, ["no2", "co"]))


@query("variation", f"""
SELECT city, {r('stddev_samp(aqi) / nullif(avg(aqi), 0)')} AS cv,
       CAST(count_if(aqi > 300) AS BIGINT) AS extreme FROM lines GROUP BY city""")
def _(t):
    return fixed(Q.variation(t.lines, PANEL))


@query("anomalies", f"""
WITH s AS (SELECT city, avg(pm2_5) AS m, stddev_samp(pm2_5) AS s, quantile_cont(pm2_5, 0.25) AS q1,
                  quantile_cont(pm2_5, 0.75) AS q3 FROM readings GROUP BY city)
SELECT event_id, abs(pm2_5 - m) > 3 * s AS by_zscore,
       pm2_5 < q1 - 1.5 * (q3 - q1) OR pm2_5 > q3 + 1.5 * (q3 - q1) AS by_iqr
FROM readings JOIN s USING (city)
WHERE abs(pm2_5 - m) > 3 * s OR pm2_5 < q1 - 1.5 * (q3 - q1) OR pm2_5 > q3 + 1.5 * (q3 - q1)""")
def _(t):
    rows = t.readings.select("event_id", "city", "pm2_5")
    q = exact_quantiles(rows, ["city"], ["pm2_5"], [0.25, 0.75])
    quartiles = q.groupBy("city").agg(F.max(F.when(F.col("prob") == 0.25, F.col("q"))).alias("p25"),
                                      F.max(F.when(F.col("prob") == 0.75, F.col("q"))).alias("p75"))
    out = Q.anomalies(rows, PANEL.with_(target="pm2_5"), quartiles)
    return out.select("event_id", "by_zscore", "by_iqr")


_RANKED = """SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2e0 AS ra,
  rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2e0 AS rb
FROM lines WHERE {a} IS NOT NULL AND {b} IS NOT NULL"""


@query("spearman", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r('corr(ra, rb)')} AS rho FROM ({_RANKED.format(a=a, b=b)})"
    for a, b in combinations(MEASURES, 2)))
def _(t):
    return fixed(C.spearman_pairs(t.lines, MEASURES))


@query("exact_quantiles", " UNION ALL ".join(f"""
SELECT city, 'value' AS measure, {p}e0 AS prob, {r(f'quantile_cont(pm2_5, {p})')} AS q
FROM readings GROUP BY city""" for p in (0.01, 0.5, 0.9, 0.999)))
def _(t):
    rows = t.readings.select("city", F.col("pm2_5").alias("value"))
    out = exact_quantiles(rows, ["city"], ["value"], [0.01, 0.5, 0.9, 0.999])
    return out.withColumn("q", F.round(F.col("q") + 1e-9, 4))
