"""Row-level functions, each applied to every row of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as T
from checks.registry import fixed, query
from checks.sqltext import r
from checks.tables import PANEL
from tidepanel.functions import scalars as S
from tidepanel.operators import aggregates as A
from tidepanel.operators import reshape as X


@query("flagship", "SELECT city, " + r("avg(aqi)") + " AS mean, " + r("stddev_samp(aqi)")
       + " AS std, " + r("min(aqi)") + " AS min, " + r("max(aqi)") + " AS max, count(aqi) AS obs, "
       + ", ".join(f"CAST(count_if({T.level('aqi')} = '{b}') AS BIGINT) AS \"{b}\""
                   for b in S.LEVEL_NAMES) + " FROM readings GROUP BY city")
def _(t):
    levelled = t.readings.withColumn("aqi_bucket", S.aqi_bucket("aqi"))
    shares = X.bucket_distribution(levelled, PANEL).select("city", *S.LEVEL_NAMES)
    return fixed(A.entity_ranking(t.readings, PANEL).join(shares, "city"))


@query("pm25_to_aqi", f"SELECT event_id, {r(T.pm25('value'), 6)} AS aqi FROM events")
def _(t):
    return fixed(t.raw("events").select("event_id", S.pm25_to_aqi("value").alias("aqi")), 6)


@query("aqi_bucket", f"""
SELECT {T.level('aqi')} AS level, {r('min(aqi)')} AS low, {r('max(aqi)')} AS high, count(*) AS n,
       CAST(min(CASE WHEN aqi <= 50 THEN 1 WHEN aqi <= 100 THEN 2 WHEN aqi <= 200 THEN 3
            WHEN aqi <= 300 THEN 4 WHEN aqi <= 400 THEN 5 ELSE 6 END) AS INTEGER) AS rank
FROM readings GROUP BY 1""")
def _(t):
    return fixed(t.readings.groupBy(S.aqi_bucket("aqi").alias("level")).agg(
        F.min("aqi").alias("low"), F.max("aqi").alias("high"), F.count("*").alias("n"),
        F.min(S.aqi_bucket_rank("aqi")).alias("rank")))


@query("aqi_alert", """
SELECT city, CASE WHEN aqi > 200 THEN 'Poor' WHEN aqi > 100 THEN 'Moderate' END AS alert,
       count(*) AS n FROM readings GROUP BY 1, 2""")
def _(t):
    return t.readings.groupBy("city", S.aqi_alert("aqi").alias("alert")).agg(F.count("*").alias("n"))


_COLOR = """CASE WHEN pm2_5 < 15 THEN 'green' WHEN pm2_5 < 20 THEN 'blue'
WHEN pm2_5 < 30 THEN 'orange' ELSE 'red' END"""


@query("model_quality", f"""
SELECT {T.quality('pm2_5')} AS label, {_COLOR} AS color, count(*) AS n FROM lines GROUP BY 1, 2""")
def _(t):
    q = S.model_quality("pm2_5")
    return t.lines.groupBy(q["label"].alias("label"), q["color"].alias("color")).agg(
        F.count("*").alias("n"))


@query("data_quality_band", """
SELECT CASE WHEN no2 < 20 THEN 'High' WHEN no2 < 30 THEN 'Medium' ELSE 'Low' END AS band,
       count(*) AS n FROM lines GROUP BY 1""")
def _(t):
    return t.lines.groupBy(S.data_quality_band("no2").alias("band")).agg(F.count("*").alias("n"))


@query("bar_color", """
SELECT CASE WHEN pm2_5 < 20 THEN 'green' WHEN pm2_5 < 30 THEN 'orange' ELSE 'red' END AS color,
       count(*) AS n FROM lines GROUP BY 1""")
def _(t):
    return t.lines.groupBy(S.bar_color("pm2_5").alias("color")).agg(F.count("*").alias("n"))


@query("trend_label", """
SELECT CASE WHEN no2 IS NULL THEN 'unknown' WHEN co < no2 THEN 'improving' ELSE 'worsening' END
       AS trend, count(*) AS n FROM lines GROUP BY 1""")
def _(t):
    return t.lines.groupBy(S.trend_label("co", "no2").alias("trend")).agg(F.count("*").alias("n"))


@query("season_map", f"""
SELECT CASE WHEN month(date) IN (4,5,6) THEN 'summer' WHEN month(date) IN (11,12,1,2) THEN 'winter'
       END AS half, {T.four_seasons('month(date)')} AS quarter_season,
       {T.error_seasons('month(date)')} AS error_season, count(*) AS n
FROM lines GROUP BY 1, 2, 3""")
def _(t):
    return t.lines.groupBy(
        S.season("date", S.SUMMER_WINTER).alias("half"),
        S.season("date", S.FOUR_SEASONS).alias("quarter_season"),
        S.season("date", S.ERROR_SEASONS).alias("error_season")).agg(F.count("*").alias("n"))


@query("calendar_parts", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       CAST(month(ts) AS INTEGER) AS month, CAST(quarter(ts) AS INTEGER) AS quarter,
       CAST(year(ts) AS INTEGER) AS year, CAST(dayofyear(ts) AS INTEGER) AS day_of_year,
       dayname(ts) AS day_name FROM events""")
def _(t):
    parts = S.calendar_parts("ts")
    return t.raw("events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query("is_weekend", """
SELECT event_id, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM events""")
def _(t):
    return t.raw("events").select("event_id", S.is_weekend("ts").alias("is_weekend"))


@query("cyclical", f"""
SELECT DISTINCT date, {r('sin(2e0 * pi() * month(date) / 12)')} AS month_sin,
       {r('cos(2e0 * pi() * month(date) / 12)')} AS month_cos FROM lines""")
def _(t):
    s, c = S.cyclical(F.month("date"), 12)
    return fixed(t.lines.select("date", s.alias("month_sin"), c.alias("month_cos"))).distinct()


@query("ratio_safe", f"""
SELECT l_returnflag AS city, {r('sum(l_tax / nullif(l_discount, 0))')} AS total,
       count(l_tax / nullif(l_discount, 0)) AS n FROM lineitem GROUP BY 1""")
def _(t):
    ratio = S.ratio_safe("l_tax", "l_discount")
    return fixed(t.raw("lineitem").groupBy(F.col("l_returnflag").alias("city")).agg(
        F.sum(ratio).alias("total"), F.count(ratio).alias("n")))


@query("product_sum_terms", f"""
SELECT city, date, {r('no2 * co')} AS no2_co_product, {r('pm2_5 * o3')} AS primary_secondary,
       {r('no2 + so2')} AS no2_so2_sum FROM daily""")
def _(t):
    from tidepanel.plans.features import interaction_features

    terms = interaction_features(t.daily)
    terms.pop("pm25_pm10_ratio")
    return fixed(t.daily.select("city", "date", *[c.alias(n) for n, c in terms.items()]))


@query("round_n", f"SELECT city, ds, {r('y', 1)} AS y FROM series")
def _(t):
    return X.rounded(t.series.withColumn("y", F.col("y") + 1e-9), 1)


@query("clip", f"""
SELECT city, ds, {r('least(greatest(y, 30e0), 400e0)')} AS both_sides,
       {r('greatest(y, 250e0)')} AS low_only FROM series""")
def _(t):
    return fixed(t.series.select("city", "ds", S.clip("y", 30, 400).alias("both_sides"),
                                 S.clip("y", low=250).alias("low_only")))


@query("date_shift_diff", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS shifted,
       {r("epoch(TIMESTAMP '2001-08-01' - o_orderdate) / 3600e0")} AS hours FROM orders""")
def _(t):
    end = F.lit("2001-08-01").cast("timestamp_ntz")
    return fixed(t.raw("orders").select(
        "o_orderkey", S.shift_days("o_orderdate", 30).alias("shifted"),
        S.hours_between("o_orderdate", end).alias("hours")))


@query("to_date_parse", """
SELECT event_id, CAST(ts AS DATE) AS day, CAST(NULL AS DATE) AS bad FROM events""")
def _(t):
    rows = t.raw("events").withColumn("text", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return rows.select("event_id", S.parse_date("text").alias("day"),
                       S.parse_date(F.concat(F.lit("x"), F.col("text"))).alias("bad"))


@query("format_month", "SELECT DISTINCT date, strftime(date, '%b') AS month_name FROM lines")
def _(t):
    return t.lines.select("date", S.month_name("date").alias("month_name")).distinct()


@query("json_access", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'unknown' AS place
FROM events""")
def _(t):
    return t.raw("events").select("event_id", S.json_value("props", "$.k", "bigint").alias("k"),
                                  S.json_value("props", "$.place", default="unknown").alias("place"))


@query("horizon_to_days", """
SELECT event_id, CAST(greatest(1, k // 24 + 1) AS INTEGER) AS days FROM readings""")
def _(t):
    """The plan-time rule over a column of hours."""
    return t.readings.select("event_id", S.horizon_to_days(F.col("k")).alias("days"))
