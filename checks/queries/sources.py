"""Readers and writers. Each query writes the given tables in the format under test below the
shared folder, reads them back through the library, and must equal the source rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as T
from checks.registry import fixed, query
from checks.sqltext import r
from checks.tables import PANEL, SERIES
from tidepanel.operators import filters as FL
from tidepanel.session import shared_dir
from tidepanel.sources import readers as R
from tidepanel.sources import schemas
from tidepanel.sources import sinks as K
from tidepanel.streaming import ingest as ST

_KNOWN = ("pm2_5", "pm10", "no2", "co", "so2", "o3", "aqi")


def _raw_headers(df, headers):
    """The panel under raw CSV headers; measures it lacks are empty."""
    have = set(df.columns)
    return df.select(*[
        (F.col(n) if n in have else F.lit(None).cast(schemas.column_type(n))).alias(h)
        for h, n in ((h, schemas.CSV_NAMES[h]) for h in headers)])


_DAILY_BACK = ", ".join(f"{r(m)} AS {m}" for m in _KNOWN)


@query("src_csv_daily", f"""
SELECT city, date, {_DAILY_BACK}, false AS is_synthetic, 'CPCB' AS data_source FROM daily""")
def _(t):
    path = shared_dir(t.spark, "daily-csv")
    K.to_csv(_raw_headers(t.daily, schemas.DAILY_HEADERS), path)
    back = R.daily_csv(t.spark, path)
    return fixed(back.select("city", "date", *_KNOWN, "is_synthetic", "data_source"))


@query("src_csv_hourly", f"""
SELECT city, datetime, {r('pm2_5')} AS pm2_5, {r('aqi')} AS aqi, 'CPCB' AS data_source FROM hourly""")
def _(t):
    path = shared_dir(t.spark, "hourly-csv")
    K.to_csv(_raw_headers(t.hourly, schemas.HOURLY_HEADERS), path)
    back = R.hourly_csv(t.spark, path)
    return fixed(back.select("city", "datetime", "pm2_5", "aqi", "data_source"))


@query("ingest_report", """
SELECT count(*) AS rows, min(datetime) AS "start", max(datetime) AS "end",
       count(DISTINCT city) AS entities FROM readings""")
def _(t):
    return R.ingest_report(t.readings, PANEL.with_(time="datetime"))


@query("src_csv_processed", f"""
SELECT city, date, {r('pm2_5')} AS pm2_5, {r('aqi')} AS aqi, true AS is_synthetic FROM daily""")
def _(t):
    path = shared_dir(t.spark, "processed-csv")
    cols = ["city", "date", "pm25", "aqi"]
    K.to_csv(t.daily.withColumnRenamed("pm2_5", "pm25").select(*cols), path)
    back = R.processed_csv(t.spark, path, cols, "synthetic", True)
    return fixed(back.select("city", "date", "pm2_5", "aqi", "is_synthetic"))


@query("src_csv_stations", """
SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS station_name, n_name AS city,
       r_name AS state, CASE WHEN s_acctbal > 0 THEN 'Active' END AS status
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    dim = (t.raw("supplier").join(t.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
           .join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.col("s_suppkey").cast("string").alias("StationId"),
                   F.col("s_name").alias("StationName"), F.col("n_name").alias("City"),
                   F.col("r_name").alias("State"),
                   F.when(F.col("s_acctbal") > 0, "Active").alias("Status")))
    path = shared_dir(t.spark, "stations-csv")
    K.to_csv(dim, path)
    table = shared_dir(t.spark, "stations")
    K.recreate(R.stations_csv(t.spark, path), table)
    return t.spark.read.parquet(table)


@query("src_table", f"""
SELECT city, ds, {r('y')} AS y FROM series WHERE city = '2-HIGH' AND y >= 200""")
def _(t):
    t.series.createOrReplaceTempView("checked_series")
    return fixed(R.table_query(
        t.spark, "SELECT city, ds, y FROM checked_series WHERE city = :city AND y >= :least",
        city="2-HIGH", least=200.0))


_PLACES = """SELECT user_id, event_id, CAST(ts AS DATE) AS date, value AS pm2_5,
  CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS location FROM events"""


def _row_payloads(t):
    """Responses of at most 500 readings, per user and day, as a paged API would give them."""
    place = F.when(F.col("event_type") != "error", F.col("event_type"))
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    item = F.struct(F.struct(local.alias("local")).alias("date"), "value", place.alias("location"))
    page = F.floor(F.col("event_id") / 500)
    packed = t.raw("events").groupBy("user_id", F.to_date("ts").alias("day"), page).agg(
        F.collect_list(item).alias("results"))
    return packed.select("user_id", F.to_json(F.struct("results")).alias("payload"))


@query("src_json_rows", f"""
SELECT user_id, date, location, count(*) AS n, {r('sum(pm2_5)')} AS total FROM ({_PLACES}) GROUP BY ALL""")
def _(t):
    rows = R.row_payload(_row_payloads(t), keys=["user_id"])
    return fixed(rows.groupBy("user_id", "date", "location").agg(
        F.count("*").alias("n"), F.sum("pm2_5").alias("total")))


@query("src_json_rows_daily_index", f"""
SELECT user_id, date, {r('m')} AS pm2_5, {r(T.pm25('m'))} AS aqi
FROM (SELECT user_id, date, avg(pm2_5) AS m FROM ({_PLACES}) GROUP BY 1, 2)""")
def _(t):
    rows = R.row_payload(_row_payloads(t), keys=["user_id"])
    return fixed(R.payload_daily_index(rows, ["user_id"]))


def _array_payloads(t, section, fields):
    """One response per entity and year: parallel arrays of days and values."""
    day = F.date_format("date", "yyyy-MM-dd").alias("time")
    items = F.collect_list(F.struct(day, *fields)).alias("i")
    packed = t.daily.groupBy("city", F.year("date").alias("y")).agg(items)
    arrays = F.struct(*[F.col(f"i.{f}").alias(f) for f in ("time", *fields)])
    return packed.select("city", F.to_json(F.struct(arrays.alias(section))).alias("payload"))


@query("src_json_arrays", f"""
SELECT city, date, {r('pm2_5')} AS pm2_5, {r('pm10')} AS pm10, {r(T.pm25('pm2_5'))} AS aqi FROM daily""")
def _(t):
    from tidepanel.functions.scalars import pm25_to_aqi

    fields = ["pm2_5", "pm10"]
    rows = R.array_payload(_array_payloads(t, "daily", fields), "daily", fields, keys=["city"])
    return fixed(rows.withColumn("aqi", pm25_to_aqi("pm2_5")))


@query("src_json_weather", " UNION ALL ".join(
    f"SELECT '{n}' AS measure, '{s}' AS statistic, {r(f'CAST({f}({c}) AS DOUBLE)')} AS value FROM daily"
    for n, c in (("temp", "no2"), ("humidity", "co"), ("wind_speed", "so2"))
    for s, f in (("count", "count"), ("mean", "avg"), ("std", "stddev_samp"), ("min", "min"),
                 ("max", "max"))))
def _(t):
    named = {"no2": "temp", "co": "humidity", "so2": "wind_speed"}
    source = type(t)(t.spark, t.sf_dir)
    source.__dict__["daily"] = t.daily.withColumnsRenamed(named)
    fields = list(named.values())
    rows = R.array_payload(_array_payloads(source, "daily", fields), "daily", fields, keys=["city"])
    return fixed(R.payload_describe(rows, fields))


@query("src_multi_entity", """
SELECT city, count(*) AS n FROM lines WHERE city IN ('A', 'N') GROUP BY city""")
def _(t):
    return t.lines.where(R.one_of("city", ["A", "N"])).groupBy("city").agg(F.count("*").alias("n"))


@query("src_fallback", f"SELECT city, ds, {r('y')} AS y FROM series")
def _(t):
    gone = shared_dir(t.spark, "absent")
    return fixed(R.first_available(
        lambda: t.spark.read.parquet(gone), lambda: t.series.where("y < 0"), lambda: t.series))


@query("src_exists", """
SELECT 'there' AS name, true AS found, count(*) AS n FROM series
UNION ALL SELECT 'absent', false, 0""")
def _(t):
    t.series.createOrReplaceTempView("there")
    return R.table_state(t.spark, "there").unionByName(R.table_state(t.spark, "absent"))


@query("src_view", f"""
SELECT city, date, {r('pm2_5')} AS pm25, {r('pm10')} AS pm10, {r('aqi')} AS aqi FROM daily""")
def _(t):
    rows = t.daily.withColumn("id", F.monotonically_increasing_id())
    R.legacy_view(rows, "legacy_daily")
    return fixed(t.spark.table("legacy_daily").select("city", "date", "pm25", "pm10", "aqi"))


@query("src_date_spine", """
SELECT city, CAST(unnest(generate_series(min(ds), max(ds) + 90, INTERVAL 1 DAY)) AS DATE) AS ds
FROM series GROUP BY city""")
def _(t):
    return R.date_spine(t.series, SERIES, 90)


@query("sink_append", f"""
SELECT city, ds, {r('y')} AS pm2_5, 'OpenAQ' AS data_source, false AS is_synthetic, true AS stamped
FROM series""")
def _(t):
    path = shared_dir(t.spark, "append")
    rows = K.stamp(t.series.withColumnRenamed("y", "pm25"))
    for part in ("ds < '1998-01-01'", "ds >= '1998-01-01'"):
        K.append(rows.where(part), path)
    back = t.spark.read.parquet(path)
    stamped = F.col("ingested_at").isNotNull().alias("stamped")
    return fixed(back.select("city", "ds", "pm2_5", "data_source", "is_synthetic", stamped))


@query("sink_unique_key", """
SELECT city, date, data_source, 1::BIGINT AS n FROM lines GROUP BY 1, 2, 3""")
def _(t):
    """Two overlapping loads leave one row per key."""
    path, key = shared_dir(t.spark, "unique"), K.key_of(PANEL)
    K.append_unique(FL.before(t.lines, "date", "2000-01-01"), path, key, "date")
    K.append_unique(FL.since(t.lines, "date", "1999-01-01"), path, key, "date")
    return K.stored(t.spark, path).groupBy(*key).agg(F.count("*").alias("n"))


@query("sink_winner", f"""
WITH loads AS (SELECT 1 AS load, city, date, data_source, aqi, pm2_5 FROM lines WHERE date < DATE '2000-01-01'
               UNION ALL SELECT 2, city, date, CASE WHEN data_source = 'source0' THEN NULL ELSE data_source END,
                                aqi + 1, pm2_5 FROM lines WHERE date >= DATE '1999-01-01'
               UNION ALL SELECT 3, city, date, CASE WHEN data_source = 'source0' THEN NULL ELSE data_source END,
                                aqi + 2, pm2_5 FROM lines WHERE date >= DATE '2000-06-01')
SELECT city, date, data_source, {r('aqi')} AS aqi, {r('pm2_5')} AS pm2_5 FROM (
  SELECT *, row_number() OVER (PARTITION BY city, date, data_source
                               ORDER BY load, aqi DESC, pm2_5 DESC) AS place FROM loads) WHERE place = 1""")
def _(t):
    """Overlapping loads that differ in value and have NULL key parts: the first load's row
    stays, and within a load the greatest values do."""
    path, key = shared_dir(t.spark, "winner"), K.key_of(PANEL)
    rows = t.lines.select("city", "date", "data_source", "aqi", "pm2_5")
    late = rows.withColumn("data_source", F.when(F.col("data_source") != "source0", F.col("data_source")))
    K.append_unique(FL.before(rows, "date", "2000-01-01"), path, key, "date")
    K.append_unique(FL.since(late, "date", "1999-01-01").withColumn("aqi", F.col("aqi") + 1), path, key, "date")
    K.append_unique(FL.since(late, "date", "2000-06-01").withColumn("aqi", F.col("aqi") + 2), path, key, "date")
    return fixed(K.stored(t.spark, path))


@query("sink_recreate", f"SELECT city, ds, {r('y')} AS y FROM series WHERE year(ds) = 2000")
def _(t):
    path = shared_dir(t.spark, "recreate")
    K.recreate(t.series, path)
    K.recreate(FL.in_year(t.series, "ds", 2000), path)
    return fixed(t.spark.read.parquet(path))


@query("sink_csv", f"SELECT city, model, {r('mape')} AS mape, n_test FROM metrics")
def _(t):
    path = shared_dir(t.spark, "results-csv")
    K.to_csv(fixed(t.metrics.select("city", "model", "mape", "n_test")), path)
    return t.spark.read.schema("city string, model string, mape double, n_test bigint") \
        .option("header", True).csv(path)


@query("sink_json_config", """
SELECT city, concat(printf('%.1f', mape), '%') AS validation_mape, model, 'baseline' AS kind FROM metrics""")
def _(t):
    path = shared_dir(t.spark, "config")
    K.model_config(t.metrics, PANEL, {"kind": "baseline"}, ["model"]).write.json(path)
    return t.spark.read.schema("city string, validation_mape string, model string, kind string").json(path)


@query("stream_ingest", f"""
SELECT city, CAST(datetime AS DATE) AS date, count(*) AS n, {r('avg(pm2_5)')} AS pm2_5,
       'stream' AS data_source FROM readings GROUP BY ALL""")
def _(t):
    """The event files as a stream: appended once per key, then read as a panel."""
    path = shared_dir(t.spark, "stream")
    source = ST.file_source(t.spark, t.sf_dir, t.raw("events").schema, "events.parquet")
    rows = source.select(F.col("event_type").alias("city"), F.col("ts").alias("datetime"),
                         F.col("event_id"), F.col("value").alias("pm25"))
    ST.run_available(ST.ingest(rows, PANEL.with_(time="datetime", tie_break=("event_id",)), path,
                               shared_dir(t.spark, "stream-state"), "stream"))
    back = t.spark.read.parquet(path)
    return fixed(back.groupBy("city", F.to_date("datetime").alias("date"), "data_source").agg(
        F.count("*").alias("n"), F.avg("pm2_5").alias("pm2_5")))
