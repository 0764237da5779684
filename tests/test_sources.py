import datetime as dt
import json


from tests.conftest import day, frame
from tidepanel.operators.filters import stamped
from tidepanel.panel import PanelSpec
from tidepanel.sources import readers as R
from tidepanel.sources import schemas
from tidepanel.sources import sinks as K
from tidepanel.streaming import ingest as ST

SPEC = PanelSpec()
KEY = ["city", "date", "data_source"]


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_daily_csv(spark, work):
    head = ",".join(schemas.DAILY_HEADERS)
    path = write(f"{work}/d.csv", f"{head}\nDelhi,2019-01-02,{'1.5,' * 12}100,Good\n"
                                  f"Delhi,2019-01-03,NaN,{',' * 11}90,\n,2019-01-04,{',' * 12}1,\n")
    got = R.daily_csv(spark, path).orderBy("date").collect()
    assert len(got) == 2  # the row without an entity is dropped
    assert got[0]["pm2_5"] == 1.5 and got[0]["date"] == dt.date(2019, 1, 2)
    assert got[0]["data_source"] == "CPCB" and got[0]["is_synthetic"] is False
    assert got[1]["pm2_5"] is None and got[1]["aqi"] == 90.0


def test_hourly_and_processed_csv(spark, work):
    head = ",".join(schemas.HOURLY_HEADERS)
    path = write(f"{work}/h.csv", f"{head}\nDelhi,2019-01-02 05:00:00,{'2,' * 12}7,Good\n")
    rows = R.hourly_csv(spark, path)
    assert rows.first()["datetime"] == dt.datetime(2019, 1, 2, 5)
    report = R.ingest_report(rows, SPEC.with_(time="datetime")).first()
    assert (report["rows"], report["entities"]) == (1, 1)
    path = write(f"{work}/p.csv", "city,date,pm25\na,2019-01-01,4\n")
    assert R.processed_csv(spark, path, ["city", "date", "pm25"]).first()["pm2_5"] == 4.0
    path = write(f"{work}/q.csv", "city,date,aqi\na,2019-01-01,4\n")
    assert R.processed_csv(spark, path, ["city", "date", "aqi"]).first()["aqi"] == 4.0


def test_row_payload(spark):
    payload = {"results": [
        {"date": {"local": "2024-01-01T10:00:00+05:30"}, "value": 20.0, "location": "x"},
        {"date": {"local": "2024-01-01T11:00:00+05:30"}, "value": 40.0, "location": None},
        {"date": {"local": "2024-01-02T10:00:00+05:30"}, "value": None}]}
    df = frame(spark, [("a", json.dumps(payload)), ("b", '{"results": []}'), ("c", "broken")],
               "city string, payload string")
    rows = R.row_payload(df, keys=["city"])
    assert {r["location"] for r in rows.collect()} == {"x", "unknown"}
    got = {r["date"]: (r["pm2_5"], r["aqi"]) for r in R.payload_daily_index(rows, ["city"]).collect()}
    assert got[dt.date(2024, 1, 1)] == (30.0, 30.0 * 1.67) and got[dt.date(2024, 1, 2)] == (None, None)


def test_array_payload(spark):
    payload = {"daily": {"time": ["2024-01-01", "2024-01-02"], "pm2_5": [1.0, None], "pm10": [3.0]}}
    df = frame(spark, [("a", json.dumps(payload))], "city string, payload string")
    rows = R.array_payload(df, "daily", ["pm2_5", "pm10"], keys=["city"])
    assert [tuple(r) for r in rows.orderBy("date").collect()] == [
        ("a", dt.date(2024, 1, 1), 1.0, 3.0), ("a", dt.date(2024, 1, 2), None, None)]


def loaded(spark, days, source="x"):
    return stamped(frame(spark, [("a", day(i), float(i)) for i in days], "city string, date date, aqi double"),
                   {"data_source": source})


def test_append_unique_is_idempotent(spark, work):
    path = f"{work}/t"
    for days in (range(10), range(10), range(5, 15)):
        K.append_unique(loaded(spark, days), path, KEY, "date")
    K.append_unique(loaded(spark, [3, 3], "y"), path, KEY, "date")
    K.append_unique(loaded(spark, []), path, KEY, "date")
    got = spark.read.parquet(path)
    assert got.where("data_source = 'x'").count() == 15 and got.where("data_source = 'y'").count() == 1


def test_stamp_renames(spark):
    got = K.stamp(frame(spark, [("a", 1.0)], "city string, pm25 double")).first()
    assert got["pm2_5"] == 1.0 and got["data_source"] == "OpenAQ" and got["ingested_at"] is not None


def test_recreate_csv_and_json(spark, work):
    K.recreate(loaded(spark, range(4)), f"{work}/r")
    K.recreate(loaded(spark, range(2)), f"{work}/r")
    assert spark.read.parquet(f"{work}/r").count() == 2
    K.to_csv(loaded(spark, range(2)), f"{work}/c")
    assert spark.read.option("header", True).csv(f"{work}/c").count() == 2
    K.to_json(spark, {"model": "trend", "horizon": "2030"}, f"{work}/j")
    assert spark.read.json(f"{work}/j").first()["horizon"] == "2030"


def test_source_choice(spark, work):
    empty, full = loaded(spark, []), loaded(spark, [1])
    got = R.first_available(lambda: spark.read.parquet(f"{work}/none"), lambda: None, lambda: empty, lambda: full)
    assert got.count() == 1
    assert R.first_available(lambda: empty) is None
    full.createOrReplaceTempView("full_table")
    assert R.has_rows(spark, "full_table") and not R.has_rows(spark, "no_table")


def test_spines(spark):
    df = frame(spark, [("a", day(0)), ("a", day(2)), ("b", day(5))], "city string, date date")
    assert R.date_spine(df, SPEC, 2).groupBy("city").count().orderBy("city").collect()[0]["count"] == 5
    ahead = R.future_spine(df, SPEC, 3).where("city = 'b'").orderBy("ds").collect()
    assert [r["ds"] for r in ahead] == [day(6), day(7), day(8)]


def test_legacy_view(spark):
    R.legacy_view(frame(spark, [(1, "a", 2.0)], "id long, city string, pm2_5 double"), "legacy")
    assert spark.table("legacy").columns == ["city", "pm25"]


def test_stream_appends_each_key_once(spark, work):
    rows = frame(spark, [("a", dt.datetime(2024, 1, 1, i % 5), 1.0) for i in range(10)],
                 "city string, datetime timestamp_ntz, pm25 double")
    rows.repartition(3).write.parquet(f"{work}/in")
    spec = PanelSpec(time="datetime")
    for again in range(2):
        if again:
            rows.limit(4).write.mode("append").parquet(f"{work}/in")
        source = ST.file_source(spark, f"{work}/in", rows.schema)
        ST.run_available(ST.ingest(source, spec, f"{work}/out", f"{work}/state", "live"))
    got = spark.read.parquet(f"{work}/out")
    assert got.count() == 5 and got.select("data_source").distinct().first()[0] == "live"


def test_table_query_binds_values(spark):
    loaded(spark, range(5)).createOrReplaceTempView("bound")
    assert R.table_query(spark, "SELECT * FROM bound WHERE aqi >= :a", a=3.0).count() == 2
    assert R.table_query(spark, "SELECT * FROM bound WHERE city = :c", c="a' OR '1'='1").count() == 0


