import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import frame
from tidepanel.functions import scalars as S


def one(spark, value, fn, kind="double"):
    return frame(spark, [(value,)], f"x {kind}").select(fn("x").alias("y")).first()["y"]


@pytest.mark.parametrize("x, want", [
    (None, None), (0.0, 0.0), (30.0, 50.1), (60.0, 100.1), (90.0, 199.9), (120.0, 299.9),
    (250.0, 400.1), (300.0, 420.0), (1000.0, 500.0), (float("nan"), None)])
def test_pm25_to_aqi(spark, x, want):
    got = one(spark, x, S.pm25_to_aqi)
    assert got == want if want is None else got == pytest.approx(want)


def test_pm25_to_aqi_rises_within_segments(spark):
    rows = frame(spark, [(i / 4,) for i in range(0, 2400)], "x double")
    got = [r["y"] for r in rows.select("x", S.pm25_to_aqi("x").alias("y")).orderBy("x").collect()]
    # The index drops a little right after 30, 60 and 250 by definition.
    assert all(b >= a - 0.2 for a, b in zip(got, got[1:]))
    assert max(got) == 500


@pytest.mark.parametrize("x, want", [(50.0, "Good"), (50.1, "Satisfactory"), (200.0, "Moderate"),
                                     (300.0, "Poor"), (400.0, "Very Poor"), (401.0, "Severe"),
                                     (None, None)])
def test_aqi_bucket(spark, x, want):
    assert one(spark, x, S.aqi_bucket) == want


@pytest.mark.parametrize("x, label, color", [
    (14.999, "Excellent", "green"), (15.0, "Good", "blue"), (19.999, "Good", "blue"),
    (20.0, "Moderate", "orange"), (29.999, "Moderate", "orange"), (30.0, "Poor", "red"),
    (None, "Poor", "red")])
def test_model_quality(spark, x, label, color):
    got = one(spark, x, S.model_quality)
    assert (got["label"], got["color"]) == (label, color)


def test_trend_label(spark):
    rows = frame(spark, [(1.0, 2.0), (2.0, 2.0), (3.0, None)], "p double, c double")
    got = [r[0] for r in rows.select(S.trend_label("p", "c")).collect()]
    assert got == ["improving", "worsening", "unknown"]


def test_alert_and_bands(spark):
    rows = frame(spark, [(100.0,), (101.0,), (201.0,)], "x double")
    assert [r[0] for r in rows.select(S.aqi_alert("x")).collect()] == [None, "Moderate", "Poor"]
    rows = frame(spark, [(19.0,), (20.0,), (30.0,)], "x double")
    assert [r[0] for r in rows.select(S.data_quality_band("x")).collect()] == ["High", "Medium", "Low"]
    assert [r[0] for r in rows.select(S.bar_color("x")).collect()] == ["green", "orange", "red"]


def test_seasons_cover_their_months(spark):
    rows = frame(spark, [(dt.date(2020, m, 1),) for m in range(1, 13)], "d date")
    got = rows.select(S.season("d", S.SUMMER_WINTER), S.season("d", S.FOUR_SEASONS),
                      S.season("d", S.ERROR_SEASONS)).collect()
    assert [r[0] for r in got] == ["winter", "winter", None, "summer", "summer", "summer", None,
                                   None, None, None, "winter", "winter"]
    assert all(r[1] and r[2] for r in got)
    assert got[8][1] == "Monsoon" and got[8][2] == "Summer/Monsoon (Jun-Sep)"


def test_calendar_parts(spark):
    rows = frame(spark, [(dt.datetime(2024, 1, 6, 13, 0),)], "t timestamp_ntz")
    got = rows.select(*[c.alias(n) for n, c in S.calendar_parts("t").items()],
                      S.is_weekend("t").alias("w")).first()
    assert got.asDict() == {"hour": 13, "day_of_week": 5, "month": 1, "quarter": 1, "year": 2024,
                            "day_of_year": 6, "day_name": "Saturday", "w": 1}


def test_cyclical_stays_on_the_circle(spark):
    rows = frame(spark, [(m,) for m in range(1, 13)], "m int")
    s, c = S.cyclical(F.col("m"), 12)
    for r in rows.select("m", s.alias("s"), c.alias("c")).collect():
        assert r["s"] == pytest.approx(math.sin(2 * math.pi * r["m"] / 12))
        assert r["s"] ** 2 + r["c"] ** 2 == pytest.approx(1)


def test_ratio_clip_dates(spark):
    rows = frame(spark, [(6.0, 2.0, "2020-02-29T10:00"), (1.0, 0.0, "no date")],
                 "a double, b double, t string")
    got = rows.select(S.ratio_safe("a", "b"), S.clip("a", 2, 5), S.parse_date("t")).collect()
    assert [tuple(r) for r in got] == [(3.0, 5.0, dt.date(2020, 2, 29)), (None, 2.0, None)]


@pytest.mark.parametrize("hours, days", [(0, 1), (23, 1), (24, 2), (72, 4), (336, 15)])
def test_horizon_to_days(hours, days):
    assert S.horizon_to_days(hours) == days
