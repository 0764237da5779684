import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, frame
from tidepanel.panel import PanelSpec
from tidepanel.plans import dataset as D
from tidepanel.plans import features as P

SPEC = PanelSpec()


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(42)
    rows = [("Delhi", day(i), *[round(rng.uniform(5, 300), 2) for _ in range(7)]) for i in range(100)]
    rows[3] = (*rows[3][:4], 0.0, *rows[3][5:])  # pm10 = 0
    return frame(spark, rows, "city string, date date, aqi double, pm2_5 double, pm10 double, "
                              "no2 double, co double, o3 double, so2 double")


def test_feature_frame_columns(panel):
    out = P.feature_frame(panel, SPEC)
    assert len(out.columns) - len(panel.columns) == 48
    assert out.count() == 100
    first = out.orderBy("date").first()
    assert first["aqi_lag1"] is None and first["aqi_roll7_std"] == 0.0
    fourth = out.orderBy("date").collect()[3]
    assert fourth["pm25_pm10_ratio"] is None
    groups = P.feature_groups(out, SPEC)
    assert [len(groups[g]) for g in ("temporal", "lags", "rolling", "interactions", "normalization")] \
        == [8, 16, 18, 4, 1]


def test_feature_frame_options(panel):
    out = P.feature_frame(panel, SPEC, lags=False, rolling=False, seasonal=False, normalization=False)
    assert set(out.columns) - set(panel.columns) == {"pm25_pm10_ratio", "no2_co_product", "primary_secondary", "no2_so2_sum"}


def test_leak_free_features_ignore_the_row(panel):
    changed = panel.withColumn("aqi", F.when(F.col("date") == day(60), 9999.0).otherwise(F.col("aqi")))
    cols = ["aqi_lag1", "aqi_roll3_mean", "aqi_roll30_std", "aqi_roll7_max", "aqi_city_zscore"]

    def row(df):
        out = P.feature_frame(df, SPEC, leak_free=True, train_until=str(day(50)))
        return out.where(F.col("date") == F.lit(day(60))).select(*cols).first()

    assert row(panel) == row(changed)


def test_split(panel):
    out = D.with_split(panel, SPEC, str(day(70)))
    parts = {r["split"]: (r["n"], r["a"], r["b"]) for r in out.groupBy("split").agg(
        F.count("*").alias("n"), F.min("date").alias("a"), F.max("date").alias("b")).collect()}
    assert parts["train"][0] + parts["test"][0] == 100
    assert parts["train"][2] < parts["test"][1] == day(70)


def brute_folds(days, first_gap=365, step=180, test=90, least=10):
    out, start, last = [], min(days) + dt.timedelta(first_gap), max(days)
    k = 0
    while start + dt.timedelta(test) <= last:
        end = start + dt.timedelta(test)
        n = sum(start <= d < end for d in days)
        if n >= least:
            out.append((k, start, end, sum(d < start for d in days), n))
        start += dt.timedelta(step)
        k += 1
    return out


def test_expanding_folds(spark):
    long = [day(i) for i in range(1200) if not 545 <= i < 626]  # second fold keeps nine test rows
    exact = [day(i) for i in range(456)]
    short = [day(i) for i in range(455)]
    rows = [(c, d) for c, ds in (("long", long), ("exact", exact), ("short", short)) for d in ds]
    df = frame(spark, rows, "city string, date date")
    got = D.expanding_folds(df, SPEC).orderBy("city", "fold").collect()
    for city, days in (("long", long), ("exact", exact), ("short", short)):
        mine = [(r["fold"], r["train_end"], r["test_end"], r["train_rows"], r["test_rows"])
                for r in got if r["city"] == city]
        assert mine == brute_folds(days)
    assert not any(r["city"] == "short" for r in got)
    assert 1 not in [r["fold"] for r in got if r["city"] == "long"]
    first = D.fold_rows(df, SPEC, D.expanding_folds(df, SPEC).where("city = 'exact'"))
    assert first.where("role = 'test'").count() == 90


def test_rolling_origins(spark):
    df = frame(spark, [("a", day(0)), ("a", day(365 * 3 + 10))], "city string, date date")
    got = D.rolling_origins(df, SPEC, 365, 365, 365).orderBy("fold").collect()
    last = 365 * 3 + 10
    assert [r["cutoff"] for r in got] == [day(last - 365), day(last - 730)]


def test_prepare(spark):
    rows = [("a", day(i), None if i == 7 else float(i), None if i % 3 else float(i),
             None if i % 10 else 1.0, None) for i in range(60)]
    df = frame(spark, rows, "city string, date date, aqi double, x double, sparse double, void double")
    out, kept = D.prepare(df, SPEC, ["x", "sparse", "void"], str(day(40)))
    assert kept == ["x"]
    assert out.count() == 59 and out.where("x is null or aqi is null").count() == 0
    # Median of the training part's known values 0, 3, ... 39.
    assert out.where(F.col("date") == F.lit(day(41))).first()["x"] == 19.5
    same, _ = D.prepare(df, SPEC, ["x", "sparse", "void"], str(day(40)), max_null=0.95)
    assert same.columns.count("sparse") == 1


def test_impute_by_entity(spark):
    rows = [("a", day(i), 1.0, None if i == 1 else 10.0) for i in range(4)]
    rows += [("b", day(i), 1.0, None) for i in range(4)]
    df = frame(spark, rows, "city string, date date, aqi double, x double")
    out = D.impute_by_entity(df, SPEC, ["x"], str(day(3)))
    got = {c: [r["x"] for r in out.where(f"city = '{c}'").collect()] for c in "ab"}
    assert got == {"a": [10.0] * 4, "b": [None] * 4}
