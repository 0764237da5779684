import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import day, frame
from tidepanel.operators import aggregates as A
from tidepanel.operators import correlation as C
from tidepanel.operators import distribution as D
from tidepanel.operators import filters as FL
from tidepanel.operators import joins as J
from tidepanel.operators import quality as Q
from tidepanel.operators import ranking as R
from tidepanel.operators import reshape as X
from tidepanel.panel import PanelSpec
from tidepanel.plans import features as P

SPEC = PanelSpec()
SCHEMA = "city string, date date, aqi double"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_ranking_ties_and_nulls(spark):
    df = frame(spark, [("b", day(0), 5.0), ("a", day(0), 5.0), ("c", day(0), None), ("d", day(0), 9.0)], SCHEMA)
    assert [r["city"] for r in A.entity_ranking(df, SPEC).collect()] == ["d", "a", "b", "c"]
    got = R.worst_best(df.where("city <> 'd'"), SPEC).first()
    assert (got["worst"], got["best"]) == ("a", "a")


def test_worst_best_of_nothing(spark):
    df = frame(spark, [("a", day(0), 1.0)], SCHEMA)
    assert tuple(R.worst_best(df, SPEC, 1990).first()) == (None, None, None, None)


def test_bucket_distribution(spark):
    df = frame(spark, [("a", "Good"), ("a", "Good"), ("a", "Poor"), ("a", None), ("b", None)],
               "city string, aqi_bucket string")
    got = X.bucket_distribution(df, SPEC).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["Good"], r["Poor"], r["Severe"], r["Total"]) == (2, 1, 0, 3)
    assert sum(r[f"{b}_pct"] for b in ("Good", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe")) \
        == pytest.approx(100)


def test_summer_only_has_no_ratio(spark):
    df = frame(spark, [("a", dt.date(2020, 5, 1), 10.0), ("b", dt.date(2020, 5, 1), 10.0),
                       ("b", dt.date(2020, 12, 1), 25.04)], SCHEMA)
    got = {r["city"]: (r["summer"], r["winter"], r["winter_summer_ratio"])
           for r in X.summer_winter(df, SPEC).collect()}
    assert got == {"a": (10.0, None, None), "b": (10.0, 25.0, 2.5)}


def test_count_recent_of_nothing_is_zero(spark):
    df = frame(spark, [("a", day(0), 1.0, False)], SCHEMA + ", is_synthetic boolean")
    assert A.count_recent(df, SPEC, "2030-01-01").first()["n"] == 0


def test_provenance_default(spark):
    df = frame(spark, [("a", True), ("b", False)], "city string, is_synthetic boolean")
    assert rows_of(FL.provenance(df, SPEC).select("city")) == [("b",)]
    assert FL.provenance(df, SPEC, True).count() == 2


def test_freshness_map(spark):
    at = dt.datetime(2024, 1, 1)
    df = frame(spark, [("a", day(0), False, "x", at), ("a", day(5), True, "y", at), ("b", day(1), False, "x", at)],
               "city string, date date, is_synthetic boolean, data_source string, ingested_at timestamp")
    got = A.freshness_report(df, SPEC).first()
    assert (got["total_rows"], got["real_rows"], got["synthetic_rows"], got["entities"]) == (3, 2, 1, 2)
    assert got["latest_real_date"] == day(1) and got["data_sources"] == {"x": 2, "y": 1}


def test_last_values_take_last_known_per_column(spark):
    df = frame(spark, [("a", day(0), 1.0, 2.0), ("a", day(1), None, 3.0), ("a", day(2), None, None)],
               "city string, date date, x double, y double")
    assert rows_of(A.last_values(df, SPEC, ["x", "y"])) == [("a", 1.0, 3.0)]


def test_forecast_by_month_fills_months(spark):
    df = frame(spark, [("a", dt.date(2030, 3, 1), 1.0, 0.0, 2.0)],
               "city string, ds date, yhat double, yhat_lower double, yhat_upper double")
    got = {r["month"]: r["yhat"] for r in A.forecast_by_month(df, SPEC, 2030).collect()}
    assert len(got) == 12 and got[3] == 1.0 and got[4] == 0.0


def test_batch_summary_of_nothing(spark):
    df = frame(spark, [], "city string, mape double, trend string")
    got = A.batch_summary(df, SPEC).first()
    assert got["entities"] == 0 and got["improving_pct"] is None and got["best"] is None


def test_current_level(spark):
    df = frame(spark, [("old", day(i), float(i)) for i in range(10)]
               + [("new", dt.date(2024, 2, 1), 7.0), ("new", day(0), 100.0)], SCHEMA)
    got = dict(rows_of(A.current_level(df, SPEC, rows=2)))
    assert got == {"old": 8.5, "new": 7.0}


def test_correlation_is_pairwise(spark):
    df = frame(spark, [(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 0.5), (4.0, None, 0.0)],
               "pm2_5 double, aqi double, no2 double")
    got = {(r["a"], r["b"]): r["r"] for r in C.correlation_pairs(df).collect()}
    assert len(got) == 9 and got["aqi", "aqi"] == 1.0
    assert got["pm2_5", "aqi"] == pytest.approx(1) == got["aqi", "pm2_5"]
    assert got["pm2_5", "no2"] == pytest.approx(-1)
    m = {r["measure"]: r["aqi"] for r in C.correlation_matrix(df).collect()}
    assert m["pm2_5"] == 1.0


def test_correlation_far_from_zero(spark):
    """Large offsets, a constant, and rows over many tasks."""
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, 4000)
    values = np.stack([1e7 + x, -3e5 + 2 * x + rng.normal(0, 1, 4000), np.full(4000, 0.1), rng.normal(0, 1, 4000)], 1)
    df = frame(spark, values.tolist(), "pm2_5 double, aqi double, no2 double, o3 double").repartition(16)
    got = {(r["a"], r["b"]): r["r"] for r in C.correlation_pairs(df).collect()}
    want = np.corrcoef(values[:, [0, 1, 3]].T)
    for i, a in enumerate(("pm2_5", "aqi", "o3")):
        for j, b in enumerate(("pm2_5", "aqi", "o3")):
            assert got[a, b] == pytest.approx(want[i, j], abs=1e-9)
    assert got["no2", "aqi"] is None and got["no2", "no2"] == 1.0 and len(got) == 16
    assert C.correlation_pairs(df.limit(0)).count() == 0


def test_null_entity_shapes(spark):
    df = frame(spark, [("k1",), ("k1",), ("k2",), (None,)], "k string")
    dim = frame(spark, [("k1",)], "k string")
    assert tuple(J.unmatched(df, dim, "k").first()) == (2, 1)
    assert tuple(Q.duplicates(df, ["k"]).first()) == (1, 1)


def test_completeness_warnings(spark):
    df = frame(spark, [("a", None, 1.0), ("a", None, 2.0), ("a", 1.0, 3.0), ("b", 1.0, 1.0)],
               "city string, no2 double, co double")
    got = {r["city"]: (r["mostly_missing"], r["well_covered"])
           for r in Q.completeness_warnings(df, SPEC).collect()}
    assert got == {"a": (["no2"], False), "b": ([], True)}


def test_resample_keeps_empty_periods(spark):
    df = frame(spark, [("a", dt.date(2020, 1, 15), 1.0), ("a", dt.date(2020, 3, 2), 3.0)], SCHEMA)
    got = rows_of(D.resample_mean(df, SPEC, "ME").orderBy("period"))
    assert got == [("a", dt.date(2020, 1, 31), 1.0), ("a", dt.date(2020, 2, 29), None),
                   ("a", dt.date(2020, 3, 31), 3.0)]
    ends = rows_of(df.select(D.period_end("date", "W"), D.period_end("date", "QE")))
    assert ends == [(dt.date(2020, 1, 19), dt.date(2020, 3, 31)), (dt.date(2020, 3, 8), dt.date(2020, 3, 31))]
    sunday = frame(spark, [(dt.date(2020, 1, 19),)], "date date")
    assert rows_of(sunday.select(D.period_end("date", "W"))) == [(dt.date(2020, 1, 19),)]


def test_histogram_density_sums_to_one(spark):
    df = frame(spark, [(float(i % 50),) for i in range(1000)] + [(None,)], "x double")
    got = D.histogram(df, "x", 7).orderBy("bin").collect()
    assert sum(r["count"] for r in got) == 1000 and len(got) == 7
    assert sum(r["density"] * (r["high"] - r["low"]) for r in got) == pytest.approx(1)
    same = frame(spark, [(3.0,), (3.0,)], "x double")
    assert D.histogram(same, "x", 4).agg(F.sum("count")).first()[0] == 2


def test_kde_integrates_to_one(spark):
    df = frame(spark, [(float(i % 97),) for i in range(2000)], "x double")
    got = D.kde_grid(df, "x", 200, 400).orderBy("x").collect()
    step = got[1]["x"] - got[0]["x"]
    assert sum(r["density"] for r in got) * step == pytest.approx(1, abs=0.01)


def test_feature_names_and_groups(spark):
    df = frame(spark, [("a", day(0), 1.0, 2, 3.0, 0.5)],
               "city string, date date, aqi double, month int, aqi_lag1 double, month_sin double")
    assert FL.numeric_features(df) == ["month", "aqi_lag1", "month_sin"]
    assert FL.numeric_features(df, wide_types_only=True) == ["aqi_lag1", "month_sin"]
    assert P.feature_groups(df, SPEC)["lags"] == ["aqi_lag1"]


def test_tail_rows(spark):
    df = frame(spark, [("a", day(i), float(i)) for i in range(9)] + [("b", day(0), 1.0)], SCHEMA)
    got = R.tail_rows(df, SPEC, 2).orderBy("city", "date").collect()
    assert [(r["city"], r["aqi"]) for r in got] == [("a", 7.0), ("a", 8.0), ("b", 1.0)]
