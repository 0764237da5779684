import pytest
from pyspark.sql import functions as F

from tests.conftest import day, frame
from tidepanel.operators import aggregates as A
from tidepanel.operators import evaluation as E
from tidepanel.operators import ranking as R
from tidepanel.panel import PanelSpec

SPEC = PanelSpec()
SCHEMA = "city string, model string, ds date, y double, yhat double"


def scored(spark, pairs):
    rows = [("a", "m", day(i), y, p) for i, (y, p) in enumerate(pairs)]
    return E.evaluate(frame(spark, rows, SCHEMA), ["city"]).first()


def test_known_scores(spark):
    assert scored(spark, [(50.0, 55.0)])["mape"] == pytest.approx(10)
    assert scored(spark, [(100.0, 90.0)])["rmse"] == pytest.approx(10)
    assert scored(spark, [(100.0, 80.0)])["mae"] == pytest.approx(20)
    got = scored(spark, [(100.0, 95.0), (110.0, 115.0), (120.0, 118.0), (95.0, 100.0), (105.0, 102.0)])
    assert got["mae"] == pytest.approx(4) and got["n_test"] == 5
    perfect = scored(spark, [(3.0, 3.0)])
    assert (perfect["mape"], perfect["rmse"], perfect["mae"]) == (0, 0, 0)


def test_nulls_zeros_and_nothing(spark):
    got = scored(spark, [(0.0, 5.0), (10.0, 20.0), (None, 1.0), (4.0, None)])
    assert got["mape"] == pytest.approx(100) and got["mae"] == pytest.approx(7.5) and got["n_test"] == 4
    empty = frame(spark, [], SCHEMA).agg(E.mape().alias("m")).first()
    assert empty["m"] is None


def test_bands_and_seasons(spark):
    rows = [("a", "m", day(0), 49.0, 59.0), ("a", "m", day(1), 50.0, 40.0), ("a", "m", day(200), 301.0, 301.0),
            ("a", "m", day(3), 100.0, None)]
    df = frame(spark, rows, SCHEMA)
    got = {r["band"]: (r["count"], r["mape"], r["bias"]) for r in E.error_by_band(df, ["city"]).collect()}
    assert got["Good (0-50)"] == (2, pytest.approx((10 / 50 + 10 / 51) / 2 * 100), pytest.approx(0))
    assert got["Very Poor (300+)"] == (1, 0.0, 0.0) and len(got) == 2
    seasons = {r["season"]: r["count"] for r in E.error_by_season(df, ["city"]).collect()}
    assert seasons == {"Winter (Dec-Feb)": 2, "Summer/Monsoon (Jun-Sep)": 1}
    worst = E.error_overall(df, ["city"]).first()
    assert worst["worst_ds"] == day(0) and worst["best_ds"] == day(200)


def test_rankings(spark):
    df = frame(spark, [("a", "x", 2.0), ("a", "y", 1.0), ("a", "z", None), ("b", "y", 3.0), ("b", "x", 3.0)],
               "city string, model string, rmse double")
    assert [(r["city"], r["model"], r["place"]) for r in
            R.model_rankings(df, SPEC).orderBy("city", "place").collect()] \
        == [("a", "y", 1), ("a", "x", 2), ("b", "x", 1), ("b", "y", 2)]
    assert {r["city"]: r["best_model"] for r in R.best_model(df, SPEC).collect()} == {"a": "y", "b": "x"}


def test_large_enough(spark):
    df = frame(spark, [("a",)] * 5 + [("b",)] * 3, "city string")
    assert E.large_enough(df, SPEC, 4).count() == 5


def test_fold_scores_and_range(spark):
    rows = [("a", k, 10.0, 10.0 + k, 9.0, 10.5) for k in range(3)]
    df = frame(spark, rows, "city string, fold int, y double, yhat double, yhat_lower double, yhat_upper double")
    got = E.fold_scores(df, ["city"]).first()
    assert got["folds"] == 3 and got["mape"] == pytest.approx(10) and got["coverage"] == 1.0
    low, high = E.expected_range(F.lit(100.0), F.lit(13.0))
    assert tuple(df.select(low, high).first()) == (pytest.approx(87), pytest.approx(113))


def test_unknown_scores_are_never_the_best(spark):
    df = frame(spark, [("a", "x", None), ("a", "y", 20.0), ("a", "z", 10.0)],
               "city string, model string, mape double")
    got = {r["model"]: (r["gain_pct"], r["selected"]) for r in E.improvement(df, ["city"], "y").collect()}
    assert got == {"x": (None, False), "y": (0.0, False), "z": (50.0, True)}
    batch = frame(spark, [("p", None, "improving"), ("q", 3.0, "worsening"), ("r", 5.0, "improving")],
                  "city string, mape double, trend string")
    one = A.batch_summary(batch, SPEC).first()
    assert (one["best"], one["worst"], one["entities"]) == ("q", "r", 3)
