import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import day, frame
from tidepanel.models import segments, trend
from tidepanel.models.trend import TrendModel
from tidepanel.panel import PanelSpec
from tidepanel.plans import forecasting as FC
from tidepanel.sources.readers import date_spine

SPEC = PanelSpec(time="ds", target="y")
DAYS = 4 * 365


def wave(i):
    d = (day(i, "2016-01-01") - dt.date(1970, 1, 1)).days
    return 2 * math.pi * d / 365.25


def level(city, i):
    slope, size = {"up": (0.05, 30), "down": (-0.02, 10)}[city]
    return 100 + slope * i + size * math.sin(wave(i)) + 5 * math.cos(2 * wave(i))


@pytest.fixture(scope="module")
def series(spark):
    rows = [(c, day(i, "2016-01-01"), level(c, i)) for c in ("up", "down") for i in range(DAYS)]
    random.Random(0).shuffle(rows)
    return frame(spark, rows, "city string, ds date, y double").repartition(5).cache()


def test_recovers_a_noiseless_signal(spark, series):
    ahead = FC.forecast_entities(series, SPEC, 365).collect()
    assert len(ahead) == 2 * (DAYS + 365)
    start = dt.date(2016, 1, 1)
    for r in ahead:
        i = (r["ds"] - start).days
        tolerance = 0.5 if i < DAYS else 3.0
        assert r["yhat"] == pytest.approx(level(r["city"], i), abs=tolerance)
        assert r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"]


def test_future_has_exactly_the_wanted_days(series):
    ahead = FC.future_only(FC.forecast_entities(series, SPEC, 30), series, SPEC)
    got = {r["city"]: (r["n"], r["a"]) for r in ahead.groupBy("city").agg(
        F.count("*").alias("n"), F.min("ds").alias("a")).collect()}
    assert got == {c: (30, day(DAYS, "2016-01-01")) for c in ("up", "down")}
    assert ahead.where("yhat is null or yhat_lower is null").count() == 0


def test_sums_follow_the_stretches_not_the_tasks(series):
    rows = series.repartition(64)
    m = TrendModel()
    sums = trend.partial_sums(rows, trend._scaling(rows, m, ["city"]), m, ["city"])
    assert sums.count() <= 2 * 2  # four years lie in at most two stretches


def test_partitioning_does_not_change_the_fit(series):
    a = trend.fit(series.coalesce(1), SPEC).orderBy("city").collect()
    b = trend.fit(series.repartition(13), SPEC).orderBy("city").collect()
    for x, y in zip(a, b):
        assert x["beta"] == pytest.approx(y["beta"], abs=1e-6) and x["n"] == y["n"] == DAYS


def design(days, changes, order):
    t = (days - days[0]) / (days[-1] - days[0])
    epoch = (day(0) - dt.date(1970, 1, 1)).days + days
    columns = [np.ones(len(t)), t]
    columns += [np.maximum(t - 0.8 * i / (changes + 1), 0) for i in range(1, changes + 1)]
    columns += [f(2 * np.pi * k * epoch / 365.25) for k in range(1, order + 1) for f in (np.sin, np.cos)]
    return np.column_stack(columns)


def test_meets_the_conditions_of_a_least_sum(spark):
    rng = np.random.default_rng(8)
    days = np.sort(rng.choice(1500, 700, replace=False))
    y = 50 + 0.03 * days + 0.1 * np.maximum(days - 800, 0) + rng.normal(0, 8, 700)
    df = frame(spark, [("a", day(int(d)), float(v)) for d, v in zip(days, y)],
               "city string, ds date, y double")
    m = TrendModel(order=3, changes=4)
    fits = trend.fit(df.repartition(6), SPEC, m)
    beta = np.array(fits.first()["beta"])
    x, scale = design(days, 4, 3), np.abs(y).max()
    got = trend.predict(fits, df, SPEC, m).orderBy("ds").collect()
    assert [r["yhat"] for r in got] == pytest.approx(list(x @ beta * scale), abs=1e-6)
    slope = 2 * (x.T @ (x @ beta - y / scale) + m.ridge() * beta)
    thin, zero = m.lasso() > 0, beta == 0
    assert np.abs(slope[~thin]).max() < 1e-7
    assert np.abs(slope + m.lasso() * np.sign(beta))[thin & ~zero].max() < 1e-7
    assert (np.abs(slope[zero]) <= m.lasso()[zero] + 1e-7).all() and 0 < zero.sum() < 4


def test_finds_known_changes(spark):
    """Of 25 places two have a change, on a knot each; the others stay zero or next to them."""
    rng, n = np.random.default_rng(2), 2601
    at, size = {5: 0.0, 14: 0.0}, {"bent": (0.08, -0.16), "straight": (0.0, 0.0)}
    rows = []
    for c, sizes in size.items():
        y = 100 + 0.02 * np.arange(n)
        for k, s in zip(at, sizes):
            y += s * np.maximum(np.arange(n) - 0.8 * k / 26 * (n - 1), 0)
        rows += [(c, day(i), float(v)) for i, v in enumerate(y + rng.normal(0, 2, n))]
    fits = {r["city"]: r for r in trend.fit(frame(spark, rows, "city string, ds date, y double"), SPEC).collect()}
    changes = {c: np.array(r["beta"][2:27]) * r["_scale"] / (n - 1) for c, r in fits.items()}
    assert (np.abs(changes["straight"]) < 1e-3).all()
    bent = changes["bent"]
    # The prior shrinks what it does not cut.
    assert bent[3:6].sum() == pytest.approx(0.08, abs=0.03) and bent[12:15].sum() == pytest.approx(-0.16, abs=0.03)
    assert np.abs(np.delete(bent, [3, 4, 5, 12, 13, 14])).max() < 0.01 and (bent == 0).sum() >= 15
    assert fits["bent"]["drift"] > 3 * fits["straight"]["drift"]


def test_bounds_widen_as_simulated_changes_do(spark):
    m = TrendModel(order=0, changes=8)
    rng, n = np.random.default_rng(3), 1001
    y = 100 + 0.05 * np.maximum(np.arange(n) - 400, 0) + rng.normal(0, 1, n)
    df = frame(spark, [("a", day(i), float(v)) for i, v in enumerate(y)], "city string, ds date, y double")
    fits = trend.fit(df, SPEC, m)
    f = fits.first()
    ahead = trend.predict(fits, date_spine(df, SPEC, 800), SPEC, m).orderBy("ds").collect()
    half = np.array([r["yhat_upper"] - r["yhat"] for r in ahead]) / f["_scale"] / 1.2815515655446004
    assert np.ptp(half[:n]) < 1e-9 and half[:n] == pytest.approx(f["sigma"])
    assert (np.diff(half[n:]) > 0).all()
    for days in (200, 800):
        h = days / (n - 1)
        paths = []
        for _ in range(20_000):  # changes at the rate and size of the fitted ones
            k = rng.poisson(8 * h)
            paths.append((rng.laplace(0, f["drift"], k) * (h - rng.uniform(0, h, k))).sum())
        assert half[n - 1 + days] == pytest.approx(np.sqrt(np.var(paths) + f["sigma"] ** 2), rel=0.05)


def test_interval_covers_noise(spark):
    rng = random.Random(1)
    rows = [("a", day(i), 100 + rng.gauss(0, 10)) for i in range(1500)]
    df = frame(spark, rows, "city string, ds date, y double")
    out = trend.predict(trend.fit(df, SPEC), df, SPEC)
    inside = out.where("y between yhat_lower and yhat_upper").count() / 1500
    assert 0.75 < inside < 0.86
    wide = trend.predict(trend.fit(df, SPEC), df, SPEC, TrendModel(interval=0.95))
    assert wide.where("y between yhat_lower and yhat_upper").count() / 1500 > 0.92


def test_logistic_stays_within_bounds(spark):
    rows = [("a", day(i), 20 + 400 / (1 + math.exp(-(i - 700) / 150))) for i in range(1400)]
    df = frame(spark, rows, "city string, ds date, y double")
    m = TrendModel(floor=20.0, cap=500.0)
    out = trend.predict(trend.fit(df, SPEC, m), date_spine(df, SPEC, 3000), SPEC, m)
    assert out.where("yhat_lower < 20 or yhat_upper > 500").count() == 0
    near = out.join(df, ["city", "ds"]).where("abs(yhat - y) > 40").count()
    assert near < 100


def test_saturating_curve_is_recovered_on_its_own_scale(spark):
    """Noise that is even on the target's scale, waves that do not shrink near the cap."""
    rng = np.random.default_rng(6)
    curve = lambda i: 20 + 400 / (1 + np.exp(-(i - 500) / 180)) + 12 * np.sin(wave(i))
    rows = [("a", day(i, "2016-01-01"), float(curve(i) + rng.normal(0, 6))) for i in range(1461)]
    rows += [("flat", day(i, "2016-01-01"), float(220 + rng.normal(0, 6))) for i in range(1461)]
    df = frame(spark, rows, "city string, ds date, y double")
    m = TrendModel(floor=20.0, cap=420.0, order=2, changes=0)
    fits = trend.fit(df, SPEC, m)
    ahead = trend.predict(fits, date_spine(df, SPEC, 365), SPEC, m).where("city = 'a'").orderBy("ds").collect()
    error = np.array([r["yhat"] - min(curve(i), 420) for i, r in enumerate(ahead)])
    assert np.abs(error).max() < 3.0 and np.sqrt((error ** 2).mean()) < 1.2
    beta = next(np.array(r["beta"]) for r in fits.collect() if r["city"] == "a")
    assert beta[1] == pytest.approx(1460 / 180, rel=0.05)  # slope of the curve over the span
    logit = trend.predict(trend.fit(df, SPEC, TrendModel(floor=20.0, cap=420.0, order=2, changes=0, steps=0)), df,
                          SPEC, TrendModel(floor=20.0, cap=420.0, order=2, changes=0, steps=0)).where("city = 'a'")
    worse = np.array([r["yhat"] - curve(i) for i, r in enumerate(logit.orderBy("ds").collect())])
    assert (worse ** 2).mean() > 4 * (error[:1461] ** 2).mean()


def test_regressor_effects(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        temp, wind = rng.uniform(0, 30), rng.uniform(0, 9)
        rows.append(("a", day(i), 80 + 2.5 * temp - 4 * wind, temp, wind))
    df = frame(spark, rows, "city string, ds date, y double, temp double, wind double")
    m = TrendModel(regressors=("temp", "wind"))
    got = {r["regressor"]: (r["coef"], r["direction"])
           for r in trend.regressor_effects(trend.fit(df, SPEC, m), SPEC, m).collect()}
    assert got["temp"] == (pytest.approx(2.5, abs=0.05), "increases")
    assert got["wind"] == (pytest.approx(-4, abs=0.05), "decreases")
    table = FC.compare_regressors(df, SPEC, str(day(700)), {"Baseline": (), "Both": ("temp", "wind")})
    best = table.where("selected").first()
    assert best["model"] == "Both" and best["gain_pct"] > 80


def test_batch_statuses(spark, series):
    extra = [("short", day(i, "2016-01-01"), 1.0) for i in range(50)]
    extra += [("stale", day(i, "2010-01-01"), 1.0) for i in range(1200)]
    extra += [("few", day(i, "2016-01-01"), 1.0 + i % 7) for i in range(DAYS - 350)]
    rows = series.unionByName(frame(spark, extra, "city string, ds date, y double"))
    cutoff = str(day(DAYS - 365, "2016-01-01"))
    out = {r["city"]: r for r in FC.batch_forecast(
        rows, SPEC, cutoff, "2019-01-01", 2020, 365, min_days=1000).collect()}
    assert {c: r["status"] for c, r in out.items()} == {
        "short": "insufficient_data", "stale": "no_recent_data", "few": "insufficient_test",
        "up": "success", "down": "success"}
    assert out["up"]["mape"] < 3 and out["up"]["trend"] == "worsening"
    assert out["down"]["trend"] == "improving" and out["short"]["trend"] is None
    # No entity passes: a typed empty summary, not an error.
    none = FC.batch_forecast(rows, SPEC, cutoff, "2019-01-01", 2020, 365, min_days=10**6)
    assert FC.summary_of(none, SPEC).first()["entities"] == 0


def test_validation_report_and_variants(series):
    cutoff = str(day(DAYS - 365, "2016-01-01"))
    got = {r["city"]: r for r in FC.validation_report(series, SPEC, cutoff).collect()}
    assert got["up"]["status"] == "ok" and got["up"]["quality"] == "Excellent"
    assert (got["up"]["train_days"], got["up"]["test_days"]) == (DAYS - 365, 365)
    short = FC.validation_report(series, SPEC, str(day(DAYS - 10, "2016-01-01")))
    assert {r["status"] for r in short.collect()} == {"insufficient_test"}
    variants = FC.training_variants(series, SPEC, cutoff, ("2018-01-01", "2018-06-30")).collect()
    assert len(variants) == 6 and sum(r["selected"] for r in variants) == 2


def test_cross_validation_uses_only_the_past(series):
    folds = FC.cross_validation(series, SPEC, 730, 365, 180)
    got = folds.groupBy("city", "fold").agg(F.count("*").alias("n"), F.min("ds").alias("a")).collect()
    assert len(got) == 4 and all(r["n"] == 180 for r in got)


def test_ranges_share_their_sums(spark):
    """Fits of ranges equal those of their own rows, and no row is repeated per range."""
    rng = np.random.default_rng(11)
    rows = []
    for c, n in (("a", 1900), ("b", 1300), ("short", 20)):
        days = np.sort(rng.choice(2200, n, replace=False))
        y = 60 + 0.03 * days - 0.06 * np.maximum(days - 900, 0) + rng.normal(0, 5, n)
        rows += [(c, day(int(d)), None if i % 97 == 5 else float(v)) for i, (d, v) in enumerate(zip(days, y))]
    df = frame(spark, rows, "city string, ds date, y double").repartition(4)
    spans = [("one", None, day(1000)), ("two", None, day(1500)), ("gap", None, day(700)),
             ("gap", day(950), day(2100)), ("late", day(1200), None), ("none", day(5000), None)]
    ranges = frame(spark, [(c, *s) for c in ("a", "b", "short") for s in spans], "city string, fold string, from date, until date")
    for m in (TrendModel(order=3, changes=6), TrendModel(order=0, changes=0)):
        keys = ["city", "fold"]
        inside = "(from is null or ds >= from) and (until is null or ds <= until)"
        want = trend.fit(df.join(ranges, "city").where(inside).drop("from", "until"), SPEC, m, keys)
        got = segments.fit_ranges(df, ranges, SPEC, m, ["fold"])
        both = [{(r["city"], r["fold"]): r for r in f.collect()} for f in (want, got)]
        assert set(both[0]) == set(both[1]) and len(both[0]) >= 8
        for k, w in both[0].items():
            g = both[1][k]
            assert (g["n"], g["_t0"], g["_span"]) == (w["n"], w["_t0"], w["_span"])
            assert g["beta"] == pytest.approx(w["beta"], abs=2e-5) and g["sigma"] == pytest.approx(w["sigma"], abs=1e-6)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("MapInPandas") == 1


def test_reports(series):
    ahead = FC.forecast_entities(series, SPEC, 400)
    report = {r["city"]: r for r in FC.forecast_report(series, SPEC, ahead, 2019, 2020).collect()}
    assert report["up"]["trend"] == "worsening" and report["up"]["data_points"] == DAYS
    missing = FC.forecast_report(series, SPEC, ahead, 1990, 2020).first()
    assert missing["trend"] == "unknown"
    points = FC.report_points(series, SPEC, ahead, 50).groupBy("city", "part").count().collect()
    assert {(r["city"], r["part"]): r["count"] for r in points}["up", "historical"] == 50
