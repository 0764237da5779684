import datetime as dt
import math
import random
import statistics

import pytest

from tests.conftest import day, frame
from tidepanel.operators import windows as W
from tidepanel.panel import PanelSpec

SPEC = PanelSpec()
SCHEMA = "city string, date date, aqi double, pm2_5 double"


@pytest.fixture(scope="module")
def values():
    rng = random.Random(3)
    return [None if i % 13 == 5 else round(rng.uniform(20, 300), 1) for i in range(120)]


@pytest.fixture(scope="module")
def panel(spark, values):
    # Day 40 is missing: frames count rows, not days.
    rows = [("a", day(i if i < 40 else i + 1), v, 1.0) for i, v in enumerate(values)]
    rows += [("one", day(0), 5.0, 2.0), ("flat", day(0), 7.0, 2.0), ("flat", day(1), 7.0, 2.0)]
    random.Random(1).shuffle(rows)
    return frame(spark, rows, SCHEMA)


def of(df, city, *cols):
    return [tuple(r) for r in df.where(f"city = '{city}'").orderBy("date").select(*cols).collect()]


def test_lags(panel, values):
    out = W.add_lags(panel, SPEC, ["aqi", "absent"], [1, 3])
    assert "absent_lag1" not in out.columns
    got = of(out, "a", "aqi_lag1", "aqi_lag3")
    assert got[0] == (None, None) and got[2][1] is None
    assert got == [(values[i - 1] if i else None, values[i - 3] if i > 2 else None)
                   for i in range(len(values))]


@pytest.mark.parametrize("leak_free", [False, True])
def test_rolling(panel, values, leak_free):
    out = W.add_rolling(panel, SPEC, ["aqi"], [3, 7], leak_free)
    got = of(out, "a", "aqi_roll7_mean", "aqi_roll7_std", "aqi_roll3_max")
    for i, (mean, std, top) in enumerate(got):
        end = i if leak_free else i + 1
        seven = [v for v in values[max(0, end - 7):end] if v is not None]
        three = [v for v in values[max(0, end - 3):end] if v is not None]
        assert mean == (pytest.approx(sum(seven) / len(seven)) if seven else None)
        assert std == pytest.approx(statistics.stdev(seven) if len(seven) > 1 else 0.0)
        assert top == (max(three) if three else None)


def test_zscore_edge_cases(panel, values):
    out = W.add_zscore(panel, SPEC)
    assert of(out, "one", "aqi_city_zscore") == [(None,)]
    assert of(out, "flat", "aqi_city_zscore") == [(0.0,), (0.0,)]
    known = [v for v in values if v is not None]
    m, s = statistics.mean(known), statistics.stdev(known)
    for (z,), v in zip(of(out, "a", "aqi_city_zscore"), values):
        assert z == (None if v is None else pytest.approx(round((v - m) / s, 3), abs=1.1e-3))


def test_trend_decomposition_centre(panel, values):
    got = of(W.trend_decomposition(panel, SPEC), "a", "trend", "seasonal_30")
    for i, (trend, rest) in enumerate(got):
        near = [v for v in values[max(0, i - 45):i + 45] if v is not None]
        want = sum(near) / len(near) if len(near) >= 30 else None
        assert trend == (None if want is None else pytest.approx(want))
        if values[i] is not None and want is not None:
            assert rest == pytest.approx(values[i] - want)


def test_baselines(panel, values):
    cutoff = str(day(60))
    days = [day(i if i < 40 else i + 1) for i in range(len(values))]
    test = [i for i, d in enumerate(days) if d >= day(60)]
    got = W.moving_average(panel.where("city = 'a'"), SPEC, cutoff).orderBy("ds").collect()
    assert [r["ds"] for r in got] == [days[i] for i in test]
    for r, i in zip(got, test):
        past = values[i - 7:i]
        want = None if None in past else sum(past) / 7
        assert r["yhat"] == (None if want is None else pytest.approx(want))
    got = W.seasonal_naive(panel.where("city = 'a'"), SPEC, cutoff, 50).orderBy("ds").collect()
    assert [r["yhat"] for r in got] == [values[i - 50] for i in test]


def test_gaps(spark):
    at = dt.datetime(2024, 1, 1)
    hours = [0, 1, 3, 6, 7, 31]  # gaps of exactly 2 h (none), 3 h and one day
    rows = [("a", at + dt.timedelta(hours=h), 1.0) for h in hours]
    rows += [("a", at + dt.timedelta(hours=5), None), ("single", at, 1.0)]
    df = frame(spark, rows, "city string, datetime timestamp_ntz, aqi double")
    spec = PanelSpec(time="datetime")
    for s in (spec, spec.with_(block_seconds=7200, tie_break=("aqi",))):
        assert [tuple(r) for r in W.detect_gaps(df, s).collect()] == [("a", 2, 24.0, 27.0)]


def test_last_features_and_runs(spark):
    rows = [("a", day(0), 1.0, 4.0), ("a", day(1), None, None), ("a", day(2), None, 9.0)]
    df = frame(spark, rows, SCHEMA)
    assert [tuple(r) for r in W.last_features(df, SPEC, ["aqi", "pm2_5"]).collect()] == [
        ("a", day(2), 0.0, 9.0)]
    assert [tuple(r) for r in W.missing_runs(df, SPEC).collect()] == [("a", day(1), day(2), 2)]


def test_calendar_window_sees_the_missing_day(panel, values):
    got = of(W.rolling_calendar(panel, SPEC, "aqi", 2), "a", "aqi_avg2d")
    assert got[40][0] == values[40]  # the day before is missing
    assert not math.isnan(got[41][0])


def test_blocks_do_not_change_runs_and_calendar_means(spark):
    rng = random.Random(5)
    at = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(900):  # "hot" has long stretches without values, over several slots
        value = None if i // 60 % 3 == 1 or rng.random() < 0.4 else float(rng.randrange(90))
        rows.append(("hot", at + dt.timedelta(hours=rng.randrange(700)), i, value))
    rows += [("none", at + dt.timedelta(days=d), 1000 + d, None) for d in range(4)]
    rows += [("one", at, 2000, 3.0), ("one", at, 2001, None), ("one", at + dt.timedelta(days=9), 2002, None)]
    rng.shuffle(rows)
    df = frame(spark, rows, "city string, datetime timestamp_ntz, id int, aqi double")
    plain = PanelSpec(time="datetime", tie_break=("id",))
    known = sorted(rows, key=lambda r: r[:3])
    want, last = [], None
    for city, time, _, value in known:
        if value is None and last == (city, None):
            want[-1][2:] = [time, want[-1][3] + 1]
        elif value is None:
            want.append([city, time, time, 1])
        last = (city, value)
    for seconds in (None, 3600, 86_400, 40 * 86_400):
        spec = plain.with_(block_seconds=seconds)
        assert sorted(list(r) for r in W.missing_runs(df, spec).collect()) == sorted(want)
        means = {r["id"]: r["aqi_avg3d"] for r in W.rolling_calendar(df, spec, "aqi", 3).collect()}
        assert len(means) == len(rows)
        for city, time, i, _ in rows:
            near = [v for c, t, _, v in rows if c == city and v is not None and 0 <= (time.date() - t.date()).days < 3]
            assert means[i] == (pytest.approx(sum(near) / len(near)) if near else None)
