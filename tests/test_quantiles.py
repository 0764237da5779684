import random
import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import frame
from tidepanel.functions import quantiles
from tidepanel.functions.quantiles import approx_quantiles, exact_quantiles
from tidepanel.operators import correlation
from tidepanel.operators.correlation import spearman_pairs
from tidepanel.operators.reshape import measure_summary
from tidepanel.panel import PanelSpec
from tidepanel.session import materialise

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def table(df):
    return {(r["city"], r["measure"], r["prob"]): r["q"] for r in df.collect()}


@pytest.fixture(scope="module")
def skewed(spark):
    """A hot group with heavy ties and tails, a small group, a one-row group."""
    rng = random.Random(5)
    hot = [float(rng.choice([0, 0, 0, 7, rng.gauss(0, 1), rng.expovariate(0.01)])) for _ in range(20000)]
    rows = [("hot", v, None if i % 3 else v * 2) for i, v in enumerate(hot)]
    rows += [("small", float(v), None) for v in range(10)] + [("one", 4.5, 1.0)]
    return frame(spark, rows, "city string, x double, y double").cache(), rows


@pytest.mark.parametrize("accuracy", [100_000, 500])
def test_exact_quantiles_match_numpy(skewed, accuracy):
    df, rows = skewed
    got = table(exact_quantiles(df, ["city"], ["x", "y"], PROBS, accuracy))
    for city in ("hot", "small", "one"):
        for i, name in ((1, "x"), (2, "y")):
            values = [r[i] for r in rows if r[0] == city and r[i] is not None]
            for p in PROBS:
                if values:
                    assert got[city, name, p] == pytest.approx(np.quantile(values, p))
                else:
                    assert (city, name, p) not in got


def test_approx_form(skewed):
    df, rows = skewed
    c = table(approx_quantiles(df, ["city"], ["x"], [0.5]))
    assert c["one", "x", 0.5] == 4.5


def test_without_groups(spark):
    df = frame(spark, [(float(i),) for i in range(11)], "x double")
    assert exact_quantiles(df, [], ["x"], [0.5]).first()["q"] == 5.0


@pytest.fixture
def large(spark):
    """Rows too many to broadcast, three groups and some of none."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    yield spark.range(0, 60_000, 1, 4).selectExpr(
        "element_at(array('a', 'b', 'c', null), cast(id % 4 + 1 as int)) as city",
        "cast(id * 7919 % 60000 as double) as x", "if(id % 11 < 2, null, cast(id % 11 as double)) as y")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_groups_are_not_joined_in_one_task(large):
    """Rows meet the brackets where they are; a join by group would sort a whole group in one task."""
    got = exact_quantiles(large, ["city"], ["x"], [0.5])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    of = lambda k: float(np.median([i * 7919 % 60000 for i in range(k, 60_000, 4)]))
    assert table(got) == {(c, "x", 0.5): of(k) for k, c in enumerate("abc")}


@pytest.fixture
def unsent(spark):
    """A session that broadcasts nothing unless told to."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_groups_are_not_joined_in_one_task_without_a_broadcast_limit(large, unsent):
    test_groups_are_not_joined_in_one_task(large)


@pytest.mark.parametrize("held", [0, 100, 1 << 20])
def test_many_brackets(skewed, monkeypatch, unsent, held):
    """With too many brackets to travel, only those of large groups do; NULL is no group."""
    monkeypatch.setattr(quantiles, "TRAVEL", 2)
    monkeypatch.setattr(quantiles, "HELD", held)
    df, rows = skewed
    df = df.unionByName(df.selectExpr("cast(null as string) as city", "x", "y"))
    got = exact_quantiles(df, ["city"], ["x", "y"], PROBS)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin .*LeftAnti", plan) and re.search(r"SortMergeJoin .*Inner", plan)
    got = table(got)
    want = {}
    for city in ("hot", "small", "one"):
        for i, name in ((1, "x"), (2, "y")):
            values = [r[i] for r in rows if r[0] == city and r[i] is not None]
            want |= {(city, name, p): np.quantile(values, p) for p in PROBS if values}
    assert got == pytest.approx(want)


def test_measures_are_not_joined_in_one_task(large):
    """The same where a measure is the whole group."""
    got = measure_summary(large, PanelSpec(), ["x", "y"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "raise_error" in plan and not re.search(r"SortMergeJoin \[measure#\d+\], \[measure#\d+\], Inner", plan)
    got = {r["measure"]: r for r in got.collect()}
    assert (got["x"]["p25"], got["x"]["p50"], got["x"]["count"]) == (14999.75, 29999.5, 60_000)
    y = [i % 11 for i in range(60_000) if i % 11 >= 2]
    assert [got["y"][c] for c in ("p25", "p50", "p75")] == [float(np.quantile(y, p)) for p in (0.25, 0.5, 0.75)]
    assert got["y"]["missing_pct"] == pytest.approx((60_000 - len(y)) / 600)


def test_measures_are_not_joined_in_one_task_without_a_broadcast_limit(large, unsent):
    test_measures_are_not_joined_in_one_task(large)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60), st.sampled_from([0.0, 0.3, 0.5, 0.95]))
def test_any_values(spark, values, p):
    df = frame(spark, [("g", float(v)) for v in values], "city string, x double")
    got = exact_quantiles(df, ["city"], ["x"], [p], 10_000).first()["q"]
    if len(values) <= 10:
        assert got == pytest.approx(np.quantile(values, p))
    else:  # 1/n exceeds the sketch's slack only above the default group size
        full = exact_quantiles(df, ["city"], ["x"], [p]).first()["q"]
        assert full == pytest.approx(np.quantile(values, p))


def test_spearman_with_ties(spark):
    rng = random.Random(2)
    rows = [(float(rng.randint(0, 9)), None if i % 11 == 0 else float(rng.randint(0, 30) + i % 10))
            for i in range(500)]
    df = frame(spark, rows, "a double, b double")
    pairs = [(x, y) for x, y in rows if y is not None]

    def ranks(v):
        s = np.sort(v)
        return np.array([(np.searchsorted(s, x) + np.searchsorted(s, x, "right") + 1) / 2 for x in v])

    want = np.corrcoef(ranks([x for x, _ in pairs]), ranks([y for _, y in pairs]))[0, 1]
    assert spearman_pairs(df, ["a", "b"]).first()["rho"] == pytest.approx(want)


def test_spearman_of_many_pairs(spark):
    """All pairs in one job, a constant column, a column without values, ranges across tasks."""
    rng = np.random.default_rng(4)
    a = rng.integers(0, 40, 3000).astype(float)
    b = np.where(rng.random(3000) < 0.1, np.nan, a * a + rng.normal(0, 200, 3000))
    rows = [(x, None if np.isnan(y) else float(y), 5.0, None) for x, y in zip(a.tolist(), b)]
    df = frame(spark, rows, "a double, b double, c double, d double").repartition(7)
    got = {(r["a"], r["b"]): r["rho"] for r in spearman_pairs(df, ["a", "b", "c", "d"]).collect()}
    known = ~np.isnan(b)
    rank = lambda v: np.array([(np.searchsorted(s, x) + np.searchsorted(s, x, "right") + 1) / 2 for s in [np.sort(v)] for x in v])
    assert got["a", "b"] == pytest.approx(np.corrcoef(rank(a[known]), rank(b[known]))[0, 1])
    assert len(got) == 6 and got["a", "c"] is None and got["c", "d"] is None


@pytest.mark.parametrize("travel,held", [(1 << 16, 1 << 21), (20, 1 << 21), (20, 1)])
def test_spearman_ranks_a_measure_once(spark, monkeypatch, travel, held):
    """Rows are not repeated for each pair, whether ranks travel to them or are shuffled."""
    monkeypatch.setattr(correlation, "TRAVEL", travel)
    monkeypatch.setattr(correlation, "HELD", held)
    written = []

    def kept(df, label):
        done = materialise(df, label)
        written.append((label, done.count()))
        return done

    monkeypatch.setattr(correlation, "materialise", kept)
    rng = np.random.default_rng(9)
    m = 4000
    a, b, c = rng.integers(0, 10, m) * 1.0, rng.integers(0, 900, m) * 1.0, rng.normal(0, 1, m)
    b += 40 * a
    none = {"a": rng.random(m) < 0.3, "b": np.zeros(m, bool), "c": rng.random(m) < 0.5, "d": a > 4}
    cols = {"a": a, "b": b, "c": c, "d": b % 7 - c}
    rows = [tuple(None if none[k][i] else float(cols[k][i]) for k in cols) for i in range(m)]
    df = frame(spark, rows + rows[:50], ", ".join(f"{k} double" for k in cols)).repartition(5)
    got = {(r["a"], r["b"]): r["rho"] for r in spearman_pairs(df, list(cols)).collect()}
    rank = lambda v: np.array([(np.searchsorted(s, x) + np.searchsorted(s, x, "right") + 1) / 2 for s in [np.sort(v)] for x in v])
    at = np.r_[0:m, 0:50]
    for x, y in combinations(cols, 2):
        both = at[~none[x][at] & ~none[y][at]]
        want = np.corrcoef(rank(cols[x][both]), rank(cols[y][both]))[0, 1]
        assert got[x, y] == pytest.approx(want, abs=1e-12)
    distinct = sum(len({r[i] for r in rows if r[i] is not None}) for i in range(4))
    assert len(got) == 6 and written and max(n for _, n in written) == distinct
