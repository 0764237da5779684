import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, frame
from tidepanel.models import registry, trees
from tidepanel.operators.evaluation import evaluate
from tidepanel.panel import PanelSpec
from tidepanel.plans import forecasting as FC
from tidepanel.session import at_once

SPEC = PanelSpec()
QUICK = {"maxIter": 5, "maxDepth": 3}
CUTOFF = str(day(500))


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(9)
    rows = []
    for city, base in (("New Delhi_1", 150), ("b", 60)):
        for i in range(650):
            y = base + 40 * math.sin(i / 20) + rng.gauss(0, 3)
            rows.append((city, day(i), y, y / 2 + rng.gauss(0, 2), False))
    rows += [("tiny", day(i), 1.0, 1.0, False) for i in range(20)]
    return frame(spark, rows, "city string, date date, aqi double, pm2_5 double, is_synthetic boolean").cache()


def test_fit_finds_the_driving_feature(spark):
    rng = random.Random(0)
    rows = [("a", day(i), *(xs := [rng.random() for _ in range(4)]), 0.8 * xs[1] * 100 + 50 + rng.gauss(0, 1))
            for i in range(500)]
    df = frame(spark, rows, "city string, date date, x1 double, x2 double, x3 double, x4 double, aqi double")
    names = ["x1", "x2", "x3", "x4"]
    for kind, params in (("gbt", QUICK), ("forest", {"numTrees": 10, "maxDepth": 5})):
        model = trees.fit(df, names, "aqi", kind, params)
        top = trees.importances(spark, model).first()
        assert top["feature"] == "x2"
        got = evaluate(trees.predict(model, df, SPEC, kind), ["model"]).first()
        assert got["mape"] < 15 and got["n_test"] == 500


def test_features_leave_the_target_out(panel):
    rows, kept = FC.training_rows(panel, SPEC, CUTOFF)
    assert "aqi" not in kept and "pm2_5" not in kept and "aqi_lag1" in kept and "month" in kept
    assert rows.select(*kept).dropna().count() == rows.count()


def test_evaluate_models(panel):
    big = panel.where("city <> 'tiny'")
    gates = FC.ROW_GATES | {"Random Forest": 499}
    rows = FC.evaluate_models(big, SPEC, CUTOFF, tree_params=QUICK, forest_params={"numTrees": 8, "maxDepth": 5},
                              gates=gates)
    got = {(r["city"], r["model"]): r for r in evaluate(rows, ["city", "model"]).collect()}
    names = {m for _, m in got}
    assert names == {"Moving Average", "Seasonal Naive", "Boosted Trees", "Random Forest", "Seasonal Trend"}
    assert all(got["b", m]["n_test"] == 150 for m in names)
    assert got["b", "Boosted Trees"]["mape"] < 25
    own = FC.evaluate_models(big, SPEC, CUTOFF, baselines=False, seasonal_trend=False, tree_params=QUICK,
                             separate=["b"])
    # One entity has 500 training rows, which is not more than the forest's gate.
    assert {(r["city"], r["model"]) for r in own.select("city", "model").distinct().collect()} \
        == {("b", "Boosted Trees")}
    scored = FC.cross_entity_evaluation(panel, SPEC, CUTOFF, tree_params=QUICK, seasonal_trend=False,
                                        forest_params={"numTrees": 2, "maxDepth": 2})
    status = {(r["city"], r["model"]): (r["status"], r["n_test"]) for r in scored.collect()}
    assert status["b", "Random Forest"] == ("insufficient_train", 0)
    assert status["tiny", "Boosted Trees"] == ("insufficient_data", 0)
    assert status["b", "Boosted Trees"] == ("ok", 150) and status["b", "Seasonal Trend"] == ("no_predictions", 0)
    only = FC.evaluate_models(big, SPEC, CUTOFF, ml=False, seasonal_trend=False)
    assert only.select("model").distinct().count() == 2


def test_registry_round_trip(spark, panel, work):
    assert registry.trained_models(spark, work) is None
    assert registry.load_model(spark, work, "b") is None
    for _ in range(2):
        assert FC.train_and_save(spark, panel, SPEC, work, "New Delhi_1", CUTOFF, QUICK) == "ok"
    assert FC.train_and_save(spark, panel, SPEC, work, "tiny", CUTOFF, QUICK) == "insufficient_data"
    assert FC.train_and_save(spark, panel, SPEC, work, "b", str(day(50)), QUICK) == "insufficient_train"
    got = registry.trained_models(spark, work).collect()
    assert len(got) == 1 and got[0]["entity"] == "New Delhi_1" and got[0]["size_kb"] > 0
    model = registry.load_model(spark, work, "New Delhi_1")
    ahead = FC.predict_future(model, panel.where("city = 'New Delhi_1'"), SPEC, 5, CUTOFF).orderBy("ds").collect()
    assert [r["ds"] for r in ahead] == [day(650 + i) for i in range(5)]
    first = ahead[0]
    assert len({r["prediction"] for r in ahead}) == 1
    assert first["lower_bound"] == pytest.approx(first["prediction"] * 0.85, abs=0.1)
    assert first["upper_bound"] == pytest.approx(first["prediction"] * 1.15, abs=0.1)


def test_fits_at_once_equal_fits_one_by_one(spark, panel, work):
    whole = QUICK | {"subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
    names = ["New Delhi_1", "b", "tiny", "nowhere"]
    assert FC.train_all(spark, panel, SPEC, f"{work}/all", names, CUTOFF, whole) == {
        "New Delhi_1": "ok", "b": "ok", "tiny": "insufficient_data", "nowhere": "insufficient_data"}
    assert FC.train_all(spark, panel, SPEC, f"{work}/none", names[:3], str(day(50)), whole)["b"] == "insufficient_train"
    assert registry.trained_models(spark, f"{work}/none") is None
    listed = {r["entity"]: r["features"] for r in registry.trained_models(spark, f"{work}/all").collect()}
    assert set(listed) == {"New Delhi_1", "b"}
    for i, name in enumerate(listed):
        assert FC.train_and_save(spark, panel, SPEC, f"{work}/{i}", name, CUTOFF, whole) == "ok"
        one, both = (FC.predict_future(registry.load_model(spark, f"{work}/{root}", name),
                                       panel.where(F.col("city") == name), SPEC, 1, CUTOFF).first()["prediction"]
                     for root in (i, "all"))
        assert one == pytest.approx(both, abs=0.2)


def test_at_once_keeps_the_order_and_raises(spark):
    jobs = [lambda i=i: spark.range(i).count() for i in range(9)]
    assert at_once(spark, jobs, slots=3) == list(range(9))
    assert at_once(spark, []) == []
    with pytest.raises(ZeroDivisionError):
        at_once(spark, [lambda: 1, lambda: 1 / 0])


def test_service(spark, panel, work):
    got = FC.forecast_service(spark, panel, SPEC, work, "New Delhi_1", 48, CUTOFF, QUICK).collect()
    assert len(got) == 3 and {r["status"] for r in got} == {"ok"}
    bad = FC.forecast_service(spark, panel, SPEC, work, "nowhere", 48, CUTOFF, QUICK).collect()
    assert len(bad) == 1 and bad[0]["status"] == "insufficient_data" and bad[0]["ds"] is None


def test_classes(spark):
    rows = [(float(i % 6), float(i % 6 + 1)) for i in range(300)]
    df = frame(spark, rows, "x double, label double")
    model = trees.fit_classes(df, ["x"], "label", {"numTrees": 5})
    assert model.transform(df).where(F.col("level") != F.col("label")).count() == 0


def test_typology_separates_profiles(spark):
    rng = random.Random(3)
    rows = [(f"e{i}", (i % 2) * 50 + rng.random(), (i % 2) * -9 + rng.random(), rng.random()) for i in range(40)]
    df = frame(spark, rows, "city string, a double, b double, c double")
    got = trees.typology(df, "city", ["a", "b", "c"], groups=2).collect()
    by_parity = {p: {r["group"] for r in got if int(r["city"][1:]) % 2 == p} for p in (0, 1)}
    assert by_parity[0].isdisjoint(by_parity[1])
