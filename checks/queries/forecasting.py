"""Fitted models and the reports on them. Rows only: the tests check values."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import fixed, query
from checks.sqltext import r
from checks.tables import CUTOFF, PANEL, SERIES
from tidepanel.models import registry, trees, trend
from tidepanel.models.trend import TrendModel
from tidepanel.operators import evaluation as E
from tidepanel.operators import filters as FL
from tidepanel.plans import forecasting as FC
from tidepanel.session import materialise, shared_dir

# Few trees keep the check short; the library's defaults are for real runs.
QUICK_GBT = {"maxIter": 10, "maxDepth": 4}
QUICK_FOREST = {"numTrees": 20, "maxDepth": 6}
HORIZON = FC.FORECAST_DAYS


def _prepared(t):
    return FC.training_rows(t.daily, PANEL, CUTOFF)


@query("model_gbt")
def _(t):
    rows, kept = _prepared(t)
    model = trees.fit(rows.where("split = 'train'"), kept, "aqi", "gbt", QUICK_GBT)
    return E.evaluate(trees.predict(model, rows.where("split = 'test'"), PANEL), ["city", "model"])


@query("model_rf")
def _(t):
    rows, kept = _prepared(t)
    model = trees.fit(rows.where("split = 'train'"), kept, "aqi", "forest", QUICK_FOREST)
    return E.evaluate(trees.predict(model, rows.where("split = 'test'"), PANEL, "forest"),
                      ["city", "model"])


@query("feature_importance_top20")
def _(t):
    rows, kept = _prepared(t)
    model = trees.fit(rows.where("split = 'train'"), kept, "aqi", "gbt", QUICK_GBT)
    return trees.importances(t.spark, model)


@query("model_trend_seasonal")
def _(t):
    fits = trend.fit(FL.before(t.stored_series, "ds", CUTOFF), SERIES)
    rows = trend.predict(fits, FL.since(t.stored_series, "ds", CUTOFF), SERIES)
    return E.evaluate(rows, ["city"])


@query("model_trend_logistic")
def _(t):
    m = TrendModel(floor=20.0, cap=500.0)
    fits = trend.fit(FL.before(t.stored_series, "ds", CUTOFF), SERIES, m)
    return trend.predict(fits, FL.since(t.stored_series, "ds", CUTOFF), SERIES, m)


def _with_weather(t):
    weather = t.daily.groupBy(F.col("date").alias("ds")).agg(
        F.avg("no2").alias("temp"), F.avg("co").alias("humidity"), F.avg("so2").alias("wind_speed"))
    return materialise(t.series.join(weather, "ds"), "weather")


REGRESSORS = ("temp", "humidity", "wind_speed")


@query("model_with_regressors")
def _(t):
    return FC.validate_entities(_with_weather(t), SERIES, CUTOFF, TrendModel(regressors=REGRESSORS))


@query("regressor_compare")
def _(t):
    sets = {"Baseline": (), "Weather": REGRESSORS, "Temperature": ("temp",)}
    return FC.compare_regressors(_with_weather(t), SERIES, CUTOFF, sets)


@query("regressor_effects")
def _(t):
    m = TrendModel(regressors=REGRESSORS)
    return trend.regressor_effects(trend.fit(_with_weather(t), SERIES, m), SERIES, m)


_MOMENTS = """
SELECT covar_pop(aqi, no2) AS ya, covar_pop(aqi, pm2_5) AS yb, var_pop(no2) AS va, var_pop(pm2_5) AS vb,
       covar_pop(no2, pm2_5) AS ab FROM lines WHERE no2 IS NOT NULL"""


@query("linear_effects", f"""
SELECT regressor, {r('coef')} AS coef, CASE WHEN coef > 0 THEN 'increases' ELSE 'decreases' END AS direction
FROM (SELECT 'no2' AS regressor, (ya * vb - yb * ab) / (va * vb - ab * ab) AS coef FROM ({_MOMENTS})
      UNION ALL SELECT 'pm2_5', (yb * va - ya * ab) / (va * vb - ab * ab) FROM ({_MOMENTS}))""")
def _(t):
    return fixed(trees.linear_effects(t.lines, ["no2", "pm2_5"], "aqi"))


@query("forecast_entity")
def _(t):
    return FC.forecast_entities(t.stored_series, SERIES, HORIZON)


@query("validate_entity")
def _(t):
    return FC.validate_entities(t.stored_series, SERIES, CUTOFF)


@query("forecast_batch")
def _(t):
    return FC.batch_forecast(t.stored_series, SERIES, CUTOFF, "2001-01-01", 2002, HORIZON)


@query("forecast_batch_summary")
def _(t):
    return FC.summary_of(FC.batch_forecast(t.stored_series, SERIES, CUTOFF, "2001-01-01", 2002, HORIZON),
                         SERIES)


@query("forecast_report")
def _(t):
    ahead = FC.forecast_entities(t.stored_series, SERIES, HORIZON)
    return FC.forecast_report(t.stored_series, SERIES, ahead, 2000, 2002)


@query("forecast_report_points")
def _(t):
    ahead = FC.forecast_entities(t.stored_series, SERIES, HORIZON)
    return FC.report_points(t.stored_series, SERIES, ahead, 1000)


@query("validation_report")
def _(t):
    return FC.validation_report(t.stored_series, SERIES, CUTOFF)


@query("cross_validation")
def _(t):
    folds = FC.cross_validation(t.stored_series, SERIES, initial_days=1095)
    return E.fold_scores(folds, ["city"])


@query("training_variants")
def _(t):
    return FC.training_variants(t.stored_series, SERIES, CUTOFF, ("1998-03-01", "1999-06-30"))


@query("expected_horizon_range")
def _(t):
    errors = E.evaluate(FC.validate_entities(t.stored_series, SERIES, CUTOFF), ["city"])
    ahead = FC.forecast_entities(t.stored_series, SERIES, HORIZON)
    return FC.expected_horizon_range(ahead, errors.select("city", "mape"), SERIES, 2002)


@query("evaluate_models")
def _(t):
    panel = t.daily.withColumn("is_synthetic", F.lit(False))
    return FC.cross_entity_evaluation(panel, PANEL, CUTOFF, tree_params=QUICK_GBT,
                                      forest_params=QUICK_FOREST)


@query("forecast_naive_future")
def _(t):
    rows, kept = _prepared(t)
    model = trees.fit(rows.where("split = 'train'"), kept, "aqi", "gbt", QUICK_GBT)
    return FC.predict_future(model, t.daily, PANEL, 30, CUTOFF)


@query("forecast_service")
def _(t):
    root = shared_dir(t.spark, "service")
    return FC.forecast_service(t.spark, t.daily, PANEL, root, "A", 72, CUTOFF, QUICK_GBT)


@query("model_registry")
def _(t):
    root = shared_dir(t.spark, "registry")
    FC.train_all(t.spark, t.daily, PANEL, root, ["A", "N"], CUTOFF, QUICK_GBT)
    return registry.trained_models(t.spark, root).select(
        "entity", "model_type", "target", "size_kb", "trained_at")


@query("sink_model")
def _(t):
    """A saved and reloaded model predicts the test rows as the fitted one does."""
    rows, kept = _prepared(t)
    root = shared_dir(t.spark, "models")
    model = trees.fit(rows.where("split = 'train'"), kept, "aqi", "gbt", QUICK_GBT)
    registry.save_model(t.spark, root, model, "all places", "aqi", kept)
    back = registry.load_model(t.spark, root, "all places")
    test = rows.where("split = 'test'")
    again = trees.predict(back, test, PANEL).withColumnRenamed("yhat", "again")
    both = trees.predict(model, test, PANEL).join(again.select("city", "ds", "again"), ["city", "ds"])
    return both.groupBy("city").agg(F.count("*").alias("n"),
                                    F.max(F.abs(F.col("yhat") - F.col("again"))).alias("difference"))


@query("bucket_classes")
def _(t):
    """Six-level classification of the next reading's level from leak-free features."""
    from tidepanel.functions.scalars import aqi_bucket_rank

    rows, kept = _prepared(t)
    rows = rows.withColumn("label", aqi_bucket_rank("aqi").cast("double"))
    model = trees.fit_classes(rows.where("split = 'train'"), kept, "label",
                              {"numTrees": 20, "maxDepth": 6})
    out = model.transform(rows.where("split = 'test'"))
    return out.groupBy("city", "label", "level").agg(F.count("*").alias("n"))


@query("typology")
def _(t):
    """Stations grouped by their mean reading of each measure."""
    columns = ["pm2_5", "no2", "co", "aqi"]
    profiles = t.lines.groupBy("station_id").agg(*[F.avg(c).alias(c) for c in columns]).dropna()
    return trees.typology(profiles, "station_id", columns)
