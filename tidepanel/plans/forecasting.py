"""Forecast and validation flows over all entities at once.

The flows read their series several times (sizes, scaling, fit, prediction). Pass a stored
daily series, ``session.materialise`` writes one, rather than a view over raw readings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.functions import scalars as S
from tidepanel.models import registry, segments, trees, trend
from tidepanel.models.trend import TrendModel
from tidepanel.operators import aggregates, evaluation, filters, windows
from tidepanel.operators.joins import over_horizon
from tidepanel.panel import PanelSpec
from tidepanel.plans import dataset
from tidepanel.plans.features import feature_frame, feature_groups
from tidepanel.session import at_once, materialise
from tidepanel.sources.readers import date_spine

# Training cutoff, forecast length, gates of the flows.
TRAIN_CUTOFF = "2023-01-01"
FORECAST_DAYS = 365 * 6
MIN_TEST_ROWS = 30
MIN_SERIES_ROWS = 1000
MIN_TREND_ROWS = 365
MIN_TRAIN_CLEAN = 100
# Training rows that an entity must exceed for a model.
ROW_GATES = {"Boosted Trees": 0, "Random Forest": 500, "Seasonal Trend": MIN_TREND_ROWS}


def forecast_entities(series: DataFrame, spec: PanelSpec, periods: int = FORECAST_DAYS,
                      m: TrendModel = TrendModel(), regressors: DataFrame | None = None) -> DataFrame:
    """Fitted values over each entity's history and ``periods`` days beyond it.

    ``series`` holds (entity, ds, y[, regressors]); ``regressors`` the values of every day.
    """
    spine = date_spine(series, spec.with_(time="ds"), periods)
    if regressors is not None:
        spine = spine.join(regressors, [spec.entity, "ds"], "left")
    return trend.predict(trend.fit(series, spec, m), spine, spec, m)


def future_only(forecast: DataFrame, series: DataFrame, spec: PanelSpec) -> DataFrame:
    """Forecast rows after each entity's last observation."""
    last = series.groupBy(spec.entity).agg(F.max("ds").alias("_last"))
    return forecast.join(last, spec.entity).where(F.col("ds") > F.col("_last")).drop("_last")


def validate_entities(series: DataFrame, spec: PanelSpec, cutoff: str = TRAIN_CUTOFF,
                      m: TrendModel = TrendModel(), name: str = "Seasonal Trend") -> DataFrame:
    """(entity, model, ds, y, yhat, bounds): fit before the cutoff, predict the rest."""
    train = filters.before(series, "ds", cutoff)
    test = filters.since(series, "ds", cutoff)
    out = trend.predict(trend.fit(train, spec, m), test, spec, m)
    return out.select(spec.entity, F.lit(name).alias("model"), "ds", "y",
                      "yhat", "yhat_lower", "yhat_upper")


def _sizes(series: DataFrame, spec: PanelSpec, cutoff: str) -> DataFrame:
    early = F.col("ds") < F.lit(cutoff).cast(series.schema["ds"].dataType)
    return series.groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("days"), F.max("ds").alias("last"),
        F.count_if(early).alias("train_days"), F.count_if(~early).alias("test_days"))


def validation_report(series: DataFrame, spec: PanelSpec, cutoff: str = TRAIN_CUTOFF,
                      m: TrendModel = TrendModel(), min_test: int = MIN_TEST_ROWS) -> DataFrame:
    """Errors, quality and split sizes per entity; short test parts are marked."""
    got = evaluation.evaluate(validate_entities(series, spec, cutoff, m), [spec.entity])
    out = _sizes(series, spec, cutoff).join(got, spec.entity, "left")
    return report_rows(out, spec, min_test)


def report_rows(out: DataFrame, spec: PanelSpec, min_test: int = MIN_TEST_ROWS,
                by: Sequence[str] = ()) -> DataFrame:
    """Report rows of each entity, and of each group of ``by`` such as the model."""
    ok = F.col("test_days") >= min_test
    status = (F.when(~ok, "insufficient_test").when(F.col("mape").isNull(), "invalid_mape")
              .otherwise("ok"))
    shown = lambda c: F.when(ok, F.round(F.col(c), 2)).alias(c)
    quality = F.when(ok & F.col("mape").isNotNull(), S.model_quality("mape")["label"])
    return out.select(spec.entity, *by, status.alias("status"), shown("mape"), shown("rmse"),
                      shown("mae"), quality.alias("quality"), "train_days", "test_days")


def batch_forecast(series: DataFrame, spec: PanelSpec, cutoff: str, recent: str, horizon_year: int,
                   periods: int = FORECAST_DAYS, m: TrendModel = TrendModel(),
                   min_days: int = MIN_SERIES_ROWS, min_test: int = MIN_TEST_ROWS) -> DataFrame:
    """Per entity: status, error, recent mean, horizon-year mean and trend.

    Gates in order: enough days, data since the cutoff, enough test days. Only entities
    that pass all are fitted; the others keep their row with NULL results.
    """
    sizes = _sizes(series, spec, cutoff)
    reached = F.col("last") >= F.lit(cutoff).cast(series.schema["ds"].dataType)
    status = (F.when(F.col("days") < min_days, "insufficient_data")
              .when(~reached, "no_recent_data")
              .when(F.col("test_days") < min_test, "insufficient_test").otherwise("success"))
    graded = sizes.select(spec.entity, "days", status.alias("status"))
    chosen = series.join(graded.where(F.col("status") == "success").select(spec.entity),
                         spec.entity, "left_semi")
    errors = evaluation.evaluate(validate_entities(chosen, spec, cutoff, m), [spec.entity])
    ahead = filters.in_year(forecast_entities(chosen, spec, periods, m), "ds", horizon_year)
    ahead = ahead.groupBy(spec.entity).agg(F.avg("yhat").alias("predicted"))
    now = filters.since(chosen, "ds", recent).groupBy(spec.entity).agg(F.avg("y").alias("recent"))
    out = graded
    for part in (errors, ahead, now):
        out = out.join(part, spec.entity, "left")
    label = F.when(F.col("status") == "success", S.trend_label("predicted", "recent"))
    return out.select(spec.entity, "status", "days", F.round("mape", 2).alias("mape"),
                      F.round("rmse", 2).alias("rmse"), F.round("recent", 1).alias("recent"),
                      F.round("predicted", 1).alias("predicted"), label.alias("trend"))


def forecast_report(series: DataFrame, spec: PanelSpec, forecast: DataFrame, current_year: int,
                    horizon_year: int) -> DataFrame:
    """Per entity: data points, current-year mean, horizon-year mean, trend."""
    points = series.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("data_points"))
    now = (filters.in_year(series, "ds", current_year).groupBy(spec.entity)
           .agg(F.avg("y").alias("current_avg")))
    ahead = (filters.in_year(forecast, "ds", horizon_year).groupBy(spec.entity)
             .agg(F.avg("yhat").alias("predicted")))
    out = points.join(now, spec.entity, "left").join(ahead, spec.entity, "left")
    return out.withColumn("trend", S.trend_label("predicted", "current_avg"))


def report_points(series: DataFrame, spec: PanelSpec, forecast: DataFrame,
                  tail: int = 1000) -> DataFrame:
    """The report's chart rows: the last observations, then the future forecast."""
    from tidepanel.operators.ranking import tail_rows

    seen = tail_rows(series, spec.with_(time="ds"), tail).select(
        spec.entity, F.lit("historical").alias("part"), "ds", F.col("y").alias("yhat"),
        F.col("y").alias("yhat_lower"), F.col("y").alias("yhat_upper"))
    ahead = future_only(forecast, series, spec).select(
        spec.entity, F.lit("forecast").alias("part"), "ds", "yhat", "yhat_lower", "yhat_upper")
    return seen.unionByName(ahead)


def comparison_report(validation: DataFrame, series: DataFrame, spec: PanelSpec,
                      year: int, min_test: int = MIN_TEST_ROWS, by: Sequence[str] = ()) -> DataFrame:
    """Entities (and groups of ``by``, such as the model) by error with a year's mean and a quality
    band; test parts must exceed the gate."""
    errors = evaluation.evaluate(validation, [spec.entity, *by]).where(F.col("n_test") > min_test)
    level = (filters.in_year(series, "ds", year).groupBy(spec.entity)
             .agg(F.avg("y").alias("year_avg")))
    out = errors.join(level, spec.entity, "left")
    return out.select(spec.entity, *by, "mape", "year_avg", S.data_quality_band("mape").alias("data_quality")) \
        .orderBy("mape", spec.entity, *by)


def training_variants(series: DataFrame, spec: PanelSpec, cutoff: str, era: tuple[str, str],
                      m: TrendModel = TrendModel()) -> DataFrame:
    """Errors of models trained on all rows, on rows before an era, and on rows outside it.

    The test part is taken before the training rows are filtered, so all three share it.
    """
    train, test = filters.before(series, "ds", cutoff), filters.since(series, "ds", cutoff)
    keys = [spec.entity, "model"]
    day = lambda text, days=0: F.date_add(F.lit(text).cast("date"), days)
    early, end = F.least(day(cutoff, -1), day(era[0], -1)), day(cutoff, -1)
    span = lambda name, a, b: F.struct(F.lit(name).alias("model"), a.cast("date").alias("from"), b.alias("until"))
    spans = F.explode(F.array(span("Full", F.lit(None), end), span("Before era", F.lit(None), early),
                              span("Skip era", F.lit(None), early), span("Skip era", day(era[1], 1), end))).alias("r")
    ranges = series.select(spec.entity).distinct().select(spec.entity, spans).select(spec.entity, "r.*") \
        .where(F.col("from").isNull() | (F.col("from") <= F.col("until")))
    names = F.explode(F.array(F.lit("Full"), F.lit("Before era"), F.lit("Skip era")))
    wanted = test.withColumn("model", names)
    if m.logistic:
        during = ((F.col("from").isNull() | (F.col("ds") >= F.col("from"))) & (F.col("ds") <= F.col("until")))
        fits = trend.fit(train.join(ranges, spec.entity).where(during).drop("from", "until"), spec, m, keys)
    else:
        fits = segments.fit_ranges(train, ranges, spec, m, ["model"])
    scored = evaluation.evaluate(trend.predict(fits, wanted, spec, m, keys), keys)
    low, high = evaluation.expected_range(F.lit(100.0), "mape")
    pick = scored.groupBy(spec.entity).agg(evaluation.smallest("mape", "model").alias("_best"))
    return scored.join(pick, spec.entity).select(
        *keys, "mape", "rmse", "mae", low.alias("low"), high.alias("high"),
        (F.col("model") == F.col("_best")).alias("selected"))


def cross_validation(series: DataFrame, spec: PanelSpec, initial_days: int = 1825,
                     period_days: int = 365, horizon_days: int = 365,
                     m: TrendModel = TrendModel()) -> DataFrame:
    """(entity, fold, ds, y, yhat, bounds) of every rolling origin, all folds in one job.

    Folds share one pass of sums over the series. A saturating trend cannot, as its response
    depends on the fold; its training rows are repeated per fold.
    """
    origins = dataset.rolling_origins(series, spec.with_(time="ds"), initial_days, period_days,
                                      horizon_days)
    keys = [spec.entity, "fold"]
    rows = series.join(origins, spec.entity)
    test = (rows.where((F.col("ds") > F.col("cutoff")) & (F.col("ds") <= F.col("until")))
            .select(*keys, "ds", "y"))
    if m.logistic:
        fits = trend.fit(rows.where(F.col("ds") <= F.col("cutoff")).select(*keys, "ds", "y"), spec, m, keys)
    else:
        ranges = origins.select(*keys, F.lit(None).cast("date").alias("from"), F.col("cutoff").alias("until"))
        fits = segments.fit_ranges(series, ranges, spec, m, ["fold"])
    return trend.predict(fits, test, spec, m, keys)


def compare_regressors(series: DataFrame, spec: PanelSpec, cutoff: str,
                       sets: Mapping[str, Sequence[str]], m: TrendModel = TrendModel()) -> DataFrame:
    """Error of each regressor set and its gain over the first; ``series`` has the regressors."""
    from dataclasses import replace

    out = None
    for name, regressors in sets.items():
        one = validate_entities(series.dropna(subset=list(regressors) or ["y"]), spec, cutoff,
                                replace(m, regressors=tuple(regressors)), name)
        out = one if out is None else out.unionByName(one)
    scored = evaluation.evaluate(out, [spec.entity, "model"])
    gains = evaluation.improvement(scored, [spec.entity], next(iter(sets)))
    return scored.join(gains.drop("mape"), [spec.entity, "model"])


def evaluate_models(panel: DataFrame, spec: PanelSpec, cutoff: str = "2019-01-01",
                    baselines: bool = True, ml: bool = True, seasonal_trend: bool = True,
                    tree_params: Mapping[str, object] | None = None,
                    forest_params: Mapping[str, object] | None = None,
                    m: TrendModel = TrendModel(),
                    separate: Sequence[str] | None = None,
                    gates: Mapping[str, int] = ROW_GATES) -> DataFrame:
    """Prediction rows (entity, model, ds, y, yhat) of all applicable models.

    Trees are pooled: one model over all entities' leak-free features; ``separate`` names
    entities that get a model of their own instead, several fitted at a time. An entity
    needs more training rows than ``gates`` names for a model to be scored by it; ``status_of``
    says which models that leaves out.
    """
    counts = training_counts(panel, spec, cutoff)
    parts = []
    if baselines:
        parts += [windows.moving_average(panel, spec, cutoff),
                  windows.seasonal_naive(panel, spec, cutoff)]
    if ml:
        frame = training_frame(panel, spec, cutoff)
        kinds = {"gbt": tree_params, "forest": forest_params}
        scopes = [(frame, list(kinds))]
        if separate is not None:
            named = counts.where(F.col(spec.entity).isin(list(separate))).collect()
            scopes = [(frame.where(F.col(spec.entity) == r[spec.entity]),
                       [k for k in kinds if r["n_train"] > gates.get(trees.MODELS[k][2], 0)]) for r in named]

        def predictions(scope: DataFrame, wanted: Sequence[str]) -> list[DataFrame]:
            rows, kept = dataset.prepare(scope, spec, safe_features(scope, spec), cutoff)
            return [_past_gate(p, counts, spec, gates) for p in
                    _tree_predictions(rows, kept, spec, {k: kinds[k] for k in wanted})]

        for found in at_once(panel.sparkSession, [partial(predictions, *s) for s in scopes]):
            parts += found
    if seasonal_trend:
        series = filters.entity_series(panel, spec, use_synthetic=True)
        enough = counts.where(F.col("n_train") > gates.get("Seasonal Trend", 0))
        chosen = series.join(enough.select(spec.entity), spec.entity, "left_semi")
        parts.append(validate_entities(chosen, spec, cutoff, m).select(
            spec.entity, "model", "ds", "y", "yhat"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _tree_predictions(rows: DataFrame, kept: Sequence[str], spec: PanelSpec,
                      kinds: Mapping[str, Mapping[str, object] | None]) -> list[DataFrame]:
    train, test = (rows.where(F.col("split") == part) for part in ("train", "test"))
    return [trees.predict(trees.fit(train, kept, spec.target, kind, params), test, spec, kind)
            for kind, params in kinds.items()]


def cross_entity_evaluation(panel: DataFrame, spec: PanelSpec, cutoff: str = "2019-01-01",
                            **options) -> DataFrame:
    """(entity, model, mape, rmse, mae, n_test, status) of every entity and model. Errors are
    those of entities with at least 200 rows; models without errors keep a row that says why."""
    big = evaluation.large_enough(panel, spec)
    scored = evaluation.evaluate(evaluate_models(big, spec, cutoff, **options), [spec.entity, "model"])
    return status_of(scored, training_counts(panel, spec, cutoff), spec, options.get("gates", ROW_GATES))


def training_counts(panel: DataFrame, spec: PanelSpec, cutoff: str) -> DataFrame:
    """(entity, n_rows, n_train): rows, and rows with a target before the cutoff."""
    early = F.col(spec.time) < F.lit(cutoff).cast(panel.schema[spec.time].dataType)
    return panel.groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(early & F.col(spec.target).isNotNull()).alias("n_train"))


def _past_gate(predictions: DataFrame, counts: DataFrame, spec: PanelSpec,
               gates: Mapping[str, int]) -> DataFrame:
    gate = F.coalesce(*[F.when(F.col("model") == k, F.lit(n)) for k, n in gates.items()], F.lit(0))
    return (predictions.join(counts.select(spec.entity, "n_train"), spec.entity)
            .where(F.col("n_train") > gate).drop("n_train"))


def status_of(scored: DataFrame, counts: DataFrame, spec: PanelSpec,
              gates: Mapping[str, int] = ROW_GATES, min_rows: int = evaluation.MIN_ROWS) -> DataFrame:
    """``scored`` with a status, and a row without errors for every entity and model that was
    left out for want of rows."""
    gated = F.explode(F.array(*[F.struct(F.lit(k).alias("model"), F.lit(n).alias("gate"))
                                for k, n in gates.items()])).alias("g")
    out = counts.select(spec.entity, "n_rows", "n_train", gated).select(
        spec.entity, "g.model", F.when(F.col("n_rows") < min_rows, "insufficient_data")
        .when(F.col("n_train") <= F.col("g.gate"), "insufficient_train").alias("status"))
    return (scored.join(out, [spec.entity, "model"], "full")
            .withColumn("status", F.coalesce("status", F.when(F.col("n_test").isNull(), "no_predictions"), F.lit("ok")))
            .withColumn("n_test", F.coalesce("n_test", F.lit(0))))


def safe_features(frame: DataFrame, spec: PanelSpec) -> list[str]:
    """Numeric features known before the row's own readings: calendar, lags, rolling, z-score.

    Same-row measures and their interactions are left out: they come with the target.
    """
    groups = feature_groups(frame, spec)
    wanted = [c for g in ("temporal", "lags", "rolling", "normalization") for c in groups[g]]
    return [c for c in filters.numeric_features(frame, spec.target) if c in set(wanted)]


def training_frame(panel: DataFrame, spec: PanelSpec, cutoff: str) -> DataFrame:
    """The leak-free feature frame, written once.

    Medians, fits and predictions all read it, and a lost executor costs a re-read, not
    the windows again.
    """
    return materialise(feature_frame(panel, spec, leak_free=True, train_until=cutoff), "features")


def training_rows(panel: DataFrame, spec: PanelSpec, cutoff: str) -> tuple[DataFrame, list[str]]:
    """Prepared rows and feature names for the tree models."""
    frame = training_frame(panel, spec, cutoff)
    return dataset.prepare(frame, spec, safe_features(frame, spec), cutoff)


def train_and_save(spark: SparkSession, panel: DataFrame, spec: PanelSpec, root: str, entity: str,
                   cutoff: str = "2019-01-01", params: Mapping[str, object] | None = None) -> str:
    """``train_all`` of one entity; returns its status."""
    return train_all(spark, panel, spec, root, [entity], cutoff, params)[entity]


def train_all(spark: SparkSession, panel: DataFrame, spec: PanelSpec, root: str, entities: Sequence[str],
              cutoff: str = "2019-01-01", params: Mapping[str, object] | None = None,
              slots: int = 4) -> dict[str, str]:
    """Train boosted trees of each entity and save them; returns the status of each.

    Guards: at least 200 rows, at least 100 clean training rows. Features of all are written
    once, ``slots`` fits run at a time, and the registry gets its rows in one append.
    """
    name = F.col(spec.entity).cast("string")
    named = panel.where(name.isin(list(entities)))
    sizes = {r["entity"]: r["count"] for r in named.groupBy(name.alias("entity")).count().collect()}
    big = [e for e in dict.fromkeys(entities) if sizes.get(e, 0) >= evaluation.MIN_ROWS]
    status = {e: "ok" if e in big else "insufficient_data" for e in entities}
    if not big:
        return status
    frame = training_frame(named.where(name.isin(big)), spec, cutoff)
    features = safe_features(frame, spec)

    def trained(entity: str) -> tuple | None:
        rows, kept = dataset.prepare(frame.where(name == entity), spec, features, cutoff)
        train = rows.where(F.col("split") == "train")
        if train.count() < MIN_TRAIN_CLEAN:
            return None
        model = trees.fit(train, kept, spec.target, "gbt", params)
        return registry.write_model(spark, root, model, entity, spec.target, kept)

    saved = at_once(spark, [partial(trained, e) for e in big], slots)
    registry.add_rows(spark, root, [row for row in saved if row])
    return status | {e: "insufficient_train" for e, row in zip(big, saved) if not row}


def predict_future(model, panel: DataFrame, spec: PanelSpec, days: int = 30,
                   cutoff: str | None = None) -> DataFrame:
    """The next days per entity from its last feature row: constant level, ±15 %, not below 0."""
    frame = feature_frame(panel, spec, leak_free=True, train_until=cutoff)
    features = list(model.stages[0].getInputCols())
    last = windows.last_features(frame, spec, features)
    level = model.transform(over_horizon(last, spec, days))
    y = F.col("yhat")
    return level.select(spec.entity, "ds", F.round(y, 1).alias("prediction"),
                        F.round(F.greatest(y * 0.85, F.lit(0.0)), 1).alias("lower_bound"),
                        F.round(y * 1.15, 1).alias("upper_bound"))


def forecast_service(spark: SparkSession, panel: DataFrame, spec: PanelSpec, root: str,
                     entity: str, horizon_hours: int = 72, cutoff: str = "2019-01-01",
                     params: Mapping[str, object] | None = None) -> DataFrame:
    """Forecast rows of one entity with a status column; trains a model when none is saved."""
    status = "ok"
    model = registry.load_model(spark, root, entity)
    if model is None:
        status = train_and_save(spark, panel, spec, root, entity, cutoff, params)
        model = registry.load_model(spark, root, entity) if status == "ok" else None
    if model is None:
        kind = panel.schema[spec.entity].dataType
        return spark.range(1).select(
            F.lit(entity).cast(kind).alias(spec.entity), F.lit(None).cast("date").alias("ds"),
            *[F.lit(None).cast("double").alias(c)
              for c in ("prediction", "lower_bound", "upper_bound")],
            F.lit(status).alias("status"), F.lit(None).cast("string").alias("alert"))
    one = panel.where(F.col(spec.entity) == entity)
    out = predict_future(model, one, spec, S.horizon_to_days(horizon_hours), cutoff)
    return out.withColumns({"status": F.lit(status), "alert": S.aqi_alert("prediction")})


def expected_horizon_range(forecast: DataFrame, errors: DataFrame, spec: PanelSpec,
                           year: int) -> DataFrame:
    """Mean forecast of a year, its mean bounds, and the level ± its percentage error."""
    level = filters.in_year(forecast, "ds", year).groupBy(spec.entity).agg(
        F.avg("yhat").alias("level"), F.avg("yhat_lower").alias("lower"),
        F.avg("yhat_upper").alias("upper"))
    low, high = evaluation.expected_range("level", "mape")
    return level.join(errors, spec.entity).select(
        spec.entity, "level", "lower", "upper", low.alias("expected_low"),
        high.alias("expected_high"))


def summary_of(batch: DataFrame, spec: PanelSpec) -> DataFrame:
    """Batch summary over the entities that succeeded."""
    return aggregates.batch_summary(batch.where(F.col("status") == "success"), spec)
