"""Training data: panel selection, time splits, sparse-feature drop, median fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.quantiles import approx_quantiles, exact_quantiles
from tidepanel.operators import filters
from tidepanel.panel import PanelSpec
from tidepanel.plans.features import feature_frame


def ml_dataset(df: DataFrame, spec: PanelSpec, entities: Sequence[str] | None = None,
               use_synthetic: bool = False, **features) -> DataFrame:
    """Feature rows of some or all entities by one query."""
    return feature_frame(filters.entity_measures(df, spec, entities, use_synthetic), spec,
                         **features)


def with_split(df: DataFrame, spec: PanelSpec, cutoff: str = "2019-01-01") -> DataFrame:
    """Mark rows 'train' before the cutoff and 'test' from it on."""
    early = F.col(spec.time) < F.lit(cutoff).cast(df.schema[spec.time].dataType)
    return df.withColumn("split", F.when(early, "train").otherwise("test"))


def expanding_folds(df: DataFrame, spec: PanelSpec, min_train_days: int = 365,
                    step_days: int = 180, test_days: int = 90, min_test_rows: int = 10) -> DataFrame:
    """(entity, fold, train_end, test_end, train_rows, test_rows) of expanding windows.

    Row counts are differences of running counts per day, taken at a fold's bounds, so
    neither rows nor days are repeated per fold. Folds with few test rows are left out.
    """
    day = F.to_date(spec.time)
    days = df.groupBy(spec.entity, day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    ends = days.groupBy(spec.entity).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    room = F.datediff("last", "first") - F.lit(min_train_days + test_days)
    folds = (
        ends.where(room >= 0)
        .select(spec.entity, "first",
                F.explode(F.sequence(F.lit(0), F.floor(room / step_days).cast("int"))).alias("fold"))
        .withColumn("train_end", F.date_add("first", F.lit(min_train_days) + F.col("fold") * step_days))
        .withColumn("test_end", F.date_add("train_end", test_days))
    )
    # Bounds join the days as rows without readings; a running count then knows each bound.
    bound = lambda c: folds.select(spec.entity, F.col(c).alias("day"), "fold", F.lit(c).alias("of"))
    points = days.withColumns({"fold": F.lit(None).cast("int"), "of": F.lit(None).cast("string")}) \
        .unionByName(bound("train_end").unionByName(bound("test_end")).withColumn("n", F.lit(0).cast("bigint")))
    before = Window.partitionBy(spec.entity).orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = Window.partitionBy(spec.entity, "day")
    so_far = F.sum("n").over(before) - F.sum("n").over(own)
    upto = points.withColumn("upto", so_far).where("fold is not null").groupBy(spec.entity, "fold").agg(
        F.max(F.when(F.col("of") == "train_end", F.col("upto"))).alias("train_rows"),
        F.max(F.when(F.col("of") == "test_end", F.col("upto"))).alias("test_upto"))
    counted = folds.join(upto, [spec.entity, "fold"]).select(
        spec.entity, "fold", "train_end", "test_end", "train_rows",
        (F.col("test_upto") - F.col("train_rows")).alias("test_rows"))
    return counted.where(F.col("test_rows") >= min_test_rows)


def fold_rows(df: DataFrame, spec: PanelSpec, folds: DataFrame) -> DataFrame:
    """Rows of each fold with role 'train' or 'test'; pass one fold at a time for large data."""
    bounds = folds.select(spec.entity, "fold", "train_end", "test_end")
    day = F.to_date(spec.time)
    rows = df.join(bounds, spec.entity).where(day < F.col("test_end"))
    role = F.when(day < F.col("train_end"), "train").otherwise("test")
    return rows.withColumn("role", role).drop("train_end", "test_end")


def entity_folds(df: DataFrame, spec: PanelSpec, folds: int = 5) -> DataFrame:
    """Add a fold number, by the entity's digest, that keeps each entity whole."""
    digest = F.substring(F.md5(F.col(spec.entity).cast("string")), 1, 8)
    return df.withColumn("fold", F.conv(digest, 16, 10).cast("bigint") % folds)


def rolling_origins(df: DataFrame, spec: PanelSpec, initial_days: int = 1825,
                    period_days: int = 365, horizon_days: int = 365) -> DataFrame:
    """(entity, fold, cutoff, until): cutoffs walking back from the last day less the
    horizon, while the first day leaves ``initial_days`` of training."""
    ends = df.groupBy(spec.entity).agg(F.min(F.to_date(spec.time)).alias("a"),
                                       F.max(F.to_date(spec.time)).alias("b"))
    room = F.datediff("b", "a") - F.lit(horizon_days + initial_days)
    at = F.explode(F.sequence(F.lit(0), F.floor(room / period_days).cast("int"))).alias("fold")
    out = ends.where(room >= 0).select(spec.entity, "b", at)
    cutoff = F.date_sub("b", F.lit(horizon_days) + F.col("fold") * period_days)
    return out.select(spec.entity, "fold", cutoff.alias("cutoff"),
                      F.date_add(cutoff, horizon_days).alias("until"))


def feature_stats(train: DataFrame, features: Sequence[str], target: str,
                  by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """(by..., measure, null_frac, median) over training rows with a target."""
    known = train.where(F.col(target).isNotNull())
    rows = known.groupBy(*by).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c)
                                    for c in features])
    fracs = rows.unpivot(list(by), list(features), "measure", "null_frac")
    quantiles = exact_quantiles if exact else approx_quantiles
    medians = quantiles(known, list(by), list(features), [0.5]).drop("prob")
    return (fracs.join(medians, [*by, "measure"], "left")
            .withColumnRenamed("q", "median"))


def kept_features(stats: DataFrame, max_null: float = 0.8) -> DataFrame:
    """Features whose training null share does not exceed the limit."""
    return stats.where(F.col("null_frac") <= max_null)


def prepare(df: DataFrame, spec: PanelSpec, features: Sequence[str], cutoff: str,
            max_null: float = 0.8, exact: bool = True) -> tuple[DataFrame, list[str]]:
    """Rows with a target, a split mark and no NULL among the kept features.

    The null shares and medians come from the training part over all entities. The kept
    list is a handful of names, the only values that reach the driver.
    """
    marked = with_split(df.where(F.col(spec.target).isNotNull()), spec, cutoff)
    train = marked.where(F.col("split") == "train")
    stats = feature_stats(train, features, spec.target, exact=exact)
    stats = kept_features(stats, max_null)
    medians = {r["measure"]: r["median"] for r in stats.collect()}
    kept = [c for c in features if c in medians]
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in kept}
    dropped = [c for c in features if c not in medians]
    return marked.withColumns(filled).drop(*dropped), kept


def impute_by_entity(df: DataFrame, spec: PanelSpec, features: Sequence[str], cutoff: str,
                     max_null: float = 0.8, exact: bool = True) -> DataFrame:
    """Per-entity form of ``prepare`` for per-entity models: a feature an entity's training
    rows lack too often is NULL for that entity, the others are filled by its median."""
    marked = with_split(df.where(F.col(spec.target).isNotNull()), spec, cutoff)
    train = marked.where(F.col("split") == "train")
    stats = kept_features(
        feature_stats(train, features, spec.target, [spec.entity], exact), max_null)
    wide = stats.groupBy(spec.entity).pivot("measure", list(features)).agg(F.first("median"))
    wide = wide.withColumnsRenamed({c: f"_m_{c}" for c in features})
    out = marked.join(wide, spec.entity, "left")
    fill = {c: F.when(F.col(f"_m_{c}").isNotNull(),
                      F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}"))) for c in features}
    return out.withColumns(fill).drop(*[f"_m_{c}" for c in features])
