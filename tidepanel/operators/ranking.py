"""Sort, limit and top-k. ``row_number() <= n`` filters are pruned before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.operators import filters
from tidepanel.panel import PanelSpec


def top_entities(df: DataFrame, spec: PanelSpec, n: int = 10,
                 metric: str | None = None) -> DataFrame:
    """The n entities with the highest mean."""
    out = df.groupBy(spec.entity).agg(F.avg(metric or spec.target).alias("mean"))
    return out.orderBy(F.col("mean").desc_nulls_last(), spec.entity).limit(n)


def worst_best(df: DataFrame, spec: PanelSpec, year: int | None = None) -> DataFrame:
    """One row: entities with the highest and lowest mean; ties go to the first name."""
    if year is not None:
        df = filters.in_year(df, spec.time, year)
    means = (df.groupBy(spec.entity).agg(F.avg(spec.target).alias("m"))
             .where(F.col("m").isNotNull()))
    worst = F.min(F.struct((-F.col("m")).alias("k"), F.col(spec.entity)))
    best = F.min(F.struct(F.col("m").alias("k"), F.col(spec.entity)))
    t = spec.target
    return means.agg(worst[spec.entity].alias("worst"), best[spec.entity].alias("best"),
                     F.max("m").alias(f"worst_{t}"), F.min("m").alias(f"best_{t}"))


def tail_rows(df: DataFrame, spec: PanelSpec, n: int) -> DataFrame:
    """The last n readings of each entity."""
    w = Window.partitionBy(spec.entity).orderBy(
        F.col(spec.time).desc(), *[F.col(c).desc() for c in spec.tie_break])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def head_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows in an explicit order."""
    return df.orderBy(*order).limit(n)


def sorted_by(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order)


def model_rankings(metrics: DataFrame, spec: PanelSpec, metric: str = "rmse") -> DataFrame:
    """Models of each entity by a metric, smallest first; models without it are left out."""
    w = Window.partitionBy(spec.entity).orderBy(metric, "model")
    got = metrics.where(F.col(metric).isNotNull())
    return got.select(spec.entity, "model", metric, F.row_number().over(w).alias("place"))


def best_model(metrics: DataFrame, spec: PanelSpec, metric: str = "rmse") -> DataFrame:
    """The model with the smallest metric per entity; ties go to the first name."""
    pick = F.min(F.struct(F.col(metric), F.col("model")))
    got = metrics.where(F.col(metric).isNotNull()).groupBy(spec.entity).agg(pick.alias("b"))
    return got.select(spec.entity, F.col("b.model").alias("best_model"),
                      F.col(f"b.{metric}").alias(metric))
