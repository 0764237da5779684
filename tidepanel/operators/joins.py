"""Joins of panels, predictions and dimensions, always on the entity too.

No broadcast hints: sizes are measured at run time, so Spark broadcasts a small side
and otherwise sorts and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.panel import PanelSpec


def actual_predicted(actual: DataFrame, predicted: DataFrame, spec: PanelSpec,
                     how: str = "inner", on: Sequence[str] | None = None) -> DataFrame:
    """Actual rows with their prediction; ``left`` keeps rows without one."""
    return actual.join(predicted, list(on or [spec.entity, "ds"]), how)


def within_dates(forecast: DataFrame, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Forecast rows whose key occurs among the wanted rows."""
    return forecast.join(wanted.select(*on), list(on), "left_semi")


def with_regressors(series: DataFrame, regressors: DataFrame, on: Sequence[str],
                    how: str = "inner") -> DataFrame:
    """Series or future dates with regressor columns."""
    return series.join(regressors, list(on), how)


def with_dimension(readings: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Readings with their dimension row; unknown keys keep NULL columns."""
    return readings.join(dimension, key, "left")


def unmatched(readings: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys, and how many of them the dimension lacks."""
    keys = readings.where(F.col(key).isNotNull()).select(key).distinct()
    known = dimension.select(key).distinct().withColumn("_known", F.lit(1))
    return keys.join(known, key, "left").agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(F.col("_known").isNull()).alias("missing"))


def over_horizon(last: DataFrame, spec: PanelSpec, days: int) -> DataFrame:
    """Each entity's last row repeated for the next 1..days days."""
    step = F.explode(F.sequence(F.lit(1), F.lit(days)))
    return (last.withColumn("step", step)
            .withColumn("ds", F.date_add(F.to_date(spec.time), F.col("step"))))
