"""Forecast error measures over long prediction rows (entity, model, ds, y, yhat).

All models and entities are scored by one aggregate. Pairs with a NULL are skipped; a
zero actual is left out of the percentage error, which would be infinite.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import scalars as S
from tidepanel.panel import PanelSpec

# Error bands as (upper limit, label).
ERROR_BANDS = ((50, "Good (0-50)"), (100, "Satisfactory (51-100)"), (200, "Moderate (101-200)"),
               (300, "Poor (201-300)"), (None, "Very Poor (300+)"))
# Fixed value: entities with fewer rows are not evaluated.
MIN_ROWS = 200


def mape(y: Column | str = "y", p: Column | str = "yhat") -> Column:
    y, p = S._col(y), S._col(p)
    return F.avg(F.abs((y - p) / F.nullif(y, F.lit(0.0)))) * 100


def rmse(y: Column | str = "y", p: Column | str = "yhat") -> Column:
    d = S._col(y) - S._col(p)
    return F.sqrt(F.avg(d * d))


def mae(y: Column | str = "y", p: Column | str = "yhat") -> Column:
    return F.avg(F.abs(S._col(y) - S._col(p)))


def smallest(metric: Column | str, name: str) -> Column:
    """Aggregate: the name with the smallest known metric; ties go to the first name."""
    m = S._col(metric)
    return F.min(F.when(m.isNotNull(), F.struct(m.alias("m"), F.col(name).alias("name"))))["name"]


def scores() -> list[Column]:
    return [mape().alias("mape"), rmse().alias("rmse"), mae().alias("mae")]


def evaluate(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """mape, rmse and mae per group; n_test counts all predictions, known or not."""
    return predictions.groupBy(*by).agg(*scores(), F.count(F.lit(1)).alias("n_test"))


def large_enough(df: DataFrame, spec: PanelSpec, rows: int = MIN_ROWS) -> DataFrame:
    """Rows of entities with at least ``rows`` rows."""
    keep = (df.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= rows).select(spec.entity))
    return df.join(keep, spec.entity, "left_semi")


def _relative(frame: DataFrame) -> DataFrame:
    known = frame.where(F.col("y").isNotNull() & F.col("yhat").isNotNull())
    err = F.col("y") - F.col("yhat")
    ape = F.abs(err) / F.nullif(F.col("y") + 1, F.lit(0.0)) * 100
    return known.withColumns({"err": err, "ape": ape})


def _breakdown(frame: DataFrame, by: Sequence[str]) -> DataFrame:
    return frame.groupBy(*by).agg(F.count(F.lit(1)).alias("count"), F.avg("ape").alias("mape"),
                                  F.avg("err").alias("bias"))


def error_by_band(predictions: DataFrame, by: Sequence[str], bands=ERROR_BANDS) -> DataFrame:
    """Count, error relative to (actual + 1) and bias per band of the actual value."""
    rows = _relative(predictions).withColumn("band", S.banded("y", bands))
    return _breakdown(rows, [*by, "band"])


def error_by_season(predictions: DataFrame, by: Sequence[str],
                    calendar=S.ERROR_SEASONS) -> DataFrame:
    """The same per season."""
    rows = _relative(predictions).withColumn("season", S.season("ds", calendar))
    return _breakdown(rows, [*by, "season"])


def error_overall(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Overall error and bias, and the dates of the worst and best prediction."""
    day = F.to_date("ds")
    at = lambda k: F.min(F.when(F.col("ape").isNotNull(), F.struct(k.alias("k"), day.alias("d"))))
    worst, best = at(-F.col("ape")), at(F.col("ape"))
    return _relative(predictions).groupBy(*by).agg(
        F.avg("ape").alias("overall_mape"), F.avg("err").alias("overall_bias"),
        worst["d"].alias("worst_ds"), best["d"].alias("best_ds"))


def fold_scores(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and spread over folds of mape and rmse, and the share of actuals within bounds."""
    inside = (F.col("y") >= F.col("yhat_lower")) & (F.col("y") <= F.col("yhat_upper"))
    folds = predictions.groupBy(*by, "fold").agg(
        *scores(), F.avg(inside.cast("double")).alias("coverage"))
    return folds.groupBy(*by).agg(
        F.count(F.lit(1)).alias("folds"), F.avg("mape").alias("mape"),
        F.stddev_samp("mape").alias("mape_std"), F.avg("rmse").alias("rmse"),
        F.stddev_samp("rmse").alias("rmse_std"), F.avg("coverage").alias("coverage"))


def improvement(metrics: DataFrame, by: Sequence[str], base: str,
                metric: str = "mape") -> DataFrame:
    """Each model's gain over the base model in percent, and whether it is the best."""
    stats = metrics.groupBy(*by).agg(
        F.max(F.when(F.col("model") == base, F.col(metric))).alias("_base"),
        smallest(metric, "model").alias("_best"))
    gain = (F.col("_base") - F.col(metric)) / F.nullif(F.col("_base"), F.lit(0.0)) * 100
    return metrics.join(stats, list(by)).select(
        *by, "model", metric, gain.alias("gain_pct"),
        (F.col("model") == F.col("_best")).alias("selected"))


def expected_range(level: Column | str, error: Column | str) -> tuple[Column, Column]:
    """A level less and plus a percentage error."""
    v, e = S._col(level), S._col(error)
    return v * (1 - e / 100), v * (1 + e / 100)


def error_band(df: DataFrame, low: float = 0.8, high: float = 1.2) -> DataFrame:
    """A fixed relative band around predictions."""
    return df.withColumns({"band_low": F.col("yhat") * low, "band_high": F.col("yhat") * high})
