"""Data quality checks as single aggregate passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import scalars as S
from tidepanel.operators.aggregates import missing_pct
from tidepanel.operators.joins import unmatched
from tidepanel.panel import REPORTED, PanelSpec, present

# Chosen cut-offs: percent of readings present per grade.
GRADES = ((60, "F"), (70, "D"), (85, "C"), (90, "B"), (93, "B+"), (94, "A-"), (99, "A"),
          (None, "A+"))
# Valid range per measure.
RANGES = {"pm2_5": (0, 500), "pm10": (0, 1000), "aqi": (0, 500), "co": (0, 10),
          "no2": (0, 500), "o3": (0, 500)}


def completeness_warnings(df: DataFrame, spec: PanelSpec, measures: Sequence[str] = REPORTED,
                          high: float = 50.0, low: float = 20.0) -> DataFrame:
    """Per entity the measures missing more than ``high`` percent, and whether all are below ``low``."""
    got = present(df, measures)
    pct = missing_pct(df, spec, got)
    bad = F.array_compact(F.array(*[F.when(F.col(c) > high, F.lit(c)) for c in got]))
    good = F.forall(F.array(*[F.col(c) for c in got]), lambda x: x < low)
    return pct.select(spec.entity, bad.alias("mostly_missing"), good.alias("well_covered"))


def completeness_grade(df: DataFrame, spec: PanelSpec, measures: Sequence[str] = REPORTED,
                       grades=GRADES) -> DataFrame:
    """Percent present per entity and measure, with a grade."""
    got = present(df, measures)
    pct = df.groupBy(spec.entity).agg(
        *[(F.count(c) / F.count(F.lit(1)) * 100).alias(c) for c in got])
    long = pct.unpivot([spec.entity], got, "measure", "coverage")
    return long.withColumn("grade", S.banded("coverage", grades, strict=True))


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: keys that occur more than once and the surplus rows they hold."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"),
                       F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"))


def timestamp_validity(df: DataFrame, column: str, start: str, today: str) -> DataFrame:
    """One row: texts that are no timestamp, lie in the future, or before ``start``."""
    t = F.try_to_timestamp(F.col(column))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(column).isNotNull() & t.isNull()).alias("invalid"),
        F.count_if(t > F.lit(today).cast("timestamp")).alias("future"),
        F.count_if(t < F.lit(start).cast("timestamp")).alias("early"),
        F.min(F.to_date(t)).alias("first_day"), F.max(F.to_date(t)).alias("last_day"))


def range_check(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = RANGES) -> DataFrame:
    """(measure, negative, above, max) against the valid range of each measure."""
    got = present(df, list(ranges))
    one = df.agg(*[e for c in got for e in (
        F.count_if(F.col(c) < ranges[c][0]).alias(f"{c}|low"),
        F.count_if(F.col(c) > ranges[c][1]).alias(f"{c}|high"),
        F.max(F.col(c).cast("double")).alias(f"{c}|max"))])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("measure"), F.col(f"{c}|low").alias("negative"),
        F.col(f"{c}|high").alias("above"), F.col(f"{c}|max").alias("highest")) for c in got])))


def bucket_mismatches(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row: labelled readings and how many labels differ from the value's level."""
    both = df.where(F.col(spec.target).isNotNull() & F.col(spec.bucket).isNotNull())
    wrong = ~F.col(spec.bucket).eqNullSafe(S.aqi_bucket(spec.target))
    return both.agg(F.count(F.lit(1)).alias("labelled"), F.count_if(wrong).alias("mismatches"))


def cross_dataset(pairs: Mapping[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """(check, keys, missing) per named (readings, dimension, key)."""
    out = None
    for name, (left, right, key) in pairs.items():
        row = unmatched(left, right, key).select(F.lit(name).alias("check"), "keys", "missing")
        out = row if out is None else out.unionByName(row)
    return out


def missing_by_month(df: DataFrame, spec: PanelSpec, measures: Sequence[str]) -> DataFrame:
    """Percent missing per calendar month: whether gaps are seasonal."""
    pct = lambda c: F.avg(F.col(c).isNull().cast("double")) * 100
    return df.groupBy(F.month(spec.time).alias("month")).agg(
        *[pct(c).alias(c) for c in present(df, measures)])


def variation(df: DataFrame, spec: PanelSpec, limit: float = 300) -> DataFrame:
    """Coefficient of variation and readings above a limit per entity."""
    t = F.col(spec.target)
    return df.groupBy(spec.entity).agg(
        (F.stddev_samp(t) / F.nullif(F.avg(t), F.lit(0.0))).alias("cv"),
        F.count_if(t > limit).alias("extreme"))


def anomalies(df: DataFrame, spec: PanelSpec, quartiles: DataFrame, z: float = 3.0,
              whisker: float = 1.5) -> DataFrame:
    """Rows far from their entity's mean, or outside its quartile whiskers.

    ``quartiles`` holds (entity, p25, p75).
    """
    t = F.col(spec.target)
    stats = df.groupBy(spec.entity).agg(F.avg(t).alias("_m"), F.stddev_samp(t).alias("_s"))
    out = df.join(stats.join(quartiles, spec.entity), spec.entity)
    iqr = F.col("p75") - F.col("p25")
    by_z = F.abs(t - F.col("_m")) > z * F.col("_s")
    by_iqr = (t < F.col("p25") - whisker * iqr) | (t > F.col("p75") + whisker * iqr)
    out = out.withColumns({"by_zscore": by_z, "by_iqr": by_iqr})
    return out.where("by_zscore or by_iqr").drop("_m", "_s", "p25", "p75")
