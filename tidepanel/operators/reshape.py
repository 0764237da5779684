"""Set operations, pivots and wide-to-long. Pivot levels are literals: no extra job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import scalars as S
from tidepanel.functions.quantiles import approx_quantiles, exact_quantiles, melt
from tidepanel.panel import REPORTED, PanelSpec, present


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenate by column name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def rounded(df: DataFrame, digits: int = 1) -> DataFrame:
    """All double columns rounded, as a last step before presentation."""
    return df.withColumns({n: F.round(n, digits) for n, kind in df.dtypes if kind == "double"})


def distinct_entities(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.select(spec.entity).distinct()


def bucket_distribution(df: DataFrame, spec: PanelSpec,
                        levels: Sequence[str] = S.LEVEL_NAMES) -> DataFrame:
    """Readings per entity and level with total and percent; absent levels count 0."""
    counts = [F.count_if(F.col(spec.bucket) == b).alias(b) for b in levels]
    out = df.where(F.col(spec.bucket).isNotNull()).groupBy(spec.entity).agg(*counts)
    total = reduce(lambda a, b: a + b, [F.col(b) for b in levels])
    out = out.withColumn("Total", total)
    pct = lambda b: F.col(b) / F.nullif(F.col("Total"), F.lit(0)) * 100
    return out.withColumns({f"{b}_pct": pct(b) for b in levels})


def season_pivot(df: DataFrame, spec: PanelSpec, calendar=S.SUMMER_WINTER,
                 metric: str | None = None) -> DataFrame:
    """Mean per entity, one column per season of the calendar."""
    names = sorted(set(calendar.values()))
    named = df.withColumn("_season", S.season(spec.time, calendar)).where(
        F.col("_season").isNotNull())
    return named.groupBy(spec.entity).pivot("_season", names).agg(F.avg(metric or spec.target))


def summer_winter(df: DataFrame, spec: PanelSpec, digits: int = 1) -> DataFrame:
    """Summer and winter means, rounded, and winter / summer of those rounded means."""
    out = season_pivot(df, spec, S.SUMMER_WINTER)
    out = out.withColumns({s: F.round(F.col(s) + F.lit(1e-9), digits) for s in ("summer", "winter")})
    return out.withColumn("winter_summer_ratio", S.ratio_safe("winter", "summer"))


def measure_summary(df: DataFrame, spec: PanelSpec, measures: Sequence[str] = REPORTED,
                    by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """count, mean, std, min, quartiles, max and percent missing, one row per measure."""
    got = present(df, measures)
    keys = [*by, "measure"]
    rows = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")) if by else None
    long = melt(df, list(by), got)
    stats = long.groupBy(*keys).agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"))
    quantiles = exact_quantiles if exact else approx_quantiles
    parts = quantiles(df, list(by), got, [0.25, 0.5, 0.75]).groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("q"))).alias(n)
          for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    out = stats.join(parts, keys, "left")
    if by:
        out = out.join(rows, list(by)).withColumn("_all", F.col("rows")).drop("rows")
    else:
        out = out.withColumn("_all", df.agg(F.count(F.lit(1))).scalar())
    missing = (F.col("_all") - F.col("count")) / F.col("_all") * 100
    return out.select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max",
                      missing.alias("missing_pct"))


def described(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(measure, statistic, value): the summary turned to rows, one scan."""
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.agg(*[f(m).cast("double").alias(f"{m}|{s}")
                   for m in measures for s, f in stats.items()])
    long = one.unpivot([], one.columns, "_k", "value")
    part = F.split("_k", r"\|")
    return long.select(part[0].alias("measure"), part[1].alias("statistic"), "value")
