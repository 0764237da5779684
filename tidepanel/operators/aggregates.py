"""Grouped summaries. Every one is a partial + final aggregate: rows combine before the
shuffle, so one entity holding most rows costs no more than an even spread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions import scalars as S
from tidepanel.operators import filters
from tidepanel.operators.evaluation import smallest
from tidepanel.panel import REPORTED, PanelSpec, present


def five_stats(metric: str) -> list[Column]:
    """mean, sample std, min, max, non-null count."""
    return [F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"),
            F.min(metric).alias("min"), F.max(metric).alias("max"),
            F.count(metric).alias("obs")]


def entity_ranking(df: DataFrame, spec: PanelSpec, metric: str | None = None) -> DataFrame:
    """Entities by mean, highest first."""
    out = df.groupBy(spec.entity).agg(*five_stats(metric or spec.target))
    return out.orderBy(F.col("mean").desc_nulls_last(), spec.entity)


def entity_summary(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Mean, min, max and days of rows with a target, worst entity first."""
    t = spec.target
    return (
        df.where(F.col(t).isNotNull()).groupBy(spec.entity)
        .agg(F.avg(t).alias(f"avg_{t}"), F.min(t).alias(f"min_{t}"), F.max(t).alias(f"max_{t}"),
             F.count(t).alias("days_recorded"))
        .orderBy(F.col(f"avg_{t}").desc_nulls_last(), spec.entity)
    )


def month_season(df: DataFrame, spec: PanelSpec, measures: Sequence[str]) -> DataFrame:
    """Means per calendar month over all entities, with the month's short name."""
    t = F.col(spec.time)
    return (
        df.where(F.col(spec.target).isNotNull())
        .groupBy(F.month(t).alias("month"), S.month_name(t).alias("month_name"))
        .agg(*[F.avg(m).alias(f"avg_{m}") for m in present(df, measures)])
    )


def year_trend(df: DataFrame, spec: PanelSpec, measures: Sequence[str]) -> DataFrame:
    """Means per year and the number of entities reporting."""
    return (
        df.where(F.col(spec.target).isNotNull())
        .groupBy(F.year(spec.time).alias("year"))
        .agg(*[F.avg(m).alias(f"avg_{m}") for m in present(df, measures)],
             F.countDistinct(spec.entity).alias("entities_reporting"))
    )


def month_mean(df: DataFrame, spec: PanelSpec, metric: str) -> DataFrame:
    """Mean level per calendar month; missing readings left out."""
    return (df.dropna(subset=[metric]).groupBy(F.month(spec.time).alias("month"))
            .agg(F.avg(metric).alias("mean")))


def entity_mean(df: DataFrame, spec: PanelSpec, metric: str) -> DataFrame:
    return df.dropna(subset=[metric]).groupBy(spec.entity).agg(F.avg(metric).alias("mean"))


def recent_entities(df: DataFrame, spec: PanelSpec, start: str | None = None,
                    use_synthetic: bool = False) -> DataFrame:
    """Entities with a target since ``start``, sorted."""
    df = filters.provenance(df, spec, use_synthetic).where(F.col(spec.target).isNotNull())
    df = filters.since(df, spec.time, start or filters.recent_start(use_synthetic))
    return df.select(spec.entity).distinct().orderBy(spec.entity)


def coverage_summary(df: DataFrame, spec: PanelSpec, min_days: int = 1000,
                     use_synthetic: bool = False) -> DataFrame:
    """Days, first and last date of entities with enough of them, longest first."""
    df = filters.provenance(df, spec, use_synthetic).where(F.col(spec.target).isNotNull())
    out = df.groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("days"), F.min(spec.time).alias("start_date"),
        F.max(spec.time).alias("end_date"))
    return out.where(F.col("days") >= min_days).orderBy(F.col("days").desc(), spec.entity)


def eligible_entities(df: DataFrame, spec: PanelSpec, min_days: int = 1000,
                      start: str | None = None, use_synthetic: bool = False) -> DataFrame:
    """Entities with enough days that also reach ``start``."""
    out = coverage_summary(df, spec, min_days, use_synthetic)
    out = filters.since(out, "end_date", start or filters.recent_start(use_synthetic))
    return out.select(spec.entity, F.col("days").alias("total_days"), "end_date")


def count_recent(df: DataFrame, spec: PanelSpec, start: str = filters.AFTER_REAL,
                 use_synthetic: bool = False) -> DataFrame:
    """One row with the number of rows since ``start``; zero when there are none."""
    df = filters.since(filters.provenance(df, spec, use_synthetic), spec.time, start)
    return df.agg(F.count(F.lit(1)).alias("n"))


def freshness(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Totals by provenance, entities, last ingest and latest real date, in one scan."""
    real = ~F.col(spec.synthetic)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(real).alias("real_rows"),
        F.count_if(~real).alias("synthetic_rows"),
        F.countDistinct(spec.entity).alias("entities"),
        F.max(spec.ingested).alias("last_ingested_at"),
        F.max(F.when(real, F.col(spec.time))).alias("latest_real_date"),
    )


def source_counts(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows per data source, largest first."""
    return (df.groupBy(spec.source).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.col("rows").desc(), spec.source))


def freshness_report(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``freshness`` with the per-source counts as a map column."""
    pair = F.struct(F.col(spec.source), F.col("rows"))
    sources = source_counts(df, spec).agg(
        F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("data_sources"))
    return freshness(df, spec).withColumn("data_sources", sources.scalar())


def year_over_year(df: DataFrame, spec: PanelSpec, metric: str | None = None) -> DataFrame:
    """Statistics per entity and year."""
    return (df.groupBy(spec.entity, F.year(spec.time).alias("year"))
            .agg(*five_stats(metric or spec.target)))


def yearly_stats(df: DataFrame, spec: PanelSpec, metric: str | None = None) -> DataFrame:
    """Mean, min, max and count per entity and year of a single-measure series."""
    m = metric or spec.target
    return (df.groupBy(spec.entity, F.year(spec.time).alias("year"))
            .agg(F.avg(m).alias("mean"), F.min(m).alias("min"), F.max(m).alias("max"),
                 F.count(m).alias("count")))


def monthly_trends(df: DataFrame, spec: PanelSpec, metric: str | None = None) -> DataFrame:
    """Mean per entity and month, with the first day of the month."""
    m = metric or spec.target
    out = (df.groupBy(spec.entity, F.year(spec.time).alias("year"),
                      F.month(spec.time).alias("month")).agg(F.avg(m).alias(m)))
    return out.withColumn("ym", F.make_date("year", "month", F.lit(1)))


def weekday_profile(df: DataFrame, spec: PanelSpec, metric: str | None = None) -> DataFrame:
    """Mean per entity and weekday, Monday = 0."""
    m = metric or spec.target
    parts = S.calendar_parts(spec.time)
    return (df.groupBy(spec.entity, parts["day_of_week"].alias("dow"),
                       parts["day_name"].alias("day_name"))
            .agg(F.avg(m).alias(m)).orderBy(spec.entity, "dow"))


def hourly_profile(df: DataFrame, spec: PanelSpec, metric: str | None = None) -> DataFrame:
    """Mean per entity and hour of the day."""
    m = metric or spec.target
    hour = S.calendar_parts(spec.time)["hour"]
    return df.groupBy(spec.entity, hour.alias("hour")).agg(F.avg(m).alias(m))


def hourly_band(df: DataFrame, spec: PanelSpec, metric: str | None = None) -> DataFrame:
    """Hourly mean, std and the mean ± std band per entity."""
    m = metric or spec.target
    hour = S.calendar_parts(spec.time)["hour"]
    out = df.groupBy(spec.entity, hour.alias("hour")).agg(
        F.avg(m).alias("mean"), F.stddev_samp(m).alias("std"))
    return out.withColumns({"low": F.col("mean") - F.col("std"),
                            "high": F.col("mean") + F.col("std")})


def missing_pct(df: DataFrame, spec: PanelSpec,
                measures: Sequence[str] = REPORTED) -> DataFrame:
    """Percent missing per entity and measure, all measures in one pass."""
    pct = lambda c: F.avg(F.col(c).isNull().cast("double")) * 100
    return df.groupBy(spec.entity).agg(*[pct(c).alias(c) for c in present(df, measures)])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls) for the given or all columns."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "nulls")


def distinct_gap(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows less distinct times per entity: repeated readings."""
    return df.groupBy(spec.entity).agg(
        (F.count(F.lit(1)) - F.countDistinct(spec.time)).alias("repeated"))


def coverage(df: DataFrame, spec: PanelSpec, measures: Sequence[str]) -> DataFrame:
    """Rows, range, null targets and percent present of each measure per entity."""
    rows = F.count(F.lit(1))
    return df.groupBy(spec.entity).agg(
        rows.alias("rows"), F.min(spec.time).alias("start"), F.max(spec.time).alias("end"),
        F.count_if(F.col(spec.target).isNull()).alias("null_target"),
        *[(F.count(m) / rows * 100).alias(f"{m}_pct") for m in present(df, measures)])


def threshold_days(df: DataFrame, spec: PanelSpec, limits: Sequence[int] = (100, 200)) -> DataFrame:
    """Readings above each limit per entity."""
    return df.groupBy(spec.entity).agg(
        *[F.count_if(F.col(spec.target) > x).alias(f"above_{x}") for x in limits])


def headline(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Entity count, date range, rows, mean, last reading and the extreme entities, one row."""
    t = spec.target
    per_entity = df.groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("n"), F.count(t).alias("k"), F.sum(t).alias("s"),
        F.avg(t).alias("m"), F.min(spec.time).alias("first"), F.max(spec.time).alias("last"),
        F.max(F.when(F.col(t).isNotNull(), F.struct(spec.time, *spec.tie_break, t))).alias("at"))
    high = F.min(F.when(F.col("m").isNotNull(), F.struct((-F.col("m")).alias("v"), spec.entity)))
    low = F.min(F.when(F.col("m").isNotNull(), F.struct(F.col("m").alias("v"), spec.entity)))
    latest = F.max(F.struct(F.col(f"at.{spec.time}"), F.col(spec.entity), F.col(f"at.{t}")))
    return per_entity.agg(
        F.count(F.lit(1)).alias("entities"), F.min("first").alias("start_date"),
        F.max("last").alias("end_date"), F.sum("n").alias("rows"),
        (F.sum("s") / F.sum("k")).alias("mean"),
        high[spec.entity].alias("highest"), low[spec.entity].alias("lowest"),
        latest[t].alias("latest"))


def forecast_by_month(forecast: DataFrame, spec: PanelSpec, year: int) -> DataFrame:
    """Mean forecast and bounds per month of a year; months without rows are zero."""
    cols = ["yhat", "yhat_lower", "yhat_upper"]
    got = (filters.in_year(forecast, "ds", year)
           .groupBy(spec.entity, F.month("ds").alias("month"))
           .agg(*[F.avg(c).alias(c) for c in cols]))
    every = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")
    spine = forecast.select(spec.entity).distinct().select(spec.entity, every)
    return (spine.join(got, [spec.entity, "month"], "left")
            .fillna(0.0, subset=cols))


def forecast_by_year(forecast: DataFrame, spec: PanelSpec, first_year: int) -> DataFrame:
    """Mean forecast and bounds per entity and year from ``first_year`` on."""
    return (
        filters.since(forecast, "ds", f"{first_year:04d}-01-01")
        .groupBy(spec.entity, F.year("ds").alias("year"))
        .agg(F.avg("yhat").alias("predicted"), F.avg("yhat_lower").alias("lower_bound"),
             F.avg("yhat_upper").alias("upper_bound"))
    )


def forecast_of_month(forecast: DataFrame, month: int, first_year: int) -> DataFrame:
    """Forecast rows of one calendar month, with their year."""
    rows = filters.in_month(forecast, "ds", month, first_year)
    return rows.withColumn("year", F.year("ds"))


def batch_summary(results: DataFrame, spec: PanelSpec, by: Sequence[str] = ()) -> DataFrame:
    """Error range, best and worst entity and trend shares over a batch's result rows, or over
    those of each group of ``by``, such as the model."""
    n = F.count(F.lit(1))
    better, worse = (F.count_if(F.col("trend") == x) for x in ("improving", "worsening"))
    share = lambda c: c * F.lit(100.0) / F.nullif(n, F.lit(0))
    return results.groupBy(*by).agg(
        n.alias("entities"), F.avg("mape").alias("mean_mape"), F.min("mape").alias("min_mape"),
        F.max("mape").alias("max_mape"), smallest("mape", spec.entity).alias("best"),
        smallest(-F.col("mape"), spec.entity).alias("worst"), better.alias("improving"), worse.alias("worsening"),
        share(better).alias("improving_pct"), share(worse).alias("worsening_pct"))


def overall_trend(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Mean of the last year less mean of the first, per entity."""
    years = (df.groupBy(spec.entity, F.year(spec.time).alias("year"))
             .agg(F.avg(spec.target).alias("m")).where(F.col("m").isNotNull()))
    out = years.groupBy(spec.entity).agg(
        (F.max_by("m", "year") - F.min_by("m", "year")).alias("change"),
        F.count(F.lit(1)).alias("years"))
    falling = F.when(F.col("change") < 0, "improving").otherwise("worsening")
    return out.where(F.col("years") > 1).select(spec.entity, "change", falling.alias("trend"))


def last_values(df: DataFrame, spec: PanelSpec, columns: Sequence[str]) -> DataFrame:
    """Per entity the last non-null value of each column by time; a plain aggregate."""
    order = F.struct(spec.time, *spec.tie_break)
    at = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order))
    return df.groupBy(spec.entity).agg(*[at(c).alias(c) for c in columns])


def current_level(df: DataFrame, spec: PanelSpec, start: str = "2024-01-01",
                  rows: int = 365) -> DataFrame:
    """Mean since ``start``, or of the last ``rows`` readings where there are none since."""
    known = df.where(F.col(spec.target).isNotNull())
    w = Window.partitionBy(spec.entity).orderBy(
        F.col(spec.time).desc(), *[F.col(c).desc() for c in spec.tie_break])
    tail = (known.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rows)
            .groupBy(spec.entity).agg(F.avg(spec.target).alias("tail")))
    since = filters.since(known, spec.time, start).groupBy(spec.entity).agg(
        F.avg(spec.target).alias("since"))
    return tail.join(since, spec.entity, "left").select(
        spec.entity, F.coalesce("since", "tail").alias("current"))
