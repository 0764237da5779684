"""Row-frame operators over an entity's time order, and their group-wise companions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidepanel.functions import scalars as S
from tidepanel.panel import PanelSpec, entity_means, epoch_seconds, over_rows, present

# Default columns, lags and widths.
LAG_COLUMNS = ("aqi", "pm2_5", "no2", "co", "o3")
LAGS = (1, 2, 3, 7)
ROLL_COLUMNS = ("aqi", "pm2_5")
ROLL_WIDTHS = (3, 7, 30)
ROLL_STATS = ("mean", "std", "max")


def lag_name(column: str, rows: int) -> str:
    return f"{column}_lag{rows}"


def roll_name(column: str, rows: int, stat: str) -> str:
    return f"{column}_roll{rows}_{stat}"


def zscore_name(target: str, entity: str) -> str:
    return f"{target}_{entity}_zscore"


def lag_columns(w: WindowSpec, columns: Sequence[str], lags: Sequence[int]) -> dict[str, Column]:
    return {lag_name(c, n): F.lag(c, n).over(w) for c in columns for n in lags}


def rolling_columns(w: WindowSpec, columns: Sequence[str], widths: Sequence[int],
                    lead_out: int = 0) -> dict[str, Column]:
    """Mean, std (0 below two values) and max; ``lead_out=1`` leaves the current row out."""
    out = {}
    for c in columns:
        for n in widths:
            f = w.rowsBetween(-(n - 1) - lead_out, -lead_out)
            out[roll_name(c, n, "mean")] = F.avg(c).over(f)
            out[roll_name(c, n, "std")] = F.coalesce(F.stddev_samp(c).over(f), F.lit(0.0))
            out[roll_name(c, n, "max")] = F.max(c).over(f)
    return out


def add_lags(df: DataFrame, spec: PanelSpec, columns: Sequence[str] = LAG_COLUMNS,
             lags: Sequence[int] = LAGS) -> DataFrame:
    """Values n rows back (rows, not calendar days); columns the frame lacks are skipped."""
    got = present(df, columns)
    return over_rows(df, spec, max(lags), 0, lambda w: lag_columns(w, got, lags))


def add_rolling(df: DataFrame, spec: PanelSpec, columns: Sequence[str] = ROLL_COLUMNS,
                widths: Sequence[int] = ROLL_WIDTHS, leak_free: bool = False) -> DataFrame:
    """Trailing statistics over the last n rows, the current one included unless leak-free."""
    got, skip = present(df, columns), int(leak_free)
    return over_rows(df, spec, max(widths) - 1 + skip, 0,
                     lambda w: rolling_columns(w, got, widths, skip))


def add_rolling_min(df: DataFrame, spec: PanelSpec, columns: Sequence[str],
                    widths: Sequence[int]) -> DataFrame:
    """Smallest value of the last n rows."""
    got = present(df, columns)
    return over_rows(df, spec, max(widths) - 1, 0, lambda w: {
        f"{c}_roll{n}_min": F.min(c).over(w.rowsBetween(-(n - 1), 0)) for c in got for n in widths})


def rolling_mean(df: DataFrame, spec: PanelSpec, column: str, width: int) -> DataFrame:
    """One trailing mean of any width."""
    return over_rows(df, spec, width - 1, 0, lambda w: {
        f"{column}_avg{width}": F.avg(column).over(w.rowsBetween(-(width - 1), 0))})


def rolling_calendar(df: DataFrame, spec: PanelSpec, column: str, days: int) -> DataFrame:
    """Trailing mean over true calendar days, gaps included.

    A panel in blocks is summed per entity and day first, so a window task holds the days of
    an entity and not its rows.
    """
    name = f"{column}_avg{days}d"
    last = lambda day: (Window.partitionBy(spec.entity).orderBy(F.unix_date(day))
                        .rangeBetween(-(days - 1), 0))
    day = F.to_date(spec.time)
    if spec.block_seconds is None:
        return df.withColumn(name, F.avg(column).over(last(day)))
    sums = df.groupBy(spec.entity, day.alias("_day")).agg(
        F.sum(column).alias("_sum"), F.count(column).alias("_n"))
    total, n = (F.sum(c).over(last(F.col("_day"))) for c in ("_sum", "_n"))
    means = sums.select(spec.entity, "_day", F.when(n > 0, total / n).alias(name))
    return df.withColumn("_day", day).join(means, [spec.entity, "_day"], "left").select(*df.columns, name)


def add_zscore(df: DataFrame, spec: PanelSpec, target: str | None = None,
               digits: int = 3, fit: DataFrame | None = None) -> DataFrame:
    """Distance from the entity's mean in its standard deviations.

    A zero deviation divides by one, a single reading gives NULL. ``fit`` names the
    rows the mean and deviation come from, such as the training part.
    """
    t = target or spec.target
    source = df if fit is None else fit
    small = source.groupBy(spec.entity).agg(
        F.avg(t).alias("_m"), F.stddev_samp(t).alias("_s"))
    unit = F.when(F.col("_s") == 0, F.lit(1.0)).otherwise(F.col("_s"))
    z = F.round((F.col(t) - F.col("_m")) / unit, digits)
    return (df.join(small, spec.entity, "left")
            .withColumn(zscore_name(t, spec.entity), z).drop("_m", "_s"))


def trend_decomposition(df: DataFrame, spec: PanelSpec, column: str | None = None,
                        width: int = 90, least: int = 30) -> DataFrame:
    """Centred moving mean, residual from it, and the mean of the same day of the year."""
    c = column or spec.target
    back, ahead = width // 2, width - width // 2 - 1

    def build(w):
        f = w.rowsBetween(-back, ahead)
        return {"trend": F.when(F.count(c).over(f) >= least, F.avg(c).over(f))}

    out = over_rows(df, spec, back, ahead, build)
    out = out.withColumn("seasonal_30", F.col(c) - F.col("trend"))
    out = out.withColumn("_doy", F.dayofyear(spec.time))
    out = entity_means(out, spec, {"seasonal_avg": F.avg(c)}, [spec.entity, "_doy"])
    return out.drop("_doy")


def gap_rows(df: DataFrame, spec: PanelSpec, hours: float = 2.0) -> DataFrame:
    """Consecutive readings of an entity more than ``hours`` apart: start, end, length.

    Slots of ``block_seconds`` are scanned apart; their first and last readings, one
    row per entity and slot, give the gaps between slots.
    """
    t = spec.time
    known = df.where(F.col(spec.target).isNotNull()).select(spec.entity, t)
    if spec.block_seconds is None:
        w = Window.partitionBy(spec.entity).orderBy(t)
        gaps = known.withColumn("gap_start", F.lag(t).over(w))
    else:
        slotted = known.withColumn(
            "_slot", F.floor(epoch_seconds(F.col(t)) / F.lit(spec.block_seconds)))
        inner = Window.partitionBy(spec.entity, "_slot").orderBy(t)
        within = (slotted.withColumn("gap_start", F.lag(t).over(inner))
                  .select(spec.entity, "gap_start", t))
        edges = slotted.groupBy(spec.entity, "_slot").agg(
            F.min(t).alias(t), F.max(t).alias("_last"))
        outer = Window.partitionBy(spec.entity).orderBy("_slot")
        between = (edges.withColumn("gap_start", F.lag("_last").over(outer))
                   .select(spec.entity, "gap_start", t))
        gaps = within.unionByName(between)
    length = S.hours_between("gap_start", t)
    return (gaps.withColumn("gap_hours", length).where(F.col("gap_hours") > hours)
            .select(spec.entity, "gap_start", F.col(t).alias("gap_end"), "gap_hours"))


def detect_gaps(df: DataFrame, spec: PanelSpec, hours: float = 2.0) -> DataFrame:
    """Number, largest and total length of gaps per entity."""
    return gap_rows(df, spec, hours).groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("gaps"), F.max("gap_hours").alias("largest"),
        F.sum("gap_hours").alias("total"))


def moving_average(df: DataFrame, spec: PanelSpec, cutoff: str, window: int = 7) -> DataFrame:
    """One-step-ahead mean of the previous rows' actual values, for rows since the cutoff.

    No prediction where a value is missing among them or fewer rows precede.
    """
    t = spec.target

    def build(w):
        f = w.rowsBetween(-window, -1)
        return {"yhat": F.when(F.count(t).over(f) == window, F.avg(t).over(f))}

    return _baseline(over_rows(df, spec, window, 0, build), spec, cutoff, "Moving Average")


def seasonal_naive(df: DataFrame, spec: PanelSpec, cutoff: str, period: int = 365) -> DataFrame:
    """The value ``period`` rows back, for rows since the cutoff."""
    out = over_rows(df, spec, period, 0, lambda w: {"yhat": F.lag(spec.target, period).over(w)})
    return _baseline(out, spec, cutoff, "Seasonal Naive")


def persistence(df: DataFrame, spec: PanelSpec, cutoff: str) -> DataFrame:
    """The previous row's value, for rows since the cutoff."""
    out = over_rows(df, spec, 1, 0, lambda w: {"yhat": F.lag(spec.target, 1).over(w)})
    return _baseline(out, spec, cutoff, "Persistence")


def _baseline(df: DataFrame, spec: PanelSpec, cutoff: str, name: str) -> DataFrame:
    test = F.col(spec.time) >= F.lit(cutoff).cast(df.schema[spec.time].dataType)
    return df.where(test).select(
        spec.entity, F.lit(name).alias("model"), F.col(spec.time).alias("ds"),
        F.col(spec.target).alias("y"), "yhat")


def last_features(df: DataFrame, spec: PanelSpec, columns: Sequence[str]) -> DataFrame:
    """The last row's features per entity, NULL as 0."""
    order = F.struct(spec.time, *spec.tie_break)
    row = F.max_by(F.struct(spec.time, *columns), order)
    last = df.groupBy(spec.entity).agg(row.alias("r"))
    return last.select(spec.entity, F.col(f"r.{spec.time}").alias(spec.time),
                       *[F.coalesce(F.col(f"r.{c}").cast("double"), F.lit(0.0)).alias(c)
                         for c in columns])


def missing_runs(df: DataFrame, spec: PanelSpec, column: str | None = None) -> DataFrame:
    """Runs of consecutive rows without a value: first and last time and length.

    The rows of a run have the same number of values before them. A panel in blocks counts
    within slots of ``block_seconds`` and adds the values of earlier slots, one row per entity
    and slot, so pieces of a run in several slots meet under the same number.
    """
    c = column or spec.target
    part = [spec.entity] if spec.block_seconds is None else [spec.entity, "_slot"]
    if spec.block_seconds is not None:
        df = df.withColumn("_slot", F.floor(epoch_seconds(F.col(spec.time)) / F.lit(spec.block_seconds)))
    w = Window.partitionBy(*part).orderBy(spec.time, *spec.tie_break)
    seen = F.count(c).over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = (df.withColumn("_seen", seen).where(F.col(c).isNull())
            .groupBy(*part, "_seen")
            .agg(F.min(spec.time).alias("start"), F.max(spec.time).alias("end"),
                 F.count(F.lit(1)).alias("length")))
    if spec.block_seconds is None:
        return runs.drop("_seen")
    earlier = Window.partitionBy(spec.entity).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = df.groupBy(*part).agg(F.count(c).alias("_n")).select(
        *part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (runs.join(slots, part)
            .groupBy(spec.entity, (F.col("_before") + F.col("_seen")).alias("_seen"))
            .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                 F.sum("length").alias("length")).drop("_seen"))
