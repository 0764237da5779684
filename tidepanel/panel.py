"""Column roles of a panel table and the distributed row-frame helper.

A panel holds one reading per (entity, time[, source]). ``PanelSpec`` names the
columns once; operators take ``(df, spec, ...)`` and return lazy DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Measure columns of the daily and hourly tables.
POLLUTANTS = (
    "pm2_5", "pm10", "no", "no2", "nox", "nh3", "co", "so2", "o3",
    "benzene", "toluene", "xylene",
)
# Measures reported by the missing, correlation and summary operators.
REPORTED = ("pm2_5", "pm10", "no", "no2", "nox", "nh3", "co", "so2", "o3", "aqi")


@dataclass(frozen=True)
class PanelSpec:
    """Column roles.

    ``block_seconds`` is None when the calendar bounds an entity's history (one
    row per day is 36,525 rows per century), so an entity fits one window task.
    Set it for raw event-like panels, where one entity may hold a third of all
    rows: ROWS frames then run per (entity, run of ``block_rows`` rows), see
    ``over_rows``. It should be short enough that one entity's rows within it fit
    one task. Such a panel can hold equal times, so it must name a ``tie_break``.
    """

    entity: str = "city"
    time: str = "date"
    target: str = "aqi"
    bucket: str = "aqi_bucket"
    synthetic: str = "is_synthetic"
    source: str = "data_source"
    ingested: str = "ingested_at"
    tie_break: tuple[str, ...] = ()
    block_seconds: int | None = None
    block_rows: int = 250_000

    def __post_init__(self):
        if self.block_seconds is not None and not self.tie_break:
            raise ValueError("a panel in blocks needs a tie_break, or equal times have no order")

    def with_(self, **changes) -> PanelSpec:
        return replace(self, **changes)


HOURLY = PanelSpec(time="datetime")


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns the frame has, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def normalise(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Drop rows without entity or time; NaN becomes NULL (avg and max skip only NULL)."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    df = df.where(F.col(spec.entity).isNotNull() & F.col(spec.time).isNotNull())
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def daily_panel(df: DataFrame, spec: PanelSpec, measures: Sequence[str],
                digits: int | None = None) -> DataFrame:
    """One row per entity and day: the mean of each measure, NULLs skipped."""
    def mean(c):
        m = F.avg(c)
        return (F.round(m + F.lit(1e-9), digits) if digits is not None else m).alias(c)

    day = F.to_date(F.col(spec.time)).alias("date")
    return df.groupBy(F.col(spec.entity), day).agg(*[mean(c) for c in measures])


def epoch_seconds(time: Column) -> Column:
    """Whole seconds since 1970 for a date or a timestamp, zoned or not."""
    return F.unix_seconds(time.cast("timestamp"))


_SLOT, _START, _POS, _RUN, _HOME = "_slot", "_start", "_pos", "_run", "_home"


def _placed(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add each row's 1-based position within its entity without an entity-wide sort.

    Rows are numbered inside (entity, time slot); the slot's start offset is a
    running sum over the per-slot counts, a table of one row per entity and slot.
    """
    slot = F.floor(epoch_seconds(F.col(spec.time)) / F.lit(spec.block_seconds))
    slotted = df.withColumn(_SLOT, slot)
    by_slot = Window.partitionBy(spec.entity).orderBy(_SLOT)
    before = F.sum("_n").over(by_slot.rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        slotted.groupBy(spec.entity, _SLOT).agg(F.count(F.lit(1)).alias("_n"))
        .select(spec.entity, _SLOT, F.coalesce(before, F.lit(0)).alias(_START))
    )
    in_slot = Window.partitionBy(spec.entity, _SLOT).orderBy(spec.time, *spec.tie_break)
    return (
        slotted.join(starts, [spec.entity, _SLOT])
        .withColumn(_POS, F.col(_START) + F.row_number().over(in_slot))
        .drop(_SLOT, _START)
    )


def over_rows(df: DataFrame, spec: PanelSpec, before: int, after: int,
              build: Callable[[WindowSpec], dict[str, Column]]) -> DataFrame:
    """Add ROWS-frame columns ordered by time within each entity.

    ``build`` gets an ordered window and may look ``before`` rows back and
    ``after`` rows ahead. With ``block_seconds`` unset that window covers the
    entity: one exchange, one sort. Otherwise each run of ``block_rows`` positions
    is its own window partition and carries copies of its neighbours' edge rows, so
    frames are exact and a hot entity spreads over many tasks.
    """
    if spec.block_seconds is None:
        w = Window.partitionBy(spec.entity).orderBy(spec.time, *spec.tie_break)
        return df.withColumns(build(w))
    size = max(spec.block_rows, before, after, 1)
    run = F.floor((F.col(_POS) - 1) / F.lit(size))
    within = F.pmod(F.col(_POS) - 1, F.lit(size))
    copies = F.array_compact(F.array(
        run,
        F.when(within >= F.lit(size - before), run + 1),
        F.when(within < F.lit(after), run - 1),
    ))
    spread = _placed(df, spec).withColumn(_HOME, run).withColumn(_RUN, F.explode(copies))
    w = Window.partitionBy(spec.entity, _RUN).orderBy(_POS)
    out = spread.withColumns(build(w)).where(F.col(_RUN) == F.col(_HOME))
    return out.drop(_POS, _RUN, _HOME)


def entity_means(df: DataFrame, spec: PanelSpec, stats: dict[str, Column],
                 keys: Sequence[str] | None = None) -> DataFrame:
    """Add group aggregates to every row.

    Aggregate then join, not an unordered window: the aggregate combines map-side
    and the join side is one row per group, so a hot entity is never one task.
    """
    keys = list(keys or [spec.entity])
    small = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return df.join(small, keys, "left")
