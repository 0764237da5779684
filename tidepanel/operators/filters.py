"""Selections and projections. Time predicates are ranges, so file statistics prune."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.panel import POLLUTANTS, PanelSpec, present

# Start of "recent" with and without synthetic rows; first day after real data.
RECENT_REAL = "2020-01-01"
RECENT_SYNTHETIC = "2024-01-01"
AFTER_REAL = "2020-07-01"
# Columns that are never features.
NOT_FEATURES = ("date", "datetime", "city", "aqi_bucket", "is_synthetic", "data_source", "ds")


def provenance(df: DataFrame, spec: PanelSpec, use_synthetic: bool = False) -> DataFrame:
    """Real rows only, unless synthetic ones are asked for."""
    return df if use_synthetic else df.where(~F.col(spec.synthetic))


def only_entities(df: DataFrame, spec: PanelSpec,
                  entities: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows of the wanted entities: a short list becomes a pushed filter, a table (one column
    named as the entity) a semi-join, None keeps all."""
    if entities is None:
        return df
    if isinstance(entities, DataFrame):
        return df.join(entities.select(spec.entity), spec.entity, "left_semi")
    return df.where(F.col(spec.entity).isin(list(entities)))


def entity_series(df: DataFrame, spec: PanelSpec, entities: Sequence[str] | DataFrame | None = None,
                  use_synthetic: bool = False) -> DataFrame:
    """(entity, ds, y) of rows with a target, for some or all entities in one scan."""
    df = provenance(df, spec, use_synthetic).where(F.col(spec.target).isNotNull())
    df = only_entities(df, spec, entities)
    return df.select(spec.entity, F.to_date(spec.time).alias("ds"), F.col(spec.target).alias("y"))


def entity_measures(df: DataFrame, spec: PanelSpec, entities: Sequence[str] | DataFrame | None = None,
                    use_synthetic: bool = False) -> DataFrame:
    """All measure and provenance columns of some or all entities; the entity is kept."""
    df = provenance(df, spec, use_synthetic)
    df = only_entities(df, spec, entities)
    wanted = [spec.entity, spec.time, *POLLUTANTS, spec.target, spec.bucket,
              spec.synthetic, spec.source]
    return df.select(*present(df, wanted))


def hourly_measures(df: DataFrame, spec: PanelSpec,
                    entities: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """The hourly page's columns, real rows only."""
    df = provenance(df, spec)
    df = only_entities(df, spec, entities)
    return df.select(*present(df, [spec.entity, spec.time, "pm2_5", "pm10", "no2", "co", "o3",
                                   spec.target]))


def recent_start(use_synthetic: bool = False) -> str:
    return RECENT_SYNTHETIC if use_synthetic else RECENT_REAL


def _at(df: DataFrame, column: str, day: str | dt.date):
    return F.lit(str(day)).cast(df.schema[column].dataType)


def since(df: DataFrame, time: str, start: str | dt.date) -> DataFrame:
    return df.where(F.col(time) >= _at(df, time, start))


def before(df: DataFrame, time: str, end: str | dt.date) -> DataFrame:
    return df.where(F.col(time) < _at(df, time, end))


def outside(df: DataFrame, time: str, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Rows before ``start`` or after ``end``: skips an anomalous era."""
    return df.where((F.col(time) < _at(df, time, start)) | (F.col(time) > _at(df, time, end)))


def in_year(df: DataFrame, time: str, year: int) -> DataFrame:
    return before(since(df, time, f"{year:04d}-01-01"), time, f"{year + 1:04d}-01-01")


def in_month(df: DataFrame, time: str, month: int, first_year: int) -> DataFrame:
    """One calendar month of every year from ``first_year`` on."""
    return since(df, time, f"{first_year:04d}-01-01").where(F.month(time) == month)


def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def above(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.where(F.col(column) > limit)


def below(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.where(F.col(column) < limit)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; others in the map are ignored."""
    return df.withColumnsRenamed(dict(names))


def stamped(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns, such as provenance."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def numeric_features(df: DataFrame, target: str = "aqi", exclude: Sequence[str] = NOT_FEATURES,
                     wide_types_only: bool = False) -> list[str]:
    """Numeric columns other than ids and target. ``wide_types_only`` leaves 32-bit integers out."""
    kinds = (T.DoubleType, T.FloatType, T.LongType) if wide_types_only else T.NumericType
    skip = {target, *exclude}
    return [f.name for f in df.schema if f.name not in skip and isinstance(f.dataType, kinds)]
