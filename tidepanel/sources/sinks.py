"""Writers: idempotent append on the natural key, replace, CSV and JSON exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.panel import PanelSpec


#: The partition column of tables stored by time.
YEAR = "stored_year"


def stamp(df: DataFrame, data_source: str = "OpenAQ", is_synthetic: bool = False) -> DataFrame:
    """Provenance for incoming rows; a pm25 column becomes pm2_5."""
    return df.withColumnRenamed("pm25", "pm2_5").withColumns({
        "data_source": F.lit(data_source), "is_synthetic": F.lit(is_synthetic),
        "ingested_at": F.current_timestamp()})


def new_rows(incoming: DataFrame, target: DataFrame | None, key: Sequence[str],
             latest: str = "ingested_at") -> DataFrame:
    """Incoming rows whose key is new: one row per key, none the target has.

    Of several rows with a key the one with the greatest ``latest`` is taken, then the one
    with the greatest other columns in their order. NULL is a key value like any other.
    """
    rest = [c for c in incoming.columns if c not in key]
    order = [c for c in (latest,) if c in rest] + [c for c in rest if c != latest]
    if not order:
        out = incoming.distinct()
    else:
        picked = incoming.groupBy(*key).agg(F.max(F.struct(*order)).alias("_row"))
        out = picked.select(*[F.col(c) if c in key else F.col("_row")[c].alias(c)
                              for c in incoming.columns])
    if target is None:
        return out
    known = target.select(*[F.col(c).alias(f"_known_{c}") for c in key])
    same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in key]
    return out.join(known, reduce(lambda a, b: a & b, same), "left_anti")


def key_of(spec: PanelSpec) -> list[str]:
    return [spec.entity, spec.time, spec.source]


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_unique(incoming: DataFrame, path: str, key: Sequence[str],
                  time: str | None = None) -> None:
    """Append the rows whose key the stored table lacks; repeating a load adds nothing.

    With ``time`` the table is stored in partitions of a year, and only the partitions of the
    incoming rows are read, as well as the one of unknown times.
    """
    spark = incoming.sparkSession
    try:
        target = spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        target = None
    if time is None:
        append(new_rows(incoming, target, key), path)
        return
    if target is not None:
        ends = incoming.agg(F.min(F.year(time)).alias("a"), F.max(F.year(time)).alias("b")).first()
        years = F.col(YEAR).between(ends["a"], ends["b"]) if ends["a"] is not None else F.lit(False)
        target = target.where(years | F.col(YEAR).isNull())
    append(new_rows(incoming, target, key).withColumn(YEAR, F.year(time)), path, [YEAR])


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``append_unique``, without its partition column."""
    return spark.read.parquet(path).drop(YEAR)


def recreate(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the stored table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def to_json(spark: SparkSession, config: Mapping[str, object], path: str) -> None:
    """A settings record as one JSON row."""
    one = spark.range(1).select(*[F.lit(v).alias(k) for k, v in config.items()])
    one.write.mode("overwrite").json(path)


def model_config(metrics: DataFrame, spec: PanelSpec, notes: Mapping[str, str],
                 keep: Sequence[str] = ()) -> DataFrame:
    """One settings row per row of ``metrics``: entity, validation error, the columns of ``keep``
    and the notes."""
    text = F.concat(F.format_number("mape", 1), F.lit("%"))
    return metrics.select(spec.entity, text.alias("validation_mape"), *keep,
                          *[F.lit(v).alias(k) for k, v in notes.items()])
