"""Readers: CSV and tables with fixed schemas, JSON payloads, calendars, source choice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.functions import scalars as S
from tidepanel.operators.filters import renamed, stamped
from tidepanel.panel import PanelSpec, normalise
from tidepanel.sources import schemas


def _csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def daily_csv(spark: SparkSession, path: str, data_source: str = "CPCB",
              is_synthetic: bool = False) -> DataFrame:
    """Raw daily CSV under the library's names, with provenance."""
    df = renamed(_csv(spark, path, schemas.csv_schema(schemas.DAILY_HEADERS)), schemas.CSV_NAMES)
    return stamped(normalise(df, PanelSpec()),
                   {"is_synthetic": is_synthetic, "data_source": data_source})


def hourly_csv(spark: SparkSession, path: str, data_source: str = "CPCB",
               is_synthetic: bool = False) -> DataFrame:
    """Raw hourly CSV under the library's names, with provenance."""
    df = renamed(_csv(spark, path, schemas.csv_schema(schemas.HOURLY_HEADERS)), schemas.CSV_NAMES)
    return stamped(normalise(df, PanelSpec(time="datetime")),
                   {"is_synthetic": is_synthetic, "data_source": data_source})


def ingest_report(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows, time range and entities of a loaded file, one row."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(spec.time).alias("start"),
                  F.max(spec.time).alias("end"), F.countDistinct(spec.entity).alias("entities"))


def processed_csv(spark: SparkSession, path: str, headers: Sequence[str],
                  data_source: str = "CPCB", is_synthetic: bool = False) -> DataFrame:
    """A pre-cleaned CSV; its pm25 column, if any, becomes pm2_5."""
    df = _csv(spark, path, schemas.csv_schema(headers)).withColumnRenamed("pm25", "pm2_5")
    return stamped(normalise(df, PanelSpec()),
                   {"is_synthetic": is_synthetic, "data_source": data_source})


def stations_csv(spark: SparkSession, path: str) -> DataFrame:
    return renamed(_csv(spark, path, schemas.STATION_SCHEMA), schemas.STATION_NAMES)


def table_query(spark: SparkSession, query: str, **args) -> DataFrame:
    """A parameterised SQL query; values are bound, never pasted into the text."""
    return spark.sql(query, args=args)


def row_payload(df: DataFrame, payload: str = "payload", keys: Sequence[str] = ()) -> DataFrame:
    """One row per reading of a ``{results: [{date: {local}, value, location}]}`` payload."""
    parsed = F.from_json(payload, schemas.ROW_PAYLOAD)
    items = df.select(*keys, F.inline(parsed["results"]))
    return items.select(*keys, S.parse_date("date.local").alias("date"),
                        F.col("value").alias("pm2_5"),
                        F.coalesce("location", F.lit("unknown")).alias("location"))


def payload_daily_index(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Daily mean of the readings and its index."""
    out = rows.groupBy(*keys, "date").agg(F.avg("pm2_5").alias("pm2_5"))
    return out.withColumn("aqi", S.pm25_to_aqi("pm2_5"))


def array_payload(df: DataFrame, section: str, fields: Sequence[str], payload: str = "payload",
                  keys: Sequence[str] = ()) -> DataFrame:
    """One row per element of a payload of parallel arrays, matched by position."""
    parsed = F.from_json(payload, schemas.array_payload(section, fields))[section]
    items = F.arrays_zip(*[parsed[f].alias(f) for f in ("time", *fields)])
    rows = df.select(*keys, F.inline(items))
    return rows.withColumn("time", S.parse_date("time")).withColumnRenamed("time", "date")


def payload_describe(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """count, mean, std, min and max of the payload's fields."""
    from tidepanel.operators.reshape import described

    return described(rows, fields)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether a table is there; False when the catalog cannot say."""
    try:
        return spark.catalog.tableExists(name)
    except Exception:
        return False


def has_rows(spark: SparkSession, name: str) -> bool:
    """Whether a table is there and not empty."""
    return table_exists(spark, name) and not spark.table(name).isEmpty()


def table_state(spark: SparkSession, name: str) -> DataFrame:
    """One row: the name, whether the table is there, and how many rows it has."""
    found = table_exists(spark, name)
    rows = spark.table(name).select(F.lit(1).alias("x")) if found else spark.range(0).select(F.lit(1).alias("x"))
    return rows.agg(F.count("x").alias("n")).select(
        F.lit(name).alias("name"), F.lit(found).alias("found"), "n")


def first_available(*sources: Callable[[], DataFrame | None]) -> DataFrame | None:
    """The first source that yields rows; a source that is missing yields None."""
    for load in sources:
        try:
            df = load()
            if df is not None and not df.isEmpty():
                return df
        except AnalysisException as exc:
            if exc.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
    return None


def legacy_view(df: DataFrame, name: str) -> DataFrame:
    """Register the panel without its id and with pm25 for pm2_5."""
    out = df.drop("id").withColumnRenamed("pm2_5", "pm25")
    out.createOrReplaceTempView(name)
    return out


def date_spine(df: DataFrame, spec: PanelSpec, periods: int = 0) -> DataFrame:
    """Every day of each entity from its first to its last reading plus ``periods`` days."""
    ends = df.groupBy(spec.entity).agg(F.min(F.to_date(spec.time)).alias("a"),
                                       F.max(F.to_date(spec.time)).alias("b"))
    return ends.select(spec.entity, F.explode(
        F.sequence("a", F.date_add("b", periods), F.expr("interval 1 day"))).alias("ds"))


def future_spine(df: DataFrame, spec: PanelSpec, periods: int) -> DataFrame:
    """The ``periods`` days after each entity's last reading."""
    ends = df.groupBy(spec.entity).agg(F.max(F.to_date(spec.time)).alias("b"))
    return ends.select(spec.entity, F.explode(
        F.sequence(F.date_add("b", 1), F.date_add("b", periods), F.expr("interval 1 day"))
    ).alias("ds"))


def one_of(column: Column | str, values: Sequence[str]) -> Column:
    return S._col(column).isin(list(values))
