"""The driver tables as panels. Column roles follow the library's defaults."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.functions import scalars as S
from tidepanel.operators import windows as W
from tidepanel.operators.evaluation import evaluate
from tidepanel.panel import PanelSpec, daily_panel
from tidepanel.session import materialise

PANEL = PanelSpec()
SERIES = PanelSpec(time="ds", target="y")
HOURS = PanelSpec(time="datetime")
EVENTS = PanelSpec(time="datetime", tie_break=("event_id",))
# Raw events are laid out in blocks; an entity has a few thousand of them a day.
EVENT_BLOCKS = EVENTS.with_(block_seconds=86_400)
MEASURES = ["pm2_5", "pm10", "no2", "co", "so2", "o3", "aqi"]
CUTOFF = "2000-01-01"


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        """Readings per shipped line: three entities, so each holds a third of all rows."""
        aqi = F.col("l_extendedprice") / 200.0
        zero_is_null = lambda c: F.lit(100.0) * F.nullif(F.col(c), F.lit(0.0))
        bucket = (F.when(F.col("l_discount") == 0, F.lit(None))
                  .when(F.col("l_linenumber") == 7, S.aqi_bucket(aqi + 100.0))
                  .otherwise(S.aqi_bucket(aqi)))
        part = (F.col("l_suppkey") % 4)
        return self.raw("lineitem").select(
            F.col("l_returnflag").alias("city"), F.col("l_shipdate").alias("date"),
            aqi.alias("aqi"), F.col("l_quantity").alias("pm2_5"),
            (F.col("l_quantity") + F.lit(1000.0) * F.col("l_tax")).alias("pm10"),
            zero_is_null("l_discount").alias("no2"), zero_is_null("l_tax").alias("co"),
            (F.col("l_extendedprice") / 1000.0).alias("so2"),
            F.col("l_linenumber").cast("double").alias("o3"), bucket.alias("aqi_bucket"),
            (part == 0).alias("is_synthetic"),
            F.concat(F.lit("source"), part.cast("string")).alias("data_source"),
            F.col("l_shipdate").alias("ingested_at"), F.col("l_suppkey").alias("station_id"))

    @cached_property
    def daily(self) -> DataFrame:
        """One row per entity and day of ``lines``."""
        return daily_panel(self.lines, PANEL, MEASURES, digits=6)

    @cached_property
    def series(self) -> DataFrame:
        """One series (city, ds, y) per order priority."""
        rows = self.raw("orders").select(
            F.col("o_orderpriority").alias("city"), F.to_date("o_orderdate").alias("ds"),
            (F.col("o_totalprice") / 1000.0).alias("y"))
        return daily_panel(rows, SERIES, ["y"], digits=6).withColumnRenamed("date", "ds")

    @cached_property
    def stored_series(self) -> DataFrame:
        """``series`` written once, for flows that read it several times."""
        return materialise(self.series, "series")

    @cached_property
    def readings(self) -> DataFrame:
        """Irregular readings per event type."""
        k = F.get_json_object("props", "$.k").cast("bigint")
        return self.raw("events").select(
            F.col("event_type").alias("city"), F.col("ts").alias("datetime"), "event_id",
            "user_id", F.col("value").alias("pm2_5"), S.pm25_to_aqi("value").alias("aqi"),
            k.alias("k"))

    @cached_property
    def hourly(self) -> DataFrame:
        """Hourly means of the readings."""
        mean = lambda c: F.round(F.avg(c) + F.lit(1e-9), 6).alias(c)
        return self.readings.groupBy("city", F.date_trunc("hour", "datetime")
                                     .cast("timestamp_ntz").alias("datetime")) \
            .agg(mean("pm2_5"), mean("aqi"))

    @cached_property
    def predictions(self) -> DataFrame:
        """Two baselines on ``series`` since the cutoff."""
        return W.moving_average(self.series, SERIES, CUTOFF).unionByName(
            W.seasonal_naive(self.series, SERIES, CUTOFF))

    @cached_property
    def metrics(self) -> DataFrame:
        return evaluate(self.predictions, ["city", "model"])
