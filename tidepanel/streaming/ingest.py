"""Continuous form of the append: provenance and one stored row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidepanel.panel import PanelSpec
from tidepanel.sources.sinks import append_unique, key_of, stamp


def file_source(spark: SparkSession, folder: str, schema, names: str = "*.parquet") -> DataFrame:
    """Parquet files arriving in a folder under matching names."""
    return spark.readStream.schema(schema).option("pathGlobFilter", names).parquet(folder)


def ingest(rows: DataFrame, spec: PanelSpec, path: str, state: str, data_source: str,
           is_synthetic: bool = False) -> StreamingQuery:
    """Append each micro-batch's new keys.

    The stored table decides what is new, so no reading is dropped for being late, state
    does not grow, and a batch repeated after a failure adds nothing.
    """
    key = [*key_of(spec), *spec.tie_break]

    def store(batch: DataFrame, _: int) -> None:
        append_unique(batch, path, key, spec.time)

    return (stamp(rows, data_source, is_synthetic).writeStream.foreachBatch(store)
            .option("checkpointLocation", state).trigger(availableNow=True).start())


def run_available(query: StreamingQuery) -> None:
    """Process what has arrived, then stop."""
    query.awaitTermination()
