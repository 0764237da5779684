"""Saved models and the table that lists them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY = ("entity string, model_type string, target string, features array<string>, "
            "path string, size_kb double, trained_at timestamp")


def model_path(root: str, entity: str, model_type: str = "gbt") -> str:
    """Folder of a model; the entity is percent-encoded, so any name is one folder."""
    from urllib.parse import quote

    return f"{root}/models/{model_type}/{quote(entity, safe='')}"


def save_model(spark: SparkSession, root: str, model: PipelineModel, entity: str, target: str,
               features: Sequence[str], model_type: str = "gbt") -> str:
    """Write a model and add its registry row; a later save of the same name supersedes it."""
    row = write_model(spark, root, model, entity, target, features, model_type)
    add_rows(spark, root, [row])
    return row[4]


def write_model(spark: SparkSession, root: str, model: PipelineModel, entity: str, target: str,
                features: Sequence[str], model_type: str = "gbt") -> tuple:
    """Write a model; returns the row that ``add_rows`` takes."""
    path = model_path(root, entity, model_type)
    model.write().overwrite().save(path)
    return entity, model_type, target, list(features), path, _folder_kb(spark, path)


def add_rows(spark: SparkSession, root: str, rows: Sequence[tuple]) -> None:
    """Add rows to the registry in one append; two appends at once would disturb each other."""
    if rows:
        new = spark.createDataFrame(list(rows), REGISTRY.replace(", trained_at timestamp", ""))
        new.withColumn("trained_at", F.current_timestamp()).write.mode("append").parquet(f"{root}/registry")


def _folder_kb(spark: SparkSession, path: str) -> float:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg((F.sum("length") / 1024).alias("kb")).first()["kb"]


def load_model(spark: SparkSession, root: str, entity: str,
               model_type: str = "gbt") -> PipelineModel | None:
    """The saved model, or None when the registry has none."""
    rows = trained_models(spark, root)
    if rows is None:
        return None
    hit = rows.where((F.col("entity") == entity) & (F.col("model_type") == model_type)).first()
    return None if hit is None else PipelineModel.load(hit["path"])


def trained_models(spark: SparkSession, root: str) -> DataFrame | None:
    """Latest row per entity and model type; None before the first save."""
    try:
        rows = spark.read.schema(REGISTRY).parquet(f"{root}/registry")
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # The whole row of the latest save; two in the same moment are told apart by their content.
    row = F.max(F.struct("trained_at", "target", "features", "path", "size_kb")).alias("row")
    return rows.groupBy("entity", "model_type").agg(row).select(
        "entity", "model_type", "row.target", "row.features", "row.path",
        F.round("row.size_kb", 1).alias("size_kb"), "row.trained_at")
