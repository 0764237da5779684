"""Tree regressions and entity groups on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.panel import PanelSpec
from tidepanel.session import materialise

# Default settings of both models.
GBT_PARAMS = {"maxIter": 300, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8,
              "featureSubsetStrategy": "0.8", "seed": 42}
FOREST_PARAMS = {"numTrees": 300, "maxDepth": 12, "minInstancesPerNode": 5, "seed": 42}
MODELS = {"gbt": (GBTRegressor, GBT_PARAMS, "Boosted Trees"),
          "forest": (RandomForestRegressor, FOREST_PARAMS, "Random Forest")}


def fit(train: DataFrame, features: Sequence[str], target: str, kind: str = "gbt",
        params: Mapping[str, object] | None = None) -> PipelineModel:
    """Train on rows without NULL features; the training rows are cached for the fit only."""
    cls, defaults, _ = MODELS[kind]
    learner = cls(featuresCol="features", labelCol=target, predictionCol="yhat",
                  **(defaults | dict(params or {})))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    rows = train.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*features, target])])
    rows = rows.persist()
    try:
        return Pipeline(stages=[assembler, learner]).fit(rows)
    finally:
        rows.unpersist()


def predict(model: PipelineModel, df: DataFrame, spec: PanelSpec, kind: str = "gbt") -> DataFrame:
    """(entity, model, ds, y, yhat) of feature rows."""
    out = model.transform(df)
    return out.select(spec.entity, F.lit(MODELS[kind][2]).alias("model"),
                      F.col(spec.time).alias("ds"), F.col(spec.target).alias("y"), "yhat")


def importances(spark: SparkSession, model: PipelineModel, top: int = 20) -> DataFrame:
    """(feature, importance) of the strongest features."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top)


def linear_effects(train: DataFrame, regressors: Sequence[str], target: str) -> DataFrame:
    """(regressor, coef, direction) of a joint linear fit over complete rows."""
    from pyspark.ml.regression import LinearRegression

    rows = train.select(*regressors, target).dropna()
    rows = VectorAssembler(inputCols=list(regressors), outputCol="features").transform(rows)
    model = LinearRegression(featuresCol="features", labelCol=target).fit(rows)
    found = [(r, float(c)) for r, c in zip(regressors, model.coefficients)]
    out = train.sparkSession.createDataFrame(found, "regressor string, coef double")
    return out.withColumn("direction", F.when(F.col("coef") > 0, "increases").otherwise("decreases"))


def fit_classes(train: DataFrame, features: Sequence[str], label: str,
                params: Mapping[str, object] | None = None) -> PipelineModel:
    """Forest classifier of the index level, by its 1..6 ordinal."""
    from pyspark.ml.classification import RandomForestClassifier

    learner = RandomForestClassifier(featuresCol="features", labelCol=label,
                                     predictionCol="level", seed=42, **dict(params or {}))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, learner]).fit(train)


def typology(profiles: DataFrame, entity: str, columns: Sequence[str], groups: int = 3,
             axes: int = 2) -> DataFrame:
    """Entities grouped by their profile: (entity, group, axes...).

    ``profiles`` has one complete row per entity, such as its mean of each measure; it is
    written once for the four fits and the result that read it.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import vector_to_array

    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True),
        PCA(k=axes, inputCol="scaled", outputCol="axes"),
        KMeans(k=groups, seed=42, featuresCol="axes", predictionCol="group"),
    ]
    kept = materialise(profiles, "profiles")
    out = Pipeline(stages=stages).fit(kept).transform(kept)
    at = vector_to_array("axes")
    return out.select(entity, "group", *[at[i].alias(f"axis{i + 1}") for i in range(axes)])
