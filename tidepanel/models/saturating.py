"""Seasonal-trend regression whose trend saturates, fitted on the scale of the target.

The target's share of the range from floor to cap is a logistic curve of a piecewise-linear
trend, plus waves and regressors. Each step replaces the curve by its tangent at the current
coefficients: a regression of a working response on the design times the curve's slope, with
the same sums over stretches and the same penalties as the plain model. All entities take the
same number of steps, each one pass. An entity whose last step made its fit worse goes back
half of it; the best coefficients met count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.models import trend
from tidepanel.models.trend import TrendModel
from tidepanel.panel import PanelSpec
from tidepanel.session import materialise


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)


def _curve(rows: DataFrame, m: TrendModel, theta: str) -> DataFrame:
    """Adds ``_d`` (the design), ``_s`` (the curve) and ``_f`` (the prediction's share)."""
    p, rest = m.trends, len(m.names) - m.trends
    rows = rows.withColumn("_d", trend._design(m))
    rows = rows.withColumn("_s", 1 / (1 + F.exp(-_dot(F.slice("_d", 1, p), F.slice(theta, 1, p)))))
    more = _dot(F.slice("_d", p + 1, rest), F.slice(theta, p + 1, rest)) if rest else F.lit(0.0)
    return rows.withColumn("_f", F.col("_s") + more)


def fit(train: DataFrame, spec: PanelSpec, m: TrendModel, keys: Sequence[str]) -> DataFrame:
    """One row per group: coefficients (of the trend on the logit scale, of the rest in shares),
    residual deviation, mean change and scaling columns."""
    keys = list(keys)
    low = m.floor or 0.0
    rows = train.where(F.col("y").isNotNull()).dropna(subset=list(m.regressors) or ["y"])
    scaling = trend._scaling(rows, m, keys)
    start = trend.fit(rows, spec, replace(m, steps=0, order=0, regressors=()), keys)
    scaled = F.transform("beta", lambda b: b * F.col("_scale"))
    zeros = F.array(*[F.lit(0.0)] * (len(m.names) - m.trends)) if len(m.names) > m.trends else F.array().cast("array<double>")
    state = start.select(*keys, "n", F.concat(scaled, zeros).alias("theta")).join(scaling, keys)
    nothing = F.lit(None).cast("array<double>")
    state = materialise(state.withColumns({
        "best": nothing, "least": F.lit(float("inf")), "sigma": F.lit(0.0)}), "curve")
    stretch = F.floor(F.unix_date(F.to_date("ds")) / trend.STRETCH_DAYS)
    narrow = rows.select(*keys, "ds", ((F.col("y") - low) / (m.cap - low)).alias("_v"), *m.regressors)
    for _ in range(m.steps):
        at = _curve(narrow.join(state, keys).repartition(*keys, stretch), m, "theta")
        slope = F.col("_s") * (1 - F.col("_s"))
        tangent = F.concat(F.transform(F.slice("_d", 1, m.trends), lambda x: x * slope),
                           F.slice("_d", m.trends + 1, max(1, len(m.names) - m.trends)))
        at = at.select(*keys, tangent.alias("_j"), "theta", (F.col("_v") - F.col("_f")).alias("v"))
        response = F.col("v") + _dot(F.col("_j"), F.col("theta"))
        sums = trend.summed(at.select(*keys, F.concat("_j", F.array(response)).alias("design"), "v"), keys)
        total = sums.groupBy(*keys).agg(
            vector_to_array(Summarizer.sum(array_to_vector(F.col("sums")))).alias("sums"))
        moved = total.join(state, keys).withColumn("s", _step(m)("sums", "n", "theta", "best", "least", "sigma"))
        kept = [c for c in state.columns if c not in ("theta", "best", "least", "sigma")]
        state = materialise(moved.select(*kept, "s.*"), "curve")
    changes = F.transform(F.slice("best", 3, m.changes), F.abs) if m.changes else F.array(F.lit(0.0))
    drift = F.aggregate(changes, F.lit(0.0), lambda t, x: t + x) / max(m.changes, 1)
    return state.select(*keys, "n", F.col("best").alias("beta"), "sigma", drift.alias("drift"),
                        *[c for c in state.columns if c.startswith("_")])


def _step(m: TrendModel):
    ridge, lasso, k = m.ridge(), m.lasso(), len(m.names)

    @F.pandas_udf("struct<theta: array<double>, best: array<double>, least: double, sigma: double>")
    def step(packed: pd.Series, n: pd.Series, theta: pd.Series, best: pd.Series, least: pd.Series,
             sigma: pd.Series) -> pd.DataFrame:
        full = trend.unpacked(packed, k + 2)  # tangent, response, residual
        now = np.vstack(theta.to_numpy())
        cost = full[:, -1, -1] + (ridge * now ** 2 + lasso * np.abs(now)).sum(axis=1)
        new = trend.sparse_changes(full[:, :k, :k], full[:, :k, k], ridge, lasso)
        better = cost <= least.to_numpy()
        old = np.vstack([t if b is None else b for t, b in zip(theta, best)])
        deviation = np.sqrt(np.maximum(full[:, -1, -1], 0) / np.maximum(n.to_numpy(), 1))
        pick = lambda a, b: np.where(better[:, None], a, b)
        return pd.DataFrame({"theta": list(pick(new, (now + old) / 2)), "best": list(pick(now, old)),
                             "least": np.where(better, cost, least), "sigma": np.where(better, deviation, sigma)})

    return step


def predict(coefficients: DataFrame, dates: DataFrame, m: TrendModel, keys: Sequence[str]) -> DataFrame:
    """(keys..., ds, ..., yhat, yhat_lower, yhat_upper), none outside floor and cap."""
    low = m.floor or 0.0
    rows = _curve(dates.join(coefficients, list(keys)), m, "beta")
    slope = F.col("_s") * (1 - F.col("_s"))
    deviation = F.sqrt(F.col("sigma") * F.col("sigma") + slope * slope * trend.trend_variance(m))
    z = NormalDist().inv_cdf(0.5 + m.interval / 2)
    share = lambda x: low + (m.cap - low) * F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    return rows.select(
        *keys, *[c for c in dates.columns if c not in keys], share(F.col("_f")).alias("yhat"),
        share(F.col("_f") - z * deviation).alias("yhat_lower"), share(F.col("_f") + z * deviation).alias("yhat_upper"))
