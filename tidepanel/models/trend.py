"""Seasonal-trend regression for every entity at once.

A series is a piecewise-linear trend plus yearly sine and cosine pairs, and optional
regressors. The narrow rows are dealt by entity and stretch of years, so a long series
spreads over its stretches. Each row's design vector is a column expression; a task adds its
outer products up to one sum per entity and stretch, Spark adds those by entity, and a small
system per entity gives the coefficients. The number of sums follows the entities and
their stretches, not the tasks. Prediction is column arithmetic.

Changes of the slope have a Laplace prior, so most of them are exactly zero; level, slope, waves
and regressors have a normal one. Beyond the last day the slope may change again, as often as
the model has changes and by as much as they are on average, which widens the bounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.models.sparse import sparse_changes
from tidepanel.panel import PanelSpec

YEAR = 365.25
# Rows a task gathers per step, and sums it holds before handing them on.
HELD_ROWS = 50_000
FLUSH = 2048
# Days of a series that one task adds up.
STRETCH_DAYS = 3653


@dataclass(frozen=True)
class TrendModel:
    """Settings; defaults are yearly order 10, 25 trend changes, change scale 0.05, 80 % bounds.

    A ``cap`` makes the trend a saturating curve, fitted in ``steps`` passes; with 0 steps all
    terms are fitted on the logit scale instead.
    """

    order: int = 10
    changes: int = 25
    change_range: float = 0.8
    change_scale: float = 0.05
    interval: float = 0.8
    floor: float | None = None
    cap: float | None = None
    regressors: tuple[str, ...] = ()
    # Prior scales of the other coefficients and of the noise, in units of the scaled target.
    season_scale: float = 10.0
    level_scale: float = 5.0
    noise: float = 0.1
    steps: int = 6

    @property
    def logistic(self) -> bool:
        return self.cap is not None

    @property
    def names(self) -> list[str]:
        pairs = [f"{f}{k}" for k in range(1, self.order + 1) for f in ("sin", "cos")]
        return ["level", "slope", *[f"change{i}" for i in range(1, self.changes + 1)], *pairs,
                *self.regressors]

    @property
    def trends(self) -> int:
        """Coefficients of the trend, which come first."""
        return 2 + self.changes

    def ridge(self) -> np.ndarray:
        """Weights of the squared coefficients; hardly any for changes."""
        rest = [self.season_scale] * (2 * self.order + len(self.regressors))
        square = lambda scales: (self.noise / np.array(scales)) ** 2
        return np.concatenate([square([self.level_scale] * 2), np.full(self.changes, 1e-9), square(rest)])

    def lasso(self) -> np.ndarray:
        """Weights of the absolute coefficients: changes only."""
        out = np.zeros(len(self.names))
        out[2:self.trends] = 2 * self.noise ** 2 / self.change_scale
        return out


def _link(m: TrendModel, y: Column) -> Column:
    if not m.logistic:
        return y
    low = m.floor or 0.0
    share = F.least(F.greatest((y - low) / (m.cap - low), F.lit(1e-3)), F.lit(1 - 1e-3))
    return F.log(share / (1 - share))


def _unlink(m: TrendModel, v: Column) -> Column:
    if not m.logistic:
        return v
    low = m.floor or 0.0
    return low + (m.cap - low) / (1 + F.exp(-v))


def _design(m: TrendModel) -> Column:
    """The design vector from ``ds`` and the scaling columns ``_t0``, ``_span``."""
    days = F.datediff(F.to_date("ds"), F.lit("1970-01-01").cast("date")).cast("double")
    t = time_of(m)
    hinges = [F.greatest(t - F.lit(m.change_range * i / (m.changes + 1)), F.lit(0.0))
              for i in range(1, m.changes + 1)]
    waves = [f(F.lit(2 * math.pi * k / YEAR) * days)
             for k in range(1, m.order + 1) for f in (F.sin, F.cos)]
    extra = [(F.col(r) - F.col(f"_mu_{r}")) / F.col(f"_sd_{r}") for r in m.regressors]
    return F.array(F.lit(1.0), t, *hinges, *waves, *extra)


def _scaling(train: DataFrame, m: TrendModel, keys: Sequence[str]) -> DataFrame:
    """First day, span, target scale and regressor moments per group."""
    day = F.to_date("ds")
    mean_sd = []
    for r in m.regressors:
        sd = F.stddev_samp(r)
        mean_sd += [F.avg(r).alias(f"_mu_{r}"),
                    F.when(sd > 0, sd).otherwise(F.lit(1.0)).alias(f"_sd_{r}")]
    return train.groupBy(*keys).agg(
        F.min(day).alias("_t0"),
        F.datediff(F.max(day), F.min(day)).cast("double").alias("_span"),
        F.greatest(F.max(F.abs(_link(m, F.col("y")))), F.lit(1e-9)).alias("_scale"),
        *mean_sd)


def _partial_sums(keys: Sequence[str]):
    """Packed sums of outer products of (design, y) per group, over a task's rows."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        held: list[pd.DataFrame] = []

        def take():
            pdf = pd.concat(held) if len(held) > 1 else held[0]
            held.clear()
            group = pdf.groupby(list(keys), sort=False).ngroup().to_numpy()
            order = np.argsort(group, kind="stable")
            x = np.column_stack([np.vstack(pdf["design"].to_numpy()), pdf["v"].to_numpy()])[order]
            names = pdf[list(keys)].to_numpy()[order]
            starts = np.flatnonzero(np.diff(group[order], prepend=-1))
            upper = np.triu_indices(x.shape[1])
            for i, j in zip(starts, [*starts[1:], len(x)]):
                key, packed = tuple(names[i]), (x[i:j].T @ x[i:j])[upper]
                sums[key] = sums[key] + packed if key in sums else packed
                if len(sums) >= FLUSH:
                    yield drain()

        def drain():
            rows = [(*k, v) for k, v in sums.items()]
            sums.clear()
            return pd.DataFrame(rows, columns=[*keys, "sums"])

        for pdf in batches:
            if len(pdf):
                held.append(pdf)
            if sum(map(len, held)) >= HELD_ROWS:
                yield from take()
        if held:
            yield from take()
        if sums:
            yield drain()
    return add


def unpacked(packed: pd.Series, k: int) -> np.ndarray:
    """Symmetric matrices from their packed upper triangles."""
    full = np.zeros((len(packed), k, k))
    rows, columns = np.triu_indices(k)
    full[:, rows, columns] = full[:, columns, rows] = np.vstack(packed.to_numpy())
    return full


def solution(full: np.ndarray, m: TrendModel) -> pd.DataFrame:
    """Coefficients, residual deviation and mean size of a change from sums of (design, v)."""
    gram, xy, yy = full[:, :-1, :-1], full[:, :-1, -1], full[:, -1, -1]
    beta = sparse_changes(gram, xy, m.ridge(), m.lasso())
    rest = yy - 2 * (beta * xy).sum(axis=1) + np.einsum("ni,nij,nj->n", beta, gram, beta)
    sigma = np.sqrt(np.maximum(rest, 0) / np.maximum(gram[:, 0, 0], 1))
    drift = np.abs(beta[:, 2:m.trends]).sum(axis=1) / max(m.changes, 1)
    return pd.DataFrame({"beta": list(beta), "sigma": sigma, "drift": drift})


def _solver(m: TrendModel):
    @F.pandas_udf("struct<beta: array<double>, sigma: double, drift: double>")
    def solve(packed: pd.Series) -> pd.DataFrame:
        return solution(unpacked(packed, len(m.names) + 1), m)

    return solve


def fit(train: DataFrame, spec: PanelSpec, m: TrendModel = TrendModel(),
        keys: Sequence[str] | None = None) -> DataFrame:
    """One row per group: coefficients, residual deviation, mean change and scaling columns.

    ``train`` holds (keys..., ds, y, regressors...). Groups are entities unless ``keys``
    adds, say, a fold.
    """
    keys = list(keys or [spec.entity])
    if m.logistic and m.steps:
        from tidepanel.models import saturating

        return saturating.fit(train, spec, m, keys)
    rows = train.where(F.col("y").isNotNull()).dropna(subset=list(m.regressors) or ["y"])
    scaling = _scaling(rows, m, keys)
    total = partial_sums(rows, scaling, m, keys).groupBy(*keys).agg(
        vector_to_array(Summarizer.sum(array_to_vector(F.col("sums")))).alias("sums"))
    # The first packed entry is the sum of squares of the level column: the row count.
    solved = total.select(*keys, _solver(m)("sums").alias("s"), F.col("sums")[0].alias("n"))
    return solved.select(*keys, "n", "s.*").join(scaling, keys)


def partial_sums(rows: DataFrame, scaling: DataFrame, m: TrendModel, keys: Sequence[str]) -> DataFrame:
    """(keys..., sums): one row per group and stretch of days."""
    stretch = F.floor(F.unix_date(F.to_date("ds")) / STRETCH_DAYS)
    narrow = rows.select(*keys, "ds", "y", *m.regressors).join(scaling, list(keys))
    return summed(narrow.repartition(*keys, stretch).select(
        *keys, _design(m).alias("design"), (_link(m, F.col("y")) / F.col("_scale")).alias("v")), keys)


def summed(designed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., sums) of the rows (keys..., design, v), added up within tasks."""
    schema = T.StructType([*[designed.schema[k] for k in keys],
                           T.StructField("sums", T.ArrayType(T.DoubleType()))])
    return designed.mapInPandas(_partial_sums(keys), schema)


def time_of(m: TrendModel) -> Column:
    """Days since the first, as a share of the span of the training rows."""
    return F.datediff(F.to_date("ds"), F.col("_t0")) / F.greatest(F.col("_span"), F.lit(1.0))


def trend_variance(m: TrendModel) -> Column:
    """Variance of the trend beyond the training rows, in units of the scaled target.

    Changes come at a rate of ``changes`` a span. One of Laplace size ``drift`` has variance
    2 drift^2; made ``u`` before, it has moved the trend by ``u`` times itself. Over a time ``h`` past
    the last row that adds up to the integral of 2 drift^2 changes u^2 from 0 to h.
    """
    h = F.greatest(time_of(m) - F.lit(1.0), F.lit(0.0))
    return F.lit(2.0 * m.changes / 3) * F.col("drift") * F.col("drift") * h * h * h


def predict(coefficients: DataFrame, dates: DataFrame, spec: PanelSpec,
            m: TrendModel = TrendModel(), keys: Sequence[str] | None = None) -> DataFrame:
    """(keys..., ds, ..., yhat, yhat_lower, yhat_upper) for each wanted row."""
    keys = list(keys or [spec.entity])
    if m.logistic and m.steps:
        from tidepanel.models import saturating

        return saturating.predict(coefficients, dates, m, keys)
    joined = dates.join(coefficients, keys)
    # Measured against one long sum of products, which outgrows a compiled method.
    terms = F.zip_with("beta", _design(m), lambda b, x: b * x)
    v = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) * F.col("_scale")
    deviation = F.sqrt(F.col("sigma") * F.col("sigma") + trend_variance(m))
    z = NormalDist().inv_cdf(0.5 + m.interval / 2) * deviation * F.col("_scale")
    out = joined.select(*keys, *[c for c in dates.columns if c not in keys],
                        v.alias("_v"), z.alias("_z"))
    return out.withColumns({
        "yhat": _unlink(m, F.col("_v")),
        "yhat_lower": _unlink(m, F.col("_v") - F.col("_z")),
        "yhat_upper": _unlink(m, F.col("_v") + F.col("_z")),
    }).drop("_v", "_z")


def regressor_effects(coefficients: DataFrame, spec: PanelSpec, m: TrendModel,
                      keys: Sequence[str] | None = None) -> DataFrame:
    """(keys..., regressor, coef, direction): change of the target per unit of a regressor."""
    keys = list(keys or [spec.entity])
    first = len(m.names) - len(m.regressors)
    rows = F.array(*[F.struct(
        F.lit(r).alias("regressor"),
        (F.col("beta")[first + i] * F.col("_scale") / F.col(f"_sd_{r}")).alias("coef"))
        for i, r in enumerate(m.regressors)])
    out = coefficients.select(*keys, F.inline(rows))
    return out.withColumn("direction", F.when(F.col("coef") > 0, "increases").otherwise("decreases"))
