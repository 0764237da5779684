"""Fits of many training ranges of a series from one pass over its rows.

A fold or variant trains on some days of an entity's series, with its own first day, span and
knots. Between two neighbouring knots or range ends every column of its design is linear in the
columns level, day, waves and target, so sums of products of these per *segment* between all
such days serve all folds. A fold's matrix is put together from sums over the segments after a
knot; no row is repeated per fold, and the result is that of the fold's own rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.models import trend
from tidepanel.models.trend import TrendModel
from tidepanel.panel import PanelSpec


def _day(c: str | Column) -> Column:
    return F.unix_date(F.to_date(c)).cast("long")


def _place(edges: str, day: Column) -> Column:
    """How many of the sorted edges are at most ``day``."""
    return F.size(F.filter(edges, lambda e: e <= day))


def fit_ranges(series: DataFrame, ranges: DataFrame, spec: PanelSpec, m: TrendModel,
               keys: Sequence[str]) -> DataFrame:
    """As ``trend.fit`` for the groups (entity, ``keys``...) of ``ranges`` (..., from, until), which
    train on the rows of their entity in any of their ranges. Both ends belong to a range, a NULL
    end is open, the ranges of a group do not overlap. Groups without rows have no fit.

    Regressors and a saturating trend are not linear in the shared columns.
    """
    if m.regressors or m.logistic:
        raise ValueError("ranges share sums only without regressors and cap")
    e, keys = spec.entity, [spec.entity, *keys]
    rows = series.where(F.col("y").isNotNull()).select(e, _day("ds").alias("_day"), F.col("y").cast("double").alias("y"))
    ranges = ranges.select(*keys, F.coalesce(_day("from"), F.lit(-(1 << 40))).alias("_a"),
                           F.coalesce(_day("until") + 1, F.lit(1 << 40)).alias("_b"))
    # Days at which a range starts or has ended; what each group needs of the days between them.
    ends = ranges.groupBy(e).agg(F.array_sort(F.array_union(F.collect_set("_a"), F.collect_set("_b"))).alias("_edges"))
    parts = (rows.join(ends, e).groupBy(e, _place("_edges", F.col("_day")).alias("_part"))
             .agg(F.min("_day").alias("_first"), F.max("_day").alias("_last"), F.max(F.abs("y")).alias("_most")))
    held = F.struct("_a", "_b")
    scaling = (ranges.join(parts, e).where((F.col("_first") >= F.col("_a")) & (F.col("_last") < F.col("_b")))
               .groupBy(*keys).agg(
                   F.collect_set(held).alias("_ranges"), F.min("_first").alias("_from"),
                   (F.max("_last") - F.min("_first")).cast("double").alias("_span"),
                   F.greatest(F.max("_most"), F.lit(1e-9)).alias("_scale")))
    # A hinge is above zero from the first whole day after its knot on.
    reach = F.greatest("_span", F.lit(1.0))
    shares = F.array(*[F.lit(m.change_range * i / (m.changes + 1)) for i in range(1, m.changes + 1)]) \
        if m.changes else F.array().cast("array<double>")
    knots = F.transform(shares, lambda c: F.col("_from") + F.floor(reach * c) + 1)
    bounds = F.flatten(F.transform("_ranges", lambda r: F.array(r["_a"], r["_b"])))
    cut = (scaling.select(e, F.explode(F.concat(knots, bounds)).alias("x")).groupBy(e)
           .agg(F.array_sort(F.collect_set("x")).alias("_edges")))
    origin = rows.groupBy(e).agg(F.min("_day").alias("_origin"))
    years = (F.col("_day") - F.col("_origin")) / F.lit(trend.YEAR)
    waves = [f(F.lit(2 * math.pi * k / trend.YEAR) * F.col("_day").cast("double"))
             for k in range(1, m.order + 1) for f in (F.sin, F.cos)]
    segment = _place("_edges", F.col("_day")).alias("_segment")
    placed = rows.join(cut, e).join(origin, e).repartition(e, F.floor(F.col("_day") / trend.STRETCH_DAYS))
    sums = trend.summed(placed.select(
        e, segment, F.array(F.lit(1.0), years, *waves).alias("design"), F.col("y").alias("v")), [e, "_segment"])
    total = sums.groupBy(e, "_segment").agg(
        vector_to_array(Summarizer.sum(array_to_vector(F.col("sums")))).alias("sums"))
    by_entity = (total.groupBy(e).agg(F.array_sort(F.collect_list(F.struct("_segment", "sums"))).alias("_sums"))
                 .join(cut, e).join(origin, e))
    solved = scaling.join(by_entity, e).select(
        *keys, "_from", "_span", "_scale",
        _assembled(m)("_sums", "_edges", "_origin", "_ranges", "_from", "_span", "_scale").alias("s"))
    return solved.select(*keys, "s.*", F.date_from_unix_date(F.col("_from").cast("int")).alias("_t0"), "_span", "_scale")


def _assembled(m: TrendModel):
    shares = [m.change_range * i / (m.changes + 1) for i in range(1, m.changes + 1)]
    width = 3 + 2 * m.order  # level, day, waves, target
    rows, columns = np.triu_indices(width)

    def matrix(sums, edges, origin, ranges, first, span, scale) -> np.ndarray:
        part = np.zeros((len(edges) + 1, width, width))
        for s in sums:
            part[s["_segment"], rows, columns] = part[s["_segment"], columns, rows] = s["sums"]
        starts = np.concatenate([[-np.inf], edges])  # the day a segment starts with
        inside = np.zeros(len(starts), bool)
        for r in ranges:
            inside |= (starts >= r["_a"]) & (starts < r["_b"])
        # Sums over the segments of the ranges from each segment on.
        after = np.cumsum((part * inside[:, None, None])[::-1], axis=0)[::-1]
        reach = max(span, 1.0)
        knots = [first + reach * c for c in shares]
        since = [0] + [int(np.searchsorted(starts, math.floor(k) + 1)) for k in knots]
        # Columns of the design over (level, day, waves, target): t and the hinges in spans.
        line = lambda day: np.concatenate([[-(day - origin) / reach, trend.YEAR / reach], np.zeros(width - 2)])
        unit = np.eye(width)
        plain = [unit[0], line(first), *unit[2:width - 1], unit[width - 1] / scale]
        bent = [line(k) for k in knots]
        base = np.array(plain)
        out = np.zeros((len(base) + len(bent),) * 2)
        n = len(base)
        out[:n, :n] = base @ after[0] @ base.T
        for j, a in enumerate(bent):
            out[n + j, :n] = out[:n, n + j] = base @ (after[since[j + 1]] @ a)
            for i in range(j + 1):  # both hinges are above zero after the later knot
                out[n + i, n + j] = out[n + j, n + i] = bent[i] @ after[since[j + 1]] @ a
        order = [0, 1, *range(n, n + len(bent)), *range(2, n)]
        return out[np.ix_(order, order)]

    @F.pandas_udf("struct<n: double, beta: array<double>, sigma: double, drift: double>")
    def assemble(sums: pd.Series, edges: pd.Series, origin: pd.Series, ranges: pd.Series, first: pd.Series,
                 span: pd.Series, scale: pd.Series) -> pd.DataFrame:
        full = np.array([matrix(*x) for x in zip(sums, edges, origin, ranges, first, span, scale)])
        out = trend.solution(full.reshape(-1, len(m.names) + 1, len(m.names) + 1), m)
        out.insert(0, "n", full[:, 0, 0] if len(full) else np.zeros(0))
        return out

    return assemble
