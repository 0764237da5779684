"""Pairwise-complete Pearson correlation by mergeable aggregates in one pass."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.panel import REPORTED, PanelSpec, present
from tidepanel.session import materialise


def _moments(batches: Iterator[pa.RecordBatch], shift: list[float]) -> Iterator[pa.RecordBatch]:
    """Sums over a task's rows for each pair (i <= j) of columns: rows that have both, their two
    values, squares and product, all after the shift. One matrix product each."""
    k = len(shift)
    total = np.zeros((6, k, k))
    for batch in batches:
        columns = [c.cast(pa.float64()) for c in batch.columns]
        known = np.column_stack([np.asarray(c.is_valid()) for c in columns]).astype(np.float64)
        v = np.column_stack([np.asarray(c.fill_null(s)) - s for c, s in zip(columns, shift)])
        first, square = v.T @ known, (v * v).T @ known
        total += np.array([known.T @ known, first, first.T, square, square.T, v.T @ v])
    i, j = np.triu_indices(k)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i * k + j, pa.int32()), *[pa.array(t[i, j]) for t in total]], names=["i", *_SUMS])


# Up to so many ranked values are sent to every task, or held by a task of a shuffled join.
TRAVEL = 1 << 16
HELD = 1 << 21
_SUMS = ("n", "x", "y", "xx", "yy", "xy")


def correlation_pairs(df: DataFrame, measures: Sequence[str] = REPORTED) -> DataFrame:
    """(a, b, r) for every ordered pair, the diagonal included.

    A task multiplies its batches' value and presence matrices and hands on a row per pair of
    columns. Values are taken relative to those of some row, which keeps the sums small.
    """
    got = present(df, measures)
    k = len(got)
    values = df.select(*[F.col(c).cast("double").alias(c) for c in got])
    some = values.head(1)
    shift = [float(v) if v is not None and math.isfinite(v) else 0.0 for v in some[0]] if some else [0.0] * k
    sums = values.mapInArrow(lambda b: _moments(b, shift), "i int, " + ", ".join(f"{c} double" for c in _SUMS))
    s = sums.groupBy("i").agg(*[F.sum(c).alias(c) for c in _SUMS])
    spread = lambda a, b, ab: F.col(ab) - F.col(a) * F.col(b) / F.col("n")
    # Below the rounding of the sums there is no spread: a constant correlates with nothing.
    square = lambda a, aa: F.when(spread(a, a, aa) > F.lit(1e-13) * F.col(aa), spread(a, a, aa))
    r = spread("x", "y", "xy") / F.sqrt(square("x", "xx") * square("y", "yy"))
    name = lambda place: F.element_at(F.array(*[F.lit(c) for c in got]), place.cast("int") + 1)
    named = s.where("n > 0").select(name(F.floor(F.col("i") / k)).alias("p"), name(F.col("i") % k).alias("q"), "n",
                                    F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))
    same = F.col("p") == F.col("q")
    r = F.when(~same, F.col("r")).when(F.col("n") > 1, F.lit(1.0)).alias("r")
    cell = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"), r)
    both = F.when(same, F.array(cell("p", "q"))).otherwise(F.array(cell("p", "q"), cell("q", "p")))
    return named.select(F.inline(both))


def correlation_matrix(df: DataFrame, measures: Sequence[str] = REPORTED,
                       digits: int = 3) -> DataFrame:
    """The pairs as a square table, rounded."""
    got = present(df, measures)
    wide = correlation_pairs(df, got).groupBy(F.col("a").alias("measure")).pivot("b", got)
    return wide.agg(F.round(F.first("r"), digits))


def correlation_with_target(df: DataFrame, target: str, regressors: Sequence[str]) -> DataFrame:
    """(regressor, r), highest first."""
    got = present(df, regressors)
    one = df.agg(*[F.corr(F.col(target), F.col(c)).alias(c) for c in got])
    return one.unpivot([], got, "regressor", "r").orderBy(F.col("r").desc_nulls_last(), "regressor")


def correlation_stability(df: DataFrame, spec: PanelSpec, regressors: Sequence[str],
                          cutoff: str, tolerance: float = 0.1) -> DataFrame:
    """Correlation with the target before and since a cutoff, and whether it held."""
    got = present(df, regressors)
    first = F.col(spec.time) < F.lit(cutoff).cast(df.schema[spec.time].dataType)
    side = lambda keep, c: F.corr(F.when(keep, F.col(spec.target)), F.when(keep, F.col(c)))
    one = df.agg(*[side(keep, c).alias(f"{c}|{part}") for c in got
                   for part, keep in (("train", first), ("test", ~first))])
    long = one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("regressor"), F.col(f"{c}|train").alias("train_r"),
        F.col(f"{c}|test").alias("test_r")) for c in got])))
    diff = F.abs(F.col("train_r") - F.col("test_r"))
    return long.select("*", diff.alias("diff"),
                       F.when(diff < tolerance, "Stable").otherwise("Unstable").alias("status"))


def spearman_pairs(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(a, b, rho) over rows where both are known, by average ranks; NULL without spread.

    A measure has the same ranks in all its pairs with measures that lack no row. So its values
    are counted and ranked once among all rows, and once more for each measure with gaps. Then
    the ranks join the rows, measure by measure, and one pass sums the products of all pairs.
    """
    got = present(df, measures)
    pairs = list(combinations(range(len(got)), 2))
    rows = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(got)])
    total, *known = rows.agg(F.count(F.lit(1)), *[F.count(c) for c in rows.columns]).first()
    gaps = [i for i, n in enumerate(known) if n < total]
    among = [gaps.index(i) + 1 if i in gaps else 0 for i in range(len(got))]
    counted = [F.lit(1).alias("n0"), *[F.col(f"v{g}").isNotNull().cast("int").alias(f"n{among[g]}") for g in gaps]]
    n = [f"n{s}" for s in range(len(counted))]
    each = rows.select(*counted, F.inline(F.array(*[
        F.struct(F.lit(i).alias("measure"), F.col(c).alias("value")) for i, c in enumerate(rows.columns)])))
    counts = each.where("value is not null").groupBy("measure", "value").agg(*[F.sum(c).alias(c) for c in n])
    ranks = materialise(group_ranks(counts, ["measure"], n), "ranks")
    spread = {r["measure"]: r for r in ranks.groupBy("measure").agg(
        F.count(F.lit(1)).alias("values"),
        *[F.sum(F.col(c) * F.col(f"rank_{c}") * F.col(f"rank_{c}")).alias(c) for c in n]).collect()}
    rank = lambda i, j: f"r{i}_{among[j]}"  # noqa: E731  the column of i's ranks among the rows that know j
    # Ranks of many values are shuffled, while the rows are narrow; others travel to the rows.
    held = HELD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for i in sorted(spread, key=lambda i: -spread[i]["values"]):
        sets = sorted({among[j] for j in range(len(got)) if j != i})
        of = ranks.where(F.col("measure") == i).select(
            F.col("value").alias(f"v{i}"), *[F.col(f"rank_n{s}").alias(f"r{i}_{s}") for s in sets])
        values = spread[i]["values"]
        way = "broadcast" if values <= TRAVEL else "shuffle_hash" if values <= held else "merge"
        rows = rows.join(of.hint(way), f"v{i}", "left").drop(f"v{i}")
    both = [(i, j) for i, j in pairs if i in spread and j in spread]
    sums = rows.agg(F.lit(0).alias("_"), *[
        F.sum(F.col(rank(i, j)) * F.col(rank(j, i))).alias(f"s{i}_{j}") for i, j in both])

    def rho(i: int, j: int):
        if (i, j) not in both:
            return F.lit(None).cast("double")
        square = F.lit(spread[i][n[among[j]]]) * F.lit(spread[j][n[among[i]]])
        return F.col(f"s{i}_{j}") / F.nullif(F.sqrt(square), F.lit(0.0))

    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(got[i]).alias("a"), F.lit(got[j]).alias("b"), rho(i, j).alias("rho")) for i, j in pairs])))


def group_ranks(counts: DataFrame, keys: Sequence[str], among: Sequence[str]) -> DataFrame:
    """(keys..., value, and for each count c of ``among``: c, rank_c), a row for each value of a group.

    ``rank_c`` is the average rank within the group, where the value occurs ``c`` times, less the
    mean of all ranks, which keeps sums of products small. Groups and values are dealt by ranges,
    so a large group lies in many; the sizes of a group's earlier ranges are added to the ranks
    within one.
    """
    keys = list(keys)
    ranged = materialise(counts.repartitionByRange(*keys, "value")
                         .withColumn("_range", F.spark_partition_id()), "ranges")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*keys)
    starts = ranged.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_{c}") for c in among]).select(
        *keys, "_range", *[x for c in among for x in (
            F.coalesce(F.sum(f"_{c}").over(before(group.orderBy("_range"))), F.lit(0)).alias(f"_start_{c}"),
            F.sum(f"_{c}").over(group).alias(f"_all_{c}"))])
    within = before(Window.partitionBy(*keys, "_range").orderBy("value"))
    inner = ranged.withColumns({f"_inner_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in among})
    rank = lambda c: F.col(f"_start_{c}") + F.col(f"_inner_{c}") + (F.col(c) - F.col(f"_all_{c}")) / 2
    return inner.join(starts, [*keys, "_range"]).select(
        *keys, "value", *among, *[rank(c).alias(f"rank_{c}") for c in among])
