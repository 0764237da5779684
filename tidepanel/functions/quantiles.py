"""Grouped quantiles that stay bounded when one group holds most rows.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation
buffer. Here an approximate sketch brackets each wanted rank, and only values in the
bracket are counted and ranked, so the exact answer needs a small part of the group. Groups
of every size take this one path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.session import materialise

# A bracket holds a share of 4 / ACCURACY of its group: 40,000 of a billion values.
ACCURACY = 100_000
# Up to so many brackets travel to the rows. Of more, those of groups of more than HELD values do.
TRAVEL = 1 << 16
HELD = 1 << 20


def melt(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
         name: str = "measure", value: str = "x") -> DataFrame:
    """One row per (row, measure) with a value; a projection, no shuffle."""
    wide = df.select(*keys, *[F.col(m).cast("double").alias(m) for m in measures])
    return wide.unpivot(list(keys), list(measures), name, value).where(F.col(value).isNotNull())


def approx_quantiles(df: DataFrame, by: Sequence[str], measures: Sequence[str],
                     probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """(by..., measure, prob, q) from one pass of mergeable sketches."""
    sketch = F.percentile_approx("x", [float(p) for p in probs], accuracy)
    out = melt(df, by, measures).groupBy(*by, "measure").agg(sketch.alias("qs"))
    cells = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"),
                         F.col("qs").alias("q"))
    return out.select(*by, "measure", F.inline(cells))


def _bracketed(long: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the brackets of their group. A join by group sorts a whole group in one task,
    so only groups of at most HELD values are joined so; large groups are few."""
    if brackets.count() <= TRAVEL:
        return long.join(F.broadcast(brackets), keys)
    large = brackets.where(F.col("n") > HELD)
    small = brackets.where(F.col("n") <= HELD)
    rest = long.join(F.broadcast(large.select(*keys)), keys, "left_anti")
    return long.join(F.broadcast(large), keys).unionByName(rest.join(small, keys))


def exact_quantiles(df: DataFrame, by: Sequence[str], measures: Sequence[str],
                    probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """(by..., measure, prob, q): linear interpolation between order statistics.

    Per wanted rank the sketch gives two bounds around it. Values between the bounds are
    counted and ranked; of those below and above, only the count and the nearest value are
    kept, as a rank may be one beside a bound. A rank further out raises an error.
    The brackets are written first: their number is then known, so that they travel to the rows
    whatever the session's limit of broadcasts, and no task sorts all rows of a large group.
    """
    keys, x = [*by, "measure"], F.col("x")
    probs = sorted(float(p) for p in probs)
    long = melt(df, by, measures)
    slack, k = 2.0 / accuracy, len(probs)
    lows = [max(0.0, p - slack) for p in probs]
    highs = [min(1.0, p + slack) for p in probs]
    sketch = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("x", lows + highs, accuracy).alias("s"))
    lo, hi = [f"lo{i}" for i in range(k)], [f"hi{i}" for i in range(k)]
    brackets = materialise(
        sketch.select(*keys, "n", *[F.col("s")[i].alias(c) for i, c in enumerate(lo + hi)]), "brackets")
    # Values outside all brackets only count: those between the same bounds become one cell.
    reached = sum((x >= F.col(c)).cast("int") for c in lo)
    passed = sum((x > F.col(c)).cast("int") for c in hi)
    inside = F.array_max(F.array(*[(x >= F.col(a)) & (x <= F.col(b)) for a, b in zip(lo, hi)]))
    cells = (
        _bracketed(long, brackets, keys)
        .groupBy(*keys, reached.alias("g1"), passed.alias("g2"), F.when(inside, x).alias("v"))
        .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("x"), F.max("x").alias("top"),
             F.first("n").alias("n"), *[F.first(c).alias(c) for c in lo + hi])
    )
    targets = F.inline(F.array(*[F.struct(
        F.lit(p).alias("prob"), F.col(lo[i]).alias("lo"), F.col(hi[i]).alias("hi"))
        for i, p in enumerate(probs)]))
    side = F.when(x < F.col("lo"), -1).when(x > F.col("hi"), 1).otherwise(0)
    counted = (
        cells.select(*keys, "c", "x", "top", "n", targets).withColumn("side", side)
        .groupBy(*keys, "prob", "n", "side", F.when(F.col("side") == 0, x).alias("v"))
        .agg(F.sum("c").alias("c"), F.min("x").alias("x"), F.max("top").alias("top"))
    )
    ranked = Window.partitionBy(*keys, "prob").orderBy("side", "v")
    upto = F.sum("c").over(ranked.rowsBetween(Window.unboundedPreceding, 0))
    place = (F.col("n") - 1) * F.col("prob")
    first, second = F.floor(place), F.ceil(place)
    stats = counted.withColumn("upto", upto)

    def at(rank):
        held = (F.col("upto") > rank) & (F.col("upto") - F.col("c") <= rank)
        below = (F.col("side") < 0) & (rank == F.col("upto") - 1)
        above = (F.col("side") > 0) & (rank == F.col("upto") - F.col("c"))
        value = (F.when((F.col("side") == 0) | above, x).when(below, F.col("top"))
                 .otherwise(F.raise_error(F.lit("a rank is outside its bracket")).cast("double")))
        return F.max(F.when(held, value))

    out = stats.groupBy(*keys, "prob").agg(
        at(first).alias("a"), at(second).alias("b"), F.max(place - first).alias("f"))
    q = F.col("a") + (F.col("b") - F.col("a")) * F.col("f")
    return out.select(*keys, "prob", q.alias("q"))
