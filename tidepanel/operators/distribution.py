"""Tables behind distribution and time charts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import scalars as S
from tidepanel.functions.quantiles import exact_quantiles
from tidepanel.panel import PanelSpec


def period_end(time: Column | str, freq: str) -> Column:
    """Last day of the month ('ME'), week ending Sunday ('W') or quarter ('QE')."""
    d = F.to_date(S._col(time))
    if freq == "ME":
        return F.last_day(d)
    if freq == "W":
        return F.next_day(F.date_sub(d, 1), "SUN")
    if freq == "QE":
        return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    raise ValueError(f"unknown frequency {freq!r}")


def resample_mean(df: DataFrame, spec: PanelSpec, freq: str, metric: str | None = None) -> DataFrame:
    """Mean per entity and period, empty periods between its first and last as NULL."""
    m = metric or spec.target
    got = df.groupBy(spec.entity, period_end(spec.time, freq).alias("period")).agg(
        F.avg(m).alias(m))
    ends = got.groupBy(spec.entity).agg(F.min("period").alias("a"), F.max("period").alias("b"))
    step = {"W": "interval 7 days", "ME": "interval 1 month", "QE": "interval 3 months"}[freq]
    if freq == "W":
        every = F.sequence("a", "b", F.expr(step))
    else:
        first = F.trunc("a", "month")
        every = F.transform(F.sequence(first, F.col("b"), F.expr(step)), lambda d: F.last_day(d))
    spine = ends.select(spec.entity, F.explode(every).alias("period"))
    return spine.join(got, [spec.entity, "period"], "left")


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """(bin, low, high, count, density) over equal bins of the whole column; the maximum is
    in the last bin and empty bins count 0."""
    x = F.col(column).cast("double")
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"),
                           F.count(x).alias("n")).alias("e")).scalar()
    known = df.where(x.isNotNull()).select(x.alias("x"), ends.alias("e"))
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    at = F.floor((F.col("x") - F.col("e.lo")) / F.nullif(width, F.lit(0.0)))
    place = F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int")
    got = known.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
             .withColumn("e", ends))
    out = spine.join(got, "bin", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    low = F.col("e.lo") + F.col("bin") * width
    density = F.col("count") / F.nullif(F.col("e.n") * width, F.lit(0.0))
    return out.select("bin", low.alias("low"), (low + width).alias("high"), "count",
                      density.alias("density"))


def kde_grid(df: DataFrame, column: str, bins: int = 400, points: int = 200) -> DataFrame:
    """(x, density): Gaussian density with Scott's bandwidth on a grid reaching half the
    range beyond both ends. Rows are binned first, so the work past the scan is
    ``bins * points`` whatever the table's size."""
    x = F.col(column).cast("double")
    stats = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"),
                            F.stddev_samp(x).alias("sd")).alias("s")).scalar()
    cells = histogram(df, column, bins).where(F.col("count") > 0).select(
        ((F.col("low") + F.col("high")) / 2).alias("mid"), "count", stats.alias("s"))
    span = F.col("s.hi") - F.col("s.lo")
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    spread = cells.select("mid", "count", "s", grid)
    at = F.col("s.lo") - span * 0.5 + span * 2.0 * F.col("i") / (points - 1)
    h = F.col("s.sd") * F.pow(F.col("s.n").cast("double"), F.lit(-0.2))
    u = (at - F.col("mid")) / h
    mass = F.col("count") * F.exp(-0.5 * u * u) / (F.col("s.n") * h * math.sqrt(2 * math.pi))
    return spread.groupBy("i", at.alias("x")).agg(F.sum(mass).alias("density")).drop("i")


def seasonal_box(df: DataFrame, spec: PanelSpec, metric: str | None = None,
                 calendar=S.FOUR_SEASONS) -> DataFrame:
    """Quartiles and whiskers (furthest readings within 1.5 IQR) per entity and season."""
    m = metric or spec.target
    rows = df.where(F.col(m).isNotNull()).select(
        spec.entity, S.season(spec.time, calendar).alias("season"), F.col(m).alias(m))
    keys = [spec.entity, "season"]
    q = exact_quantiles(rows, keys, [m], [0.25, 0.5, 0.75])
    box = q.groupBy(*keys).agg(*[F.max(F.when(F.col("prob") == p, F.col("q"))).alias(n)
                                 for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    reach = 1.5 * (F.col("p75") - F.col("p25"))
    inside = (F.col(m) >= F.col("p25") - reach) & (F.col(m) <= F.col("p75") + reach)
    ends = rows.join(box, keys).groupBy(*keys, "p25", "p50", "p75").agg(
        F.min(F.when(inside, F.col(m))).alias("whisker_low"),
        F.max(F.when(inside, F.col(m))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))
    return ends


def scatter_pairs(df: DataFrame, spec: PanelSpec, x: str, y: str, fraction: float | None = None,
                  seed: int = 42) -> DataFrame:
    """Rows with both values; ``fraction`` samples them for drawing."""
    out = df.dropna(subset=[x, y]).select(spec.entity, x, y)
    return out if fraction is None else out.sample(fraction, seed)
