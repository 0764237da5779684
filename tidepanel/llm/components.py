"""Connected components of a link table, without gathering links or groups anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.session import materialise


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id reachable.

    Each round hangs the neighbours of an id, and the id, on the smallest of them, first over
    larger neighbours, then over smaller ones. Stars form in a number of rounds that grows
    with the logarithm of a component's size. Minima combine before the shuffle, so an id with
    many links is no hot group; every round is written to the shared folder, which cuts the
    lineage. Links with a null end and links of an id to itself count for nothing.

    After ``rounds``, where given, it stops: ids with one component are connected then, but
    ids of different ones may be too.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edges, done = edges.distinct(), 0
    while rounds is None or done < rounds:
        edges, done = materialise(_round(edges), "edges"), done + 1
        if _stars(edges):
            break
    hung = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    centers = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return hung.unionAll(centers.join(hung.select("id"), "id", "left_anti"))


def _pair(a: str, b: str) -> Column:
    return F.struct(F.col(a).alias("a"), F.col(b).alias("b"))


def _round(edges: DataFrame) -> DataFrame:
    """Both ways of a link come from one row: a union would plan everything below it twice."""
    both = edges.select(F.inline(F.array(_pair("a", "b"), _pair("b", "a"))))
    least = both.groupBy(F.col("a").alias("k")).agg(F.least(F.min("b"), F.col("k")).alias("m"))
    large = (both.where("b > a").join(least, F.col("a") == F.col("k"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    own = large.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
    small = large.join(own, F.col("a") == F.col("k"))
    return small.select(F.inline(F.array(_pair("a", "m"), _pair("b", "m")))).where("a <> b").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every id hangs on one other that hangs on nothing."""
    end = lambda c, up: F.struct(F.col(c).alias("id"), F.lit(up).alias("up"), F.lit(1 - up).alias("down"))
    ends = edges.select(F.inline(F.array(end("a", 1), end("b", 0))))
    found = ends.groupBy("id").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return found.where("up > 1 or (up > 0 and down > 0)").isEmpty()
