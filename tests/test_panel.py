import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, frame
from tidepanel.operators import windows as W
from tidepanel.panel import PanelSpec, daily_panel, normalise, over_rows

SPEC = PanelSpec()
STAMPED = PanelSpec(time="at", tie_break=("id",))


@pytest.fixture(scope="module")
def skewed(spark):
    """One entity with two thirds of the rows, bursts, long pauses and equal timestamps."""
    rng = random.Random(7)
    rows, n = [], 0
    for city, size in (("hot", 2000), ("b", 700), ("c", 1), ("d", 299)):
        at = dt.datetime(2024, 1, 1)
        for _ in range(size):
            at += dt.timedelta(seconds=rng.choice([0, 1, 1, 60, 3600, 40000]))
            value = None if rng.random() < 0.1 else round(rng.uniform(0, 300), 2)
            rows.append((city, at, n, value))
            n += 1
    rng.shuffle(rows)
    return frame(spark, rows, "city string, at timestamp_ntz, id long, aqi double").cache()


def test_normalise(spark):
    rows = frame(spark, [("a", day(0), float("nan")), (None, day(1), 1.0), ("b", None, 2.0)],
                 "city string, date date, aqi double")
    assert [tuple(r) for r in normalise(rows, SPEC).collect()] == [("a", day(0), None)]


def test_daily_panel_skips_nulls(spark):
    rows = frame(spark, [("a", dt.datetime(2020, 1, 1, 5), 1.0), ("a", dt.datetime(2020, 1, 1, 9), None),
                         ("a", dt.datetime(2020, 1, 1, 23), 3.0)], "city string, at timestamp_ntz, aqi double")
    got = daily_panel(rows, SPEC.with_(time="at"), ["aqi"]).collect()
    assert [tuple(r) for r in got] == [("a", dt.date(2020, 1, 1), 2.0)]


@pytest.mark.parametrize("block_rows, block_seconds", [(40, 3600), (1, 86400), (500, 30), (10_000, 7200)])
def test_blocked_frames_equal_plain_ones(skewed, block_rows, block_seconds):
    def build(w):
        return {"l3": F.lag("aqi", 3).over(w), "n1": F.lead("aqi", 1).over(w),
                "m": F.avg("aqi").over(w.rowsBetween(-6, 0)),
                "c": F.sum("aqi").over(w.rowsBetween(-4, 3))}

    plain = over_rows(skewed, STAMPED, 6, 3, build)
    split = over_rows(skewed, STAMPED.with_(block_rows=block_rows, block_seconds=block_seconds), 6, 3, build)
    cols = ["id", "l3", "n1", *[F.round(c, 6).alias(c) for c in ("m", "c")]]
    a, b = plain.select(*cols), split.select(*cols)
    assert split.count() == skewed.count()
    assert a.exceptAll(b).count() == 0


def test_blocks_need_an_order():
    with pytest.raises(ValueError):
        SPEC.with_(block_seconds=60)


def test_blocked_gaps_equal_plain_ones(skewed):
    a = W.gap_rows(skewed, STAMPED, 2).select("city", "gap_start", "gap_end")
    b = W.gap_rows(skewed, STAMPED.with_(block_seconds=7200), 2).select("city", "gap_start", "gap_end")
    assert a.count() == b.count() > 100
    assert a.exceptAll(b).count() == 0
