"""Hard negatives against all pairs."""

import numpy as np
import pytest

from tests.conftest import frame
from tidepanel.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, q string"


def plain(rows, every=100):
    """(anchor, positive, rank, negative, positive score, negative score) from all pairs."""
    held = {}
    for i, label, v, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        held[i] = min(held.get(i, (str(label), q)), (str(label), q))
    out = set()
    for i, (label, q) in held.items():
        if i % every:
            continue
        score = {j: sum(a * b for a, b in zip(q, w)) for j, (_, w) in held.items() if len(w) == len(q) and j != i}
        first = sorted((-s, j) for j, s in score.items() if held[j][0] == label)[:5]
        for s, p in first:
            fit = sorted((-t, j) for j, t in score.items() if held[j][0] != label and -30 * s <= 100 * t <= -90 * s)
            out |= {(i, p, k + 1, j, -s, -t) for k, (t, j) in enumerate(fit[:10])}
    return out


@pytest.mark.parametrize("shape", ["even", "groups", "ties"])
def test_equal_to_all_pairs(spark, monkeypatch, shape):
    monkeypatch.setattr(H, "SLOT", 300)
    monkeypatch.setattr(H, "RUN", 3)
    monkeypatch.setattr(H, "ROWS", 40)
    monkeypatch.setattr(H, "ANCHORS", 2)
    rng = np.random.default_rng(3)
    n, dim = 1500, 6
    v = rng.normal(0, 1, (n, dim))
    if shape == "groups":
        v = v * 0.1 + rng.normal(0, 2, (4, dim))[rng.integers(0, 4, n)]
    if shape == "ties":
        v = np.round(v)
    label = np.where(rng.random(n) < 0.4, 0, rng.integers(0, 5, n))
    rows = [(int(i), int(l), [float(np.float32(x)) for x in r], "") for i, l, r in zip(range(-100, n - 100), label, v)]
    got = [tuple(r) for r in H.hard_negatives(frame(spark, rows, SCHEMA)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows) and len(got) > 300


def test_windows_leave_rows_out():
    """A block far from an anchor is never scored."""
    import pyarrow as pa

    q = np.concatenate([np.tile([1000, 0], (50, 1)), np.tile([0, 1000], (50, 1))]) + np.arange(200).reshape(100, 2) % 7
    side = H._Side(pa.table({"vec_id": np.arange(100), "label": ["x"] * 100, "q": q.tolist()}), 2, np.eye(2))
    assert len(list(side.blocks(1000))) == 2
    for lo, hi in side.blocks(1000):
        least, most = H._bounds(side, side, slice(0, 100), slice(lo, hi))
        exact = side.q @ side.q[lo:hi].T
        assert (least <= exact.min(axis=1)).all() and (exact.max(axis=1) <= most).all()
        assert (most < 100_000).sum() == 50


def test_odd_rows(spark):
    one, inf = [1.0, 0.5], float("inf")
    rows = [(0, 1, one, None), (1, 1, one, None), (2, 2, [0.6, 0.2], None), (2, 2, [0.6, 0.2], "again"),
            (3, 1, None, None), (4, None, one, None), (None, 1, one, None), (5, 2, [None, 1.0], None),
            (6, 2, [inf, 1.0], None), (7, 2, [float("nan"), 0.0], None), (8, 2, [0.5, 0.5, 0.5], None),
            (9, 1, [0.0, 0.0], None), (10, 2, [], None), (100, 3, [], None), (200, 3, [0.0, 0.0], None)]
    df = frame(spark, rows, SCHEMA)
    got = {tuple(r) for r in H.hard_negatives(df).collect()}
    assert got == plain(rows) and (0, 1, 1, 2, 81920, 45696) in got
    assert H.hard_negatives(df.limit(0)).count() == 0
    huge = [(i, i % 2, [1e9 + i, 3e9], None) for i in range(101)]
    small = {tuple(r) for r in H.hard_negatives(frame(spark, huge, SCHEMA)).collect()}
    assert small == set() or all(30 * r[4] <= 100 * r[5] <= 90 * r[4] for r in small)
