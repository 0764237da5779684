"""Runs of words against a plain search over all periods."""

import hashlib
import os
import re
import zlib

import numpy as np
import pytest

from tests.conftest import SF, frame
from tidepanel.llm.periodic_runs import find_runs, periodic_runs
from tidepanel.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    """(start, length, period): for each period, the stretches of words equal to the one a period later."""
    w, out = np.array(w, dtype=object), []
    for p in range(1, len(w) // 4 + 1):
        same = np.concatenate([[False], w[:-p] == w[p:], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(turns[::2], turns[1::2]):
            if e - s + p >= max(6, 4 * p) and not any((w[s:e + p - q] == w[s + q:e + p]).all() for q in range(1, p)):
                out.append((int(s), int(e - s + p), p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), best[0], best[1], best[2], 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("seed", range(6))
def test_equal_to_all_periods(seed):
    rng = np.random.default_rng(seed)
    docs = []
    for _ in range(150):
        n, letters = int(rng.integers(0, 150)), int(rng.integers(1, 6))
        w = list(rng.integers(0, letters, n))
        for _ in range(int(rng.integers(0, 4))):  # stretches of some period, with edits
            at, p = int(rng.integers(0, n + 1)), int(rng.integers(1, 30))
            w[at:at + p * 6] = list(np.resize(rng.integers(0, letters, p), int(rng.integers(1, 7 * p))))
        docs.append([int(x) for x in w])
    got = find_runs(np.array([x for d in docs for x in d], np.int64), [len(d) for d in docs])
    assert got == [plain_runs(d) for d in docs]
    assert sum(map(len, got)) > 100


def test_long_periods():
    w = np.concatenate([np.arange(5000), np.resize(np.arange(7000, 7777), 4 * 777), np.zeros(20_000, int)])
    assert find_runs(w, [len(w)]) == [[(5000, 3108, 777), (8108, 20_000, 1)]]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert got == {r.doc_id: plain_row(r.doc_id, r.text) for r in docs}
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in got)


def test_odd_rows(spark):
    loop = "a b " * 3 + "c"
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (None, loop, None), (4, loop, "x"), (4, loop, "x"),
            (5, "é x " * 9, "x"), (6, "w " * 50_000, "x")]
    df = frame(spark, rows, "doc_id long, text string, runs string")
    got = {}
    for r in periodic_runs(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    runs = {i: [[tuple(x) for x in r.runs] for r in rs] for i, rs in got.items()}
    assert runs == {1: [[]], 2: [[]], 3: [[]], None: [[]], 4: [[], []], 5: [[(0, 9, 1)]], 6: [[(0, 50_000, 1)]]}
    assert got[4][0].collapsed == "a b a b a b c" and got[6][0].collapsed == "w" and got[1][0].collapsed == ""
    assert periodic_runs(df.limit(0)).count() == 0
