"""Runs of repeating words by string synchronising sets.

A run is a stretch of words with smallest period ``q``, at least ``TIMES * q`` and ``LEAST``
words long, that neither neighbour extends. Texts lie one after the other in an array of word
numbers, with a number of its own between two texts.

At each scale ``t`` = 1, 2, 4, ... a hash picks positions: ``i`` is in the synchronising set
if, of the hashes of the ``t + 1`` substrings of ``t`` words that start in ``[i, i + t]``, the
least is the first or the last. The choice depends on the ``2 t`` words from ``i`` on alone, so
equal contexts are picked alike. In a run of period ``q`` with ``q / 2 < t <= q`` some position
and the one ``q`` later are picked, their contexts are equal, and no equal context lies
between: two neighbours among equal contexts, ``t <= d < 2 t`` apart, propose the period ``d``.

Highly periodic stretches, whose period is at most ``t / 4``, take no part at scale ``t``, so
the set stays sparse. They are runs that smaller scales have already found, which thereby
supply the small periods that the larger scales leave out.

A proposal is compared word by word on both sides, so what comes out is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tidepanel.llm.common import mixed, only, slices, texts

#: A run has at least so many periods, and so many words.
TIMES, LEAST = 4, 6
#: Bytes of text that are searched together.
HELD = 2 << 20
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: minima from the left and from the right of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    held = np.full(-(-len(values) // width) * width, _TOP)
    held[:len(values)] = values
    blocks = held.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _stretch(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The largest [start, end) around ``at`` in which words ``period`` apart are equal."""
    def same(i: int, step: int) -> int:
        """How many neighbours of ``i``, it included, equal the word ``period`` later."""
        n, width = 0, 32
        while True:
            lo, hi = (i + n, min(i + n + width, len(words) - period)) if step > 0 else \
                (max(0, i - n - width + 1), i - n + 1)
            if hi <= lo:
                return n
            equal = words[lo:hi] == words[lo + period:hi + period]
            equal = equal if step > 0 else equal[::-1]
            if not equal.all():
                return n + int(np.argmin(equal))
            n, width = n + len(equal), width * 2

    return at - same(at - 1, -1), at + same(at, 1) + period


def find_runs(words: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, in order. ``words`` holds the texts'
    word numbers, from 0 on, one text of ``sizes`` words after the other."""
    sizes = np.asarray(sizes, np.int64)
    start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]  # a place between two texts
    n = int((sizes + 1).sum())
    codes = np.empty(n, np.int64)
    inner = np.ones(n, bool)
    inner[start + sizes] = False
    codes[inner] = words
    codes[~inner] = -1 - np.arange(len(sizes))  # of each text alone
    found: list[tuple[int, int, int]] = []
    place, size = np.arange(n), np.repeat(sizes, sizes + 1)
    hashes, scale = mixed(codes.view(np.uint64) * np.uint64(2) + np.uint64(1)), 1
    while True:
        # A text of under four times the scale has no run of these periods; the others go on.
        fits = size >= TIMES * scale
        place, size, hashes = place[fits], size[fits], hashes[fits]
        if not len(place):
            break
        found += _at_scale(codes, place, hashes, scale, found)
        hashes, scale = np.append(_pair(hashes[:-scale], hashes[scale:]), np.full(scale, _TOP)), 2 * scale
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    kept = sorted((s, e - s, p) for s, e, p in found if e - s >= LEAST)
    for (s, length, p), k in zip(kept, np.searchsorted(start, [r[0] for r in kept], side="right") - 1):
        out[k].append((int(s - start[k]), int(length), int(p)))
    return out


def _at_scale(codes: np.ndarray, place: np.ndarray, hashes: np.ndarray, scale: int,
              found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of periods in [scale, 2 scale), as [start, end) and period in ``codes``."""
    ids = hashes.copy()
    # Starts of substrings that lie in a known run of a period up to a quarter of the scale.
    known = [(s, e) for s, e, p in found if 4 * p <= scale <= e - s]
    if known:
        marks = np.zeros(len(codes) + 1, np.int64)
        ends = np.array(known)
        np.add.at(marks, ends[:, 0], 1)
        np.add.at(marks, ends[:, 1] - scale + 1, -1)
        ids[np.cumsum(marks)[place] > 0] = _TOP
    low = window_minima(ids, scale + 1)
    m = len(low)
    picked = np.flatnonzero((low < _TOP) & ((low == ids[:m]) | (low == ids[scale:scale + m])))
    picked = picked[picked + 2 * scale <= len(ids)]
    context = _pair(hashes[picked], hashes[picked + scale])
    order = np.argsort(context, kind="stable")
    picked, context = picked[order], context[order]
    apart = np.diff(picked)
    near = np.flatnonzero((context[1:] == context[:-1]) & (apart >= scale) & (apart < 2 * scale))
    out, reach = [], {}
    at, period = place[picked[near]], apart[near]
    for k in np.argsort(at, kind="stable"):
        i, p = int(at[k]), int(period[k])
        if i < reach.get(p, -1):
            continue
        s, e = _stretch(codes, i, p)
        reach[p] = e
        if e - s >= TIMES * p:
            out.append((s, e, p))
    return out


def without_repeats(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    marks = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        marks[start + period] += 1
        marks[start + length] -= 1
    return np.cumsum(marks)[:n] == 0


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = texts(batch)
        for start, end in slices(column, HELD):
            own = [v.split() for v in column[start:end].to_pylist()]  # at space and 09 to 0D
            flat = np.array([w for ws in own for w in ws], dtype=object)
            codes = pd.factorize(flat)[0].astype(np.int64) if len(flat) else np.zeros(0, np.int64)
            found = find_runs(codes, [len(ws) for ws in own])
            rows = [_row(ws, runs) for ws, runs in zip(own, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[start:end],
                 *[pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_COLUMNS)]],
                names=["doc_id", *[name for name, _ in _COLUMNS]])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_COLUMNS = [("runs", pa.list_(_RUN)), ("runs_sha256", pa.string()), ("collapsed", pa.string()),
            ("collapsed_sha256", pa.string())]


def _row(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = b" ".join(words[i] for i in np.flatnonzero(without_repeats(len(words), runs))) if runs \
        else b" ".join(words)
    return ([dict(zip(("start", "length", "period"), r)) for r in runs],
            hashlib.sha256(listed.encode()).hexdigest(), kept.decode(), hashlib.sha256(kept).hexdigest())


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` with ``runs`` (start, length and period in words, by start, then period),
    ``collapsed`` (the words that stay when each run keeps its first period, joined by one space),
    and the SHA-256 digests of both.

    Words are what lies between spaces and the control characters 09 to 0D. A null or empty
    text, or one without words, has no runs and an empty ``collapsed``. Each row stands for
    itself, so repeated rows and null ids give a row each; other columns are ignored and an
    empty table gives no rows. Texts are never cut: a long one is searched alone, whole.
    """
    kind = dict(docs.dtypes)["doc_id"]
    return only(docs, "doc_id", "text").mapInArrow(
        _digests,
        f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, runs_sha256 string, "
        "collapsed string, collapsed_sha256 string")
