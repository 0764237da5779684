"""Hard negatives by the triangle inequality of angles.

Vectors are scaled to whole numbers; a score is an inner product of two of them. A few rows
serve as reference directions, and each vector keeps its norm and its angle to each of them.
The angle of two vectors is at least the difference of their angles to a reference and at most
the sum. Times the norms that bounds their score, with room for rounding; only vectors whose
bounds meet the window that an anchor looks for are scored, in whole numbers.

Rows are dealt at random over slots, anchors in runs, and every slot meets every run: the
anchors travel to the slots, and one task holds one slot and one run, both of fixed size. A task
sorts its rows by reference and angle, so rows that a window admits lie together. It keeps the
first few of each window, whose least score narrows the window further; what all slots have kept
is ranked by Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.session import materialise

#: Reference directions.
REFERENCES = 8
#: Rows of a slot and anchors of a run, about.
SLOT, RUN = 16_384, 8_192
#: Rows and anchors that are compared at a time.
ROWS, ANCHORS = 2_048, 256
#: Room for the rounding of an angle.
SLACK = 4e-6


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, q): rows that take part, components as floor(scale * x)."""
    good = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"),
                                      F.col("label").cast("string").alias("label"), q.alias("q"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.*")


def _slot(id: str, size: Column | int) -> Column:
    return F.pmod(F.xxhash64(id), F.lit(size)).cast("int")


def _angles(q: np.ndarray, norm: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles to the references, a right angle for a zero vector."""
    if not len(references) or references.shape[1] != q.shape[1]:
        return np.full((len(q), 1), np.pi / 2)  # says nothing: the bounds are 0 and 180 degrees
    across = q @ references.T / np.maximum(norm[:, None], 1e-300)
    return np.where(norm[:, None] > 0, np.arccos(np.clip(across, -1, 1)), np.pi / 2)


class _Side:
    """Rows of one task with equal dimension, ordered by label, nearest reference and angle."""

    def __init__(self, table: pa.Table, dim: int, references: np.ndarray):
        q = table["q"].combine_chunks()
        self.q = np.asarray(q.flatten(), np.int64).reshape(len(q), dim)
        self.real = self.q.astype(np.float64)
        norm = np.sqrt((self.real ** 2).sum(axis=1))
        angle = _angles(self.real, norm, references)
        near = angle.argmin(axis=1)
        self.label = np.asarray(table["label"].combine_chunks().dictionary_encode().indices)
        self.names = table["label"].combine_chunks().dictionary_encode().dictionary.to_pylist()
        order = np.lexsort((angle[np.arange(len(near)), near], near, self.label))
        self.order = order
        self.id = np.asarray(table["vec_id"], np.int64)[order]
        self.q, self.real, self.norm, self.angle, self.label, self.near = (
            x[order] for x in (self.q, self.real, norm, angle, self.label, near))
        self.largest = float(np.abs(self.real).max(initial=0))

    def blocks(self, size: int, near: bool = True):
        """Stretches of at most ``size`` rows of one label and, if wanted, one nearest reference."""
        key = np.stack([self.label, self.near * near], axis=1)
        turns = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *turns], [*turns, len(key)]):
            for at in range(lo, hi, size):
                yield at, min(at + size, hi)


def _bounds(a: _Side, x: _Side, rows: slice, block: slice) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of each anchor with any row of the block."""
    angle, norm = x.angle[block], x.norm[block]
    low, high = angle.min(axis=0) - SLACK, angle.max(axis=0) + SLACK
    own = a.angle[rows]
    least = np.maximum(np.maximum(own - high, low - own), 0).max(axis=1)
    most = np.minimum(np.minimum(own + high, 2 * np.pi - own - low), np.pi).min(axis=1)
    times = lambda angle, small, large: a.norm[rows] * np.cos(angle) * np.where(np.cos(angle) > 0, large, small)
    room = 1 + 1e-9 * a.norm[rows] * norm.max()
    return times(most, norm.max(), norm.min()) - room, times(least, norm.min(), norm.max()) + room


def _window(a: _Side, x: _Side, rows: np.ndarray, block: slice, floor: np.ndarray) -> slice:
    """The part of a block whose angle to its reference lets a score reach any anchor's floor."""
    near, most = x.near[block.start], x.norm[block].max()
    reach = np.arccos(np.clip((floor - 1) / np.maximum(a.norm[rows] * most, 1e-300), -1, 1)) + SLACK
    angle, own = x.angle[block, near], a.angle[rows, near]
    return slice(block.start + int(np.searchsorted(angle, (own - reach).min())),
                 block.start + int(np.searchsorted(angle, (own + reach).max(), side="right")))


def _scores(a: _Side, x: _Side, rows: np.ndarray, block: slice) -> np.ndarray:
    if a.q.shape[1] * a.largest * x.largest < 2.0 ** 53:
        return a.real[rows] @ x.real[block].T  # whole numbers, exact as doubles
    return (a.q[rows].astype(object) @ x.q[block].astype(object).T).astype(np.float64)


class _Best:
    """The first ``k`` (score, id) of each window [low, high], by score, then smaller id."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.score = np.full((len(low), k), -np.inf)  # free places are the last
        self.id = np.zeros((len(low), k), np.int64)
        self.least = low.astype(np.float64)

    def add(self, window: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = (scores >= self.least[window, None]) & (scores <= self.high[window, None])
        many = np.flatnonzero(np.count_nonzero(fit, axis=1) > 4 * self.k)
        if len(many):  # those below the k-th of this block cannot come in
            own = np.where(fit[many], scores[many], -np.inf)
            fit[many] &= scores[many] >= np.partition(own, -self.k, axis=1)[:, -self.k, None]
        i, j = np.nonzero(fit)
        if not len(i):
            return
        touched = np.unique(i)
        w = window[touched]
        place = np.concatenate([np.repeat(np.arange(len(w)), self.k), np.searchsorted(touched, i)])
        s = np.concatenate([self.score[w].ravel(), scores[i, j]])
        d = np.concatenate([self.id[w].ravel(), ids[j]])
        order = np.lexsort((d, -s, place))
        place = place[order]
        first = order[np.arange(len(order)) - np.searchsorted(place, place) < self.k]
        self.score[w], self.id[w] = s[first].reshape(-1, self.k), d[first].reshape(-1, self.k)
        self.least[w] = np.maximum(self.least[w], self.score[w, -1])

    def held(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, score and id of what is held."""
        w, k = np.nonzero(np.isfinite(self.score))
        return w, self.score[w, k], self.id[w, k]


def _search(a: _Side, x: _Side, best: list[_Best], same: bool) -> None:
    """Fills the windows of each anchor, one in each of ``best``."""
    name = {n: i for i, n in enumerate(x.names)}
    code = np.array([name.get(n, -1) for n in a.names])[a.label] if len(a.label) else a.label
    blocks = list(x.blocks(ROWS))
    for start, end in a.blocks(ANCHORS, near=False):
        own = np.arange(start, end)
        for lo, hi in blocks:
            if (x.label[lo] == code[start]) != same:
                continue
            block = slice(lo, hi)
            least, most = _bounds(a, x, slice(start, end), block)
            fits = [(most >= b.least[own]) & (least <= b.high[own]) for b in best]
            rows = own[np.any(fits, axis=0)]
            if not len(rows):
                continue
            part = _window(a, x, rows, block, np.min([b.least[rows] for b in best], axis=0))
            scores = _scores(a, x, rows, part)
            if same:
                scores = np.where(a.id[rows][:, None] == x.id[part][None, :], -np.inf, scores)
            for b in best:
                b.add(rows, scores, x.id[part])


def _by_dimension(anchors: pa.Table, rows: pa.Table):
    size = lambda t: np.asarray(pa.compute.list_value_length(t["q"].combine_chunks()))
    na, nx = size(anchors), size(rows)
    for dim in np.intersect1d(na, nx):
        yield int(dim), anchors.filter(pa.array(na == dim)), rows.filter(pa.array(nx == dim))


def _met(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, search, schema: str) -> DataFrame:
    """``search`` on every slot of rows and run of anchors."""
    slots, runs = max(1, -(-n_rows // SLOT)), max(1, -(-n_anchors // RUN))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    right = rows.withColumn("slot", _slot("vec_id", slots)).withColumn("run", every(runs))
    left = anchors.withColumn("run", _slot("vec_id", runs)).withColumn("slot", every(slots))
    return left.groupBy("slot", "run").cogroup(right.groupBy("slot", "run")).applyInArrow(search, schema)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose ``vec_id`` is divisible by ``every``. Positives are the first rows
    of an anchor's label but itself; negatives, for each positive, the first rows of another label
    whose score lies between ``low`` and ``high`` per cent of the positive's, ends included. Higher
    scores come first, of equal ones the smaller id.

    Rows with a null id, label or vector, or with a component that is null or not finite, take
    no part. A ``vec_id`` that repeats counts once, as its row with the smallest label, then
    vector. Vectors of different length have no score, a zero vector scores 0. Other columns are
    ignored; an empty table gives no rows. A scaled component fits a long.
    """
    rows = materialise(usable(vectors, scale), "vectors")
    chosen = (F.col("vec_id") % every) == 0
    n, n_anchors = rows.agg(F.count("*"), F.count_if(chosen)).first()
    # Any directions are right; these are picked by a hash of the id.
    picked = [r.q for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(REFERENCES).collect()]
    reach = [np.array(q, np.float64) for q in picked if any(q)]
    common = max((len(q) for q in reach), key=[len(q) for q in reach].count, default=0)
    alike = [q / np.sqrt((q ** 2).sum()) for q in reach if len(q) == common]
    references = np.array(alike, np.float64).reshape(len(alike), common)
    anchors = rows.where(chosen)

    def first_same(a_rows: pa.Table, x_rows: pa.Table) -> pa.Table:
        out = []
        for dim, left, right in _by_dimension(a_rows, x_rows):
            a, x = _Side(left, dim, references), _Side(right, dim, references)
            every_score = np.full(len(a.id), np.inf)
            best = _Best(-every_score, every_score, positives)
            _search(a, x, [best], same=True)
            w, s, d = best.held()
            out.append(pa.table({"anchor_id": a.id[w], "positive_id": d, "positive_score": s.astype(np.int64)}))
        return pa.concat_tables(out) if out else _EMPTY.select(["anchor_id", "positive_id", "positive_score"])

    found = _met(rows, anchors, n, n_anchors, first_same, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    kept = found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= positives)
    own = kept.groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("k", "positive_id", "positive_score"))).alias("p"))
    seekers = materialise(anchors.join(own, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "q", "p"),
                          "anchors")

    def between(a_rows: pa.Table, x_rows: pa.Table) -> pa.Table:
        out = []
        for dim, left, right in _by_dimension(a_rows, x_rows):
            a, x = _Side(left, dim, references), _Side(right, dim, references)
            own = [left["p"][int(i)].as_py() for i in a.order]
            best = []
            for k in range(positives):
                score = [p[k]["positive_score"] if k < len(p) else None for p in own]
                best.append(_Best(np.array([np.inf if s is None else -(-low * s // 100) for s in score], np.float64),
                                  np.array([-np.inf if s is None else high * s // 100 for s in score], np.float64),
                                  negatives))
            _search(a, x, best, same=False)
            for k, b in enumerate(best):
                w, s, d = b.held()
                out.append(pa.table({
                    "anchor_id": a.id[w], "positive_id": np.array([own[i][k]["positive_id"] for i in w], np.int64),
                    "negative_id": d, "negative_score": s.astype(np.int64),
                    "positive_score": np.array([own[i][k]["positive_score"] for i in w], np.int64)}))
        return pa.concat_tables(out) if out else _EMPTY

    spans = _met(rows, seekers, n, n_anchors, between, "anchor_id long, positive_id long, negative_id long, "
                 "negative_score long, positive_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return spans.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


_EMPTY = pa.table({c: pa.array([], pa.int64()) for c in (
    "anchor_id", "positive_id", "negative_id", "negative_score", "positive_score")})
