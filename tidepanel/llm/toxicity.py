"""Toxic spans and scores by a linear-chain conditional random field.

Every word of a text is tagged clean or toxic. Tags for training come from the labels of
documents: words, or beginnings of words, that stand in many different contexts in toxic
documents and hardly ever in clean ones mark toxic tokens. The field has weights for a word,
its beginnings and its ending, hashed, and for pairs of neighbouring tags; its likelihood's
gradient is summed over the training texts on Spark. Forward-backward marginals give spans
where a token is likelier toxic than not, and a small logistic model of the marginals of a
document gives its score.

A whole batch of texts is one chain that restarts at every text. As two tags make a message a
single ratio, the chain is cut in lanes that are run side by side, twice: how a lane begins is
forgotten long before its end, so the first run yields the start of each next lane.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import held_out, keep_ids, only, slices, texts
from tidepanel.session import materialise

#: Labelled documents that the model learns from, at most: the first by the md5 of their id.
FIT_DOCS = 6000
#: Lexicon: contexts that an entry needs in toxic texts, its log odds, entries at most.
CONTEXTS, ODDS, ENTRIES = 5, 3.5, 4000
BUCKETS = 1 << 16
ROUNDS, RATE, DECAY = 20, 0.6, 1e-4
LANE = 512
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = re.compile(r"^\W+|\W+$")


def _bare(word: bytes) -> str:
    return _EDGE.sub("", word.decode("utf-8", "replace").lower())


def _keys(word: str) -> list[str]:
    """A word and its beginnings of four to six letters."""
    return ["=" + word] + [word[:n] for n in (4, 5, 6) if len(word) > n] if word else []


def _features(word: str) -> list[int]:
    """Eight hashed features of a word; absent ones fall on bucket zero, which has no weight."""
    named = ["=" + word] + [f"^{word[:n]}" if len(word) > n else "" for n in (3, 4, 5, 6)]
    named += [f"{word[-n:]}$" if len(word) > n else "" for n in (3, 4)] + [f"#{min(len(word), 12)}"]
    return [1 + zlib.crc32(x.encode()) % (BUCKETS - 1) if x else 0 for x in named]


# Training tags ------------------------------------------------------------------------------

def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, hash of the neighbours) of every token, each once a batch."""
    for batch in batches:
        found = set()
        for v in texts(batch).to_pylist():
            words = v.split()
            for i, w in enumerate(words):
                beside = zlib.crc32(words[i - 1] if i else b"") << 32 | zlib.crc32(words[i + 1] if i + 1 < len(words) else b"")
                found.update((k, beside - (1 << 63)) for k in _keys(_bare(w)))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()),
                                          pa.array([b for _, b in found], pa.int64())],
                                         names=["key", "beside"])


def _presence(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    """In how many texts each wanted key stands."""
    seen: dict[str, int] = {}
    for batch in batches:
        for v in texts(batch).to_pylist():
            own = {k for w in set(v.split()) for k in _keys(_bare(w))}
            for k in own & wanted.value:
                seen[k] = seen.get(k, 0) + 1
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                      pa.array(list(seen.values()), pa.int64())], names=["key", "n"])


def lexicon(sample: DataFrame) -> frozenset[str]:
    """Keys that mark toxic tokens: at least ``CONTEXTS`` different neighbourhoods in toxic
    texts, so copies of a text count little, and log odds against clean texts of ``ODDS``."""
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    spread = (only(sample.where("toxic = 1"), "text").mapInArrow(_contexts, "key string, beside long")
              .distinct().groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= CONTEXTS)
              .orderBy(F.desc("n"), "key").limit(20 * ENTRIES).toArrow())
    often = dict(zip(spread["key"].to_pylist(), spread["n"].to_pylist()))
    wanted = sample.sparkSession.sparkContext.broadcast(frozenset(often))
    met = (only(sample.where("toxic = 0"), "text")
           .mapInArrow(lambda b: _presence(b, wanted), "key string, n long")
           .groupBy("key").agg(F.sum("n").alias("n")).toArrow())
    fair = dict(zip(met["key"].to_pylist(), met["n"].to_pylist()))
    odds = {k: np.log((min(n, toxic) + 0.5) / (toxic + 1)) - np.log((fair.get(k, 0) + 0.5) / (clean + 1))
            for k, n in often.items()}
    best = sorted((k for k in odds if odds[k] >= ODDS), key=lambda k: (-odds[k], k))
    return frozenset(best[:ENTRIES])


# The chain ----------------------------------------------------------------------------------

def _lanes(n0: np.ndarray, n1: np.ndarray, d0: np.ndarray, d1: np.ndarray) -> np.ndarray:
    """Solves r[t] = (n0[t] + n1[t] r[t-1]) / (d0[t] + d1[t] r[t-1]) for all t; the first step of
    a text has n1 = d1 = 0. Lanes of steps are worked at once: what a lane does to any start is
    composed first, so each starts from where the one before ends, and no start is guessed."""
    n = len(n0)
    width = -(-n // LANE)
    pad = width * LANE - n
    cut = lambda x, fill: np.ascontiguousarray(
        np.concatenate([x, np.full(pad, fill)]).reshape(width, LANE).T)
    n0, n1, d0, d1 = cut(n0, 1.0), cut(n1, 0.0), cut(d0, 1.0), cut(d1, 0.0)
    # r -> (a r + b) / (c r + d) over a whole lane, composed step by step, in any common scale
    a, b, c, d = np.ones(width), np.zeros(width), np.zeros(width), np.ones(width)
    for t in range(LANE):
        a, c = n1[t] * a + n0[t] * c, d1[t] * a + d0[t] * c
        b, d = n1[t] * b + n0[t] * d, d1[t] * b + d0[t] * d
        if t % 8 == 7:
            scale = np.maximum.reduce([a, b, c, d])
            a, b, c, d = a / scale, b / scale, c / scale, d / scale
    r = np.ones(width)
    for k in range(width - 1):
        r[k + 1] = (a[k] * r[k] + b[k]) / (c[k] * r[k] + d[k])
    out = np.empty((LANE, width))
    for t in range(LANE):
        r = (n0[t] + n1[t] * r) / (d0[t] + d1[t] * r)
        out[t] = r
    return out.T.reshape(-1)[:n]


def messages(score: np.ndarray, first: np.ndarray, last: np.ndarray, pair: np.ndarray):
    """Forward and backward ratios (toxic to clean) of a batch of chains. ``score`` is the log
    ratio of a token's own weights, ``first`` and ``last`` mark the ends of texts, ``pair``
    holds the weights of neighbouring tags."""
    g = np.exp(np.clip(score, -30, 30))
    a = np.exp(pair)
    forward = _lanes(np.where(first, g, g * a[0, 1]), np.where(first, 0, g * a[1, 1]),
                     np.where(first, 1.0, a[0, 0]), np.where(first, 0, a[1, 0]))
    after = np.append(g[1:], 1.0)
    backward = _lanes(np.where(last, 1.0, a[1, 0])[::-1], np.where(last, 0, a[1, 1] * after)[::-1],
                      np.where(last, 1.0, a[0, 0])[::-1], np.where(last, 0, a[0, 1] * after)[::-1])[::-1]
    return g, a, forward, backward


def marginals(score, first, last, pair) -> np.ndarray:
    """The probability that each token is toxic."""
    if not len(score):
        return np.zeros(0)
    _, _, f, b = messages(score, first, last, pair)
    return f * b / (1 + f * b)


def _ends(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = int(sizes.sum())
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    full = sizes[sizes > 0]
    last[np.cumsum(full) - 1] = True
    first[np.cumsum(full) - full] = True
    return first, last


# Fitting ------------------------------------------------------------------------------------

@dataclass
class Field:
    """Weights of the hashed features, a bias, and of pairs of tags; ``scale`` are the logistic
    weights of a document's marginals."""
    weights: np.ndarray
    bias: float
    pair: np.ndarray
    scale: np.ndarray


def _prepared(batches: Iterator[pa.RecordBatch], marks) -> Iterator[pa.RecordBatch]:
    """Texts as places in a list of distinct words with their features and tags."""
    for batch in batches:
        column = texts(batch)
        for start, end in slices(column):
            words = [v.split() for v in column[start:end].to_pylist()]
            at, kinds = pd.factorize(np.array([w for own in words for w in own] or [b""], dtype=object))
            bare = [_bare(w) for w in kinds]
            tags = np.array([any(k in marks.value for k in _keys(w)) for w in bare], np.int8)
            rows = [np.array([len(w) for w in words], np.int32), at.astype(np.int32),
                    np.array([_features(w) for w in bare], np.int32), tags]
            if not sum(map(len, words)):
                continue
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary()) for r in rows],
                                             names=["sizes", "at", "features", "tags"])


def _gradient(batches: Iterator[pa.RecordBatch], field) -> Iterator[pa.RecordBatch]:
    """The gradient of the log likelihood over the texts of a task: features, bias, pairs."""
    w, bias, pair = field.value
    total, tokens = np.zeros(BUCKETS + 5), 0
    for batch in batches:
        for row in batch.to_pylist():
            sizes, at = np.frombuffer(row["sizes"], np.int32), np.frombuffer(row["at"], np.int32)
            features = np.frombuffer(row["features"], np.int32).reshape(-1, 8)
            y = np.frombuffer(row["tags"], np.int8)[at].astype(np.float64)
            first, last = _ends(sizes)
            score = (w[features].sum(axis=1) + bias)[at]
            g, a, f, b = messages(score, first, last, pair)
            p = f * b / (1 + f * b)
            missed = np.bincount(at, y - p, len(features))
            total[:BUCKETS] += np.bincount(features.ravel(), np.repeat(missed, 8), BUCKETS)
            total[BUCKETS] += (y - p).sum()
            t = np.flatnonzero(~first)
            cells = np.array([a[0, 0] * np.ones(len(t)), a[0, 1] * g[t] * b[t],
                              f[t - 1] * a[1, 0], f[t - 1] * a[1, 1] * g[t] * b[t]])
            now, before = y[t], y[t - 1]
            held = np.array([(1 - before) * (1 - now), (1 - before) * now, before * (1 - now), before * now])
            total[BUCKETS + 1:] += (held - cells / cells.sum(axis=0)).sum(axis=1)
            tokens += len(at)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([tokens], pa.int64())],
                                     names=["gradient", "tokens"])


def fit(sample: DataFrame) -> Field:
    """The field of labelled texts (text, toxic), by adaptive gradient steps."""
    context = sample.sparkSession.sparkContext
    marks = context.broadcast(lexicon(sample))
    rows = materialise(only(sample, "text").mapInArrow(
        lambda b: _prepared(b, marks), "sizes binary, at binary, features binary, tags binary"), "tokens")
    x = np.zeros(BUCKETS + 5)
    x[BUCKETS] = -4.0
    m, v = np.zeros_like(x), np.zeros_like(x)
    for i in range(1, ROUNDS + 1):
        state = context.broadcast((x[:BUCKETS], x[BUCKETS], x[BUCKETS + 1:].reshape(2, 2)))
        parts = rows.mapInArrow(lambda b, s=state: _gradient(b, s), "gradient binary, tokens long").toArrow()
        tokens = max(1, sum(parts["tokens"].to_pylist()))
        g = sum((np.frombuffer(p) for p in parts["gradient"].to_pylist()), np.zeros_like(x)) / tokens - DECAY / tokens * x
        m, v = 0.8 * m + 0.2 * g, 0.95 * v + 0.05 * g * g
        x += RATE * (m / (1 - 0.8 ** i)) / (np.sqrt(v / (1 - 0.95 ** i)) + 1e-7)
        x[0] = 0
        x[BUCKETS + 1:] = np.clip(x[BUCKETS + 1:], -3, 3)  # keeps the ratios of a lane in range
        state.unpersist()
    field = Field(x[:BUCKETS].astype(np.float32), float(x[BUCKETS]), x[BUCKETS + 1:].reshape(2, 2),
                  np.zeros(4))
    held = context.broadcast(field)
    seen = only(sample, "text", "toxic").mapInArrow(
        lambda b: _tag(b, held, ["toxic"]), f"toxic int, score double, expected double, highest double, words long, {SPANS}")
    seen = seen.select("toxic", "expected", "highest", "words").toPandas()
    field.scale = _logistic(_summary(seen["expected"], seen["highest"], seen["words"]), seen["toxic"].to_numpy(float))
    return field


def _summary(expected, highest, words) -> np.ndarray:
    expected = np.asarray(expected, float)
    return np.column_stack([np.ones(len(expected)), np.asarray(highest, float), np.log1p(expected),
                            np.minimum(1, 20 * expected / np.maximum(1, np.asarray(words, float)))])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic model with a ridge, by Newton's steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


# Scoring ------------------------------------------------------------------------------------

SPANS = "spans array<struct<start:int,end:int>>"


def _tag(batches: Iterator[pa.RecordBatch], field, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Score, marginals in short, and toxic spans in characters of every text."""
    model = field.value
    for batch in batches:
        column, score, expected, highest, counts, spans = texts(batch), [], [], [], [], []
        for start, end in slices(column, 8 << 20):
            values = column[start:end].to_pylist()
            words = [v.split() for v in values]
            sizes = np.array([len(w) for w in words])
            flat = np.array([w for own in words for w in own], dtype=object)
            at, kinds = pd.factorize(flat) if len(flat) else (np.zeros(0, int), [])
            features = np.array([_features(_bare(w)) for w in kinds], np.int64).reshape(-1, 8)
            own = model.weights[features].sum(axis=1) + model.bias
            p = marginals(own[at], *_ends(sizes), model.pair)
            total, ends = np.concatenate([[0.0], np.cumsum(p)]), np.cumsum(sizes)
            most = np.zeros(len(values))
            full = np.flatnonzero(sizes)
            if len(full):
                most[full] = np.maximum.reduceat(p, (ends - sizes)[full])
            expect = total[ends] - total[ends - sizes]
            score.append(1 / (1 + np.exp(-np.clip(_summary(expect, most, sizes) @ model.scale, -30, 30))))
            expected.append(expect)
            highest.append(most)
            counts.append(sizes)
            for v, lo, hi, top in zip(values, ends - sizes, ends, most):
                spans.append(_spans(v, p[lo:hi]) if top > 0.5 else [])
        join = lambda x, t: pa.array(np.concatenate(x) if x else [], t)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(k) for k in keys]
            + [join(x, pa.float64()) for x in (score, expected, highest)]
            + [join(counts, pa.int64()), pa.array(spans, kind)],
            names=[*keys, "score", "expected", "highest", "words", "spans"])


def _spans(value: bytes, p: np.ndarray) -> list[dict]:
    found = _WORD.finditer(value.decode("utf-8", "replace"))
    return [{"start": m.start(), "end": m.end()} for m, x in zip(found, p) if x > 0.5]


def tag(docs: DataFrame, field: Field, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``score``, the expected number of toxic words, the highest marginal, the
    number of words, and the spans of words likelier toxic than not.

    Null text counts as empty: no words, no spans, and the score of a text without evidence.
    Each row is scored by its own text alone; columns besides ``keys`` and ``text`` are not read.
    """
    rows = only(docs, *keys, "text")
    model = docs.sparkSession.sparkContext.broadcast(field)
    own = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c in keys)
    return rows.mapInArrow(lambda b: _tag(b, model, list(keys)),
                           f"{own}, score double, expected double, highest double, words long, {SPANS}")


def toxicity(docs: DataFrame, labels: DataFrame, cutoff: float = 0.7) -> DataFrame:
    """Learns from labelled rows outside the held-out fold and scores every row; ``predicted``
    is 1 from ``cutoff`` on. At most ``FIT_DOCS`` labelled documents are learned from, the
    first by the md5 of their id. A document labelled both ways counts as toxic. Without
    labels of both kinds nothing is learned and every score is 0.5."""
    known = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")).withColumn("held_out", held_out())
             .where("not held_out").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(FIT_DOCS))
    known = materialise(known.select("doc_id", "toxic"), "labels")
    marked = only(docs, "doc_id", "text").withColumn("held_out", held_out())
    sample = materialise(keep_ids(marked, known, "doc_id").join(F.broadcast(known), "doc_id")
                         .select("text", "toxic").repartition(12), "sample")
    if sample.select("toxic").distinct().count() < 2:
        field = Field(np.zeros(BUCKETS, np.float32), -30.0, np.zeros((2, 2)), np.zeros(4))
    else:
        field = fit(sample)
    out = tag(marked, field, ("doc_id", "held_out"))
    return out.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))
