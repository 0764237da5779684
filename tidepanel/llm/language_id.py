"""Language identification by prediction by partial matching over bytes.

Per language a context tree of up to three preceding bytes counts which byte follows. A byte
seen in a context costs log2((total + kinds) / count) bits; a byte not seen there costs an
escape, log2((total + kinds) / kinds), and then its cost in the next shorter context, less the
share of that context's symbols that the longer one has excluded. Costs therefore are the code
lengths of a proper distribution under statistics that no longer change. The language that
codes a text shortest is predicted.

All bytes of all learning rows are counted on Spark, and the paths stay in tables, dealt by
context, with totals over all of them. The commonest travel to the documents with their costs in
a table of bounded size; the others, seen in learning or not, are collected per document and looked
up by a shuffled join. Every path counts, and which ones travel changes the cost only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import find_slots, hash_slots, held_out, only, slices, texts
from tidepanel.session import materialise

UNKNOWN = "und"
#: Costs of four-byte paths that travel to the documents at most, over all languages.
PATHS = 2_000_000
_PAD = 3
_LATIN = re.compile(rb"[A-Za-z]")


def _stream(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one byte array, three zero bytes before each; the four bytes ending at
    each position of a text as one number, and how many positions each text has."""
    joined = b"".join(b"\0\0\0" + v for v in values)
    a = np.frombuffer(joined, np.uint8).astype(np.uint32)
    sizes = np.array([len(v) for v in values], dtype=np.int64)
    own = np.ones(len(a), bool)
    starts = np.cumsum(sizes + _PAD) - sizes - _PAD
    for i in range(_PAD):
        own[starts + i] = False
    grams = (a[:-3] << 24) | (a[1:-2] << 16) | (a[2:-1] << 8) | a[3:]
    return a, grams[own[3:]], sizes


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four-byte paths with counts per language, merged within the task."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merge(parts):
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return [(keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)))]

    for batch in batches:
        column, langs = texts(batch), batch.column("lang").to_pylist()
        for start, end in slices(column):
            by_lang: dict[str, list[bytes]] = {}
            for lang, v in zip(langs[start:end], column[start:end].to_pylist()):
                by_lang.setdefault(lang, []).append(v)
            for lang, values in by_lang.items():
                keys, n = np.unique(_stream(values)[1], return_counts=True)
                parts = held.setdefault(lang, [])
                parts.append((keys, n.astype(np.float64)))
                if len(parts) > 8:
                    held[lang] = merge(parts)
    for lang, parts in held.items():
        keys, n = merge(parts)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
            names=["lang", "path", "n"])


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k, at = np.unique(keys, return_inverse=True)
    return k, np.bincount(at, n, len(k))


def _order1(path: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Cost of each byte after each byte, from paths that end in the two."""
    none = np.full(256, 8.0)
    symbols, n0 = _summed(path & 0xFF, count)
    seen, escape = _context(np.zeros(len(symbols), np.int64), n0, none[symbols], 1)
    order0 = none + escape[0]
    order0[symbols] = seen
    pairs, n1 = _summed(path & 0xFFFF, count)
    seen, escape = _context(pairs >> 8, n1, order0[pairs & 0xFF], 256)
    order1 = (escape[:, None] + order0[None, :]).reshape(-1)
    order1[pairs] = seen
    return order1


def _context(owner: np.ndarray, n: np.ndarray, lower: np.ndarray, size: int):
    """Cost of the symbols seen in their contexts, and the cost of leaving each context."""
    total = np.bincount(owner, n, size)
    kinds = np.bincount(owner, minlength=size).astype(np.float64)
    excluded = np.bincount(owner, np.exp2(-lower), size)
    seen = np.log2((total + kinds)[owner] / n)
    some = kinds > 0
    escape = np.zeros(size)
    escape[some] = (np.log2((total[some] + kinds[some]) / kinds[some])
                    + np.log2(np.maximum(1 - excluded[some], 2.0 ** -20)))
    return seen, escape


@dataclass(frozen=True)
class Trees:
    """Context trees of all languages. ``low``: cost of each pair of bytes per language.
    ``contexts``: (size, context, lang, escape, next) for each context of two and three
    bytes of a language, ``lang`` being its place in ``langs`` and ``next`` the cost of each byte
    seen there. ``common``: the commonest paths in order, and their costs per language."""
    langs: list[str]
    low: np.ndarray
    contexts: DataFrame
    common: tuple[np.ndarray, np.ndarray]


def _ending(paths: DataFrame, size: int) -> DataFrame:
    """Counts of the last ``size`` bytes of paths, with the cost of the last one after the others."""
    low = F.col("path").bitwiseAND((1 << (8 * size)) - 1)
    rows = paths.groupBy("lang", low.alias("path")).agg(F.sum("n").alias("n"))
    own = Window.partitionBy("lang", "context")
    return rows.withColumn("context", F.shiftright("path", 8)).withColumns({
        "total": F.sum("n").over(own), "kinds": F.count("*").over(own)}) \
        .withColumn("cost", F.log2((F.col("total") + F.col("kinds")) / F.col("n")))


def _contexts(table: DataFrame, below: DataFrame, size: int) -> DataFrame:
    """A row per language and context of ``size`` bytes. What a context has seen, the one a byte
    shorter has seen too. At most 256 bytes follow a context."""
    lower = below.select("lang", F.col("path").alias("low"), F.col("cost").alias("lower"))
    rows = table.withColumn("low", F.col("path").bitwiseAND((1 << (8 * size)) - 1)).join(lower, ["lang", "low"])
    entry = F.struct(F.col("path").bitwiseAND(255).cast("int").alias("byte"), "cost")
    rows = rows.groupBy("lang", "context").agg(
        F.first("total").alias("total"), F.first("kinds").alias("kinds"),
        F.sum(F.pow(F.lit(2.0), -F.col("lower"))).alias("excluded"),
        F.map_from_entries(F.collect_list(entry)).alias("next"))
    escape = (F.log2((F.col("total") + F.col("kinds")) / F.col("kinds"))
              + F.log2(F.greatest(1 - F.col("excluded"), F.lit(2.0 ** -20))))
    return rows.select(F.lit(size).alias("size"), "context", "lang", escape.alias("escape"), "next")


def fit(docs: DataFrame) -> Trees | None:
    """Context trees of the languages of ``docs`` (text, lang); None if no row has both with a byte.
    Rows without a text or language are left out, repeated rows count each."""
    rows = only(docs, "text", "lang").where("lang is not null and text is not null")
    counted = materialise(rows.mapInArrow(_grams, "lang string, path long, n long")
                          .groupBy("lang", "path").agg(F.sum("n").alias("n")), "paths")
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    if not langs:
        return None
    place = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1
    paths = materialise(counted.select(place.cast("int").alias("lang"), "path", "n"), "paths")
    pairs, triples = (materialise(_ending(paths, size), "endings") for size in (2, 3))
    held = pairs.select("lang", "path", "n").toArrow()
    lang, path, n = (held[c].to_numpy() for c in ("lang", "path", "n"))
    low = np.stack([_order1(path[lang == i], n[lang == i].astype(np.float64)) for i in range(len(langs))])
    contexts = materialise(_contexts(triples, pairs, 2).unionByName(_contexts(_ending(paths, 4), triples, 3)),
                           "contexts")
    top = paths.groupBy("path").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "path") \
        .limit(max(1, PATHS // len(langs))).select("path")
    found = path_costs(top, low, contexts).toArrow().sort_by("path")
    bits = found["bits"].combine_chunks().flatten().to_numpy().reshape(-1, len(langs))
    return Trees(langs, low, contexts, (found["path"].to_numpy(), bits))


def _costs(batches: Iterator[pa.RecordBatch], low) -> Iterator[pa.RecordBatch]:
    """Costs of paths per language, from the contexts found for them."""
    low = low.value
    for batch in batches:
        path, found = batch.column("path").to_numpy(), batch.column("found")
        cost = low[:, path & 0xFFFF].T.copy()
        owner = np.repeat(np.arange(len(path)), pa.compute.list_value_length(found).to_numpy())
        size, lang, escape, seen = (x.to_numpy(zero_copy_only=False) for x in found.flatten().flatten())
        for k in (2, 3):
            at = size == k
            o, i, s = owner[at], lang[at], seen[at].astype(np.float64)
            cost[o, i] = np.where(np.isnan(s), escape[at] + cost[o, i], s)
        yield pa.RecordBatch.from_arrays([batch.column("path"), _lists(cost)], names=["path", "bits"])


def _lists(rows: np.ndarray) -> pa.ListArray:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width),
                                    pa.array(rows.reshape(-1), pa.float64()))


def path_costs(paths: DataFrame, low: np.ndarray, contexts: DataFrame) -> DataFrame:
    """(path, bits) of any paths, ``bits`` having the cost in each language. Both contexts of
    a path are looked up in one join."""
    path = F.col("path")
    keys = F.array(*[F.struct(F.lit(k).alias("size"), F.shiftright(path, 8).bitwiseAND((1 << (8 * k)) - 1)
                              .alias("context")) for k in (2, 3)])
    asked = paths.select("path").distinct().select("path", F.explode(keys).alias("k")).select("path", "k.*")
    hit = F.struct("size", "lang", "escape", F.try_element_at("next", path.bitwiseAND(255).cast("int")).alias("seen"))
    found = asked.join(contexts, ["size", "context"], "left").groupBy("path").agg(
        F.collect_list(F.when(F.col("lang").isNotNull(), hit)).alias("found"))
    held = paths.sparkSession.sparkContext.broadcast(low)
    return found.mapInArrow(lambda b: _costs(b, held), "path long, bits array<double>")


def _has_letter(value: bytes) -> bool:
    return bool(_LATIN.search(value)) or any(c.isalpha() for c in value.decode("utf-8", "replace"))


def _judged(bits: np.ndarray, known: list[bool], langs: list[str]) -> list[pa.Array]:
    """The language that codes each text shortest, and its posterior share."""
    best = bits.argmin(axis=1)
    odds = 1 / np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000)).sum(axis=1)
    return [pa.array([langs[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
            pa.array([float(s) if k else 0.0 for s, k in zip(odds, known)], pa.float64())]


def _scores(batches: Iterator[pa.RecordBatch], common, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """A row with the bits of a text's common paths per language, and a row per other path with
    its count."""
    known, cost = common.value
    slots = hash_slots(known)
    for batch in batches:
        column = texts(batch)
        for start, end in slices(column, 1 << 20):
            values = column[start:end].to_pylist()
            _, paths, sizes = _stream(values)
            paths = paths.astype(np.int64)
            at = find_slots(slots, known, paths)
            ends = np.cumsum(sizes)
            bits = np.zeros((len(values), cost.shape[1]))
            full = np.flatnonzero(sizes)
            for i in range(cost.shape[1] if len(full) else 0):
                bits[full, i] = np.add.reduceat(np.where(at >= 0, cost[at, i], 0.0), (ends - sizes)[full])
            rest = np.flatnonzero(at < 0)
            owner = np.searchsorted(ends, rest, side="right").astype(np.int64)
            pairs, n = np.unique((owner << 32) | paths[rest], return_counts=True)
            row, none = batch.column("row")[start:end], len(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([row, row.take(pa.array(pairs >> 32))])]
                + [pa.concat_arrays([batch.column(k)[start:end], pa.nulls(none, batch.column(k).type)]) for k in keys]
                + [pa.array([_has_letter(v) for v in values] + [None] * none, pa.bool_()),
                   pa.concat_arrays([_lists(bits), pa.nulls(none, pa.list_(pa.float64()))]),
                   pa.concat_arrays([pa.nulls(len(values), pa.int64()), pa.array(pairs & 0xFFFFFFFF)]),
                   pa.concat_arrays([pa.nulls(len(values), pa.int64()), pa.array(n.astype(np.int64))])],
                names=["row", *keys, "known", "bits", "path", "n"])


def _sums(batches: Iterator[pa.RecordBatch], langs: list[str], keys: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = batch.column("bits").flatten().to_numpy().reshape(-1, len(langs))
        yield pa.RecordBatch.from_arrays(
            [batch.column(k) for k in keys] + _judged(bits, batch.column("known").to_pylist(), langs),
            names=keys + ["lang_pred", "score"])


def predict(docs: DataFrame, trees: Trees | None, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, the predicted language and its posterior share of every whole text.

    A text that is null or has no letter is ``und`` with score 0, and so is every text when
    nothing was learned. A tie goes to the first language by name. Each row is judged on its
    own text, so repeated rows agree; columns besides ``keys`` and ``text`` are not read.
    """
    rows = only(docs, *keys, "text")
    if trees is None:
        return rows.select(*keys, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "text")
    common = rows.sparkSession.sparkContext.broadcast(trees.common)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    scored = materialise(rows.mapInArrow(
        lambda b: _scores(b, common, list(keys)),
        f"row long, {schema}, known boolean, bits array<double>, path long, n long"), "scores")
    others = scored.where("path is not null").select("row", "path", "n")
    more = (others.join(path_costs(others, trees.low, trees.contexts), "path")
            .select("row", "n", F.posexplode("bits").alias("i", "b"))
            .groupBy("row", "i").agg(F.sum(F.col("n") * F.col("b")).alias("b"))
            .groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "b"))), lambda x: x["b"])
                                .alias("more")))
    bits = F.when(F.col("more").isNull(), F.col("bits")).otherwise(F.zip_with("bits", "more", lambda a, b: a + b))
    whole = scored.where("path is null").join(more, "row", "left").select(*keys, "known", bits.alias("bits"))
    langs = trees.langs
    return whole.mapInArrow(lambda b: _sums(b, langs, list(keys)), f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the rows outside the held-out fold and predicts every row.

    Rows with a null id, text or language teach nothing but are predicted; repeated rows count and
    are predicted each; an empty table gives no rows; other columns are not read.
    """
    marked = only(docs, "doc_id", "text", "lang").withColumn("held_out", held_out())
    trees = fit(marked.where("doc_id is not null and not held_out"))
    return predict(marked, trees, ("doc_id", "held_out"))
