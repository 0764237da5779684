"""Quality by an interpolated modified Kneser-Ney model of trusted text.

The model's units are bytes and its n-grams have up to five. Counts of the trusted texts are
summed on Spark; the probability of each n-gram that trusted text has is worked out once, by
joins of count tables that are dealt by n-gram or context. Lower orders use continuation
counts, three discounts per order come from the counts of counts, and what they free goes to
the next lower order.

A document's code length is the sum over its n-grams. The commonest n-grams travel to the
documents in a table of bounded size; all others are collected per document, looked up in the
model by shuffled joins, backing off where trusted text lacks them, and summed. Which n-grams
travel changes the cost only. A document is kept when its rate, shrunk towards the median of its
language by its length, is at most a quantile of the trusted texts of that language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import find_slots, hash_slots, keep_ids, only, slices, texts
from tidepanel.session import materialise

ORDER = 5
#: N-grams that travel to the documents at most; 12 bytes each.
TABLE = 1 << 19
#: Bits per byte are compared in steps of this size.
STEP = 0.001


def _stream(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram ending at each byte, zero bytes standing before a text; bytes per text."""
    pad = ORDER - 1
    joined = b"".join(bytes(pad) + v for v in values)
    a = np.frombuffer(joined, np.uint8).astype(np.uint64)
    sizes = np.array([len(v) for v in values], dtype=np.int64)
    grams = np.zeros(max(0, len(a) - pad), np.uint64)
    for i in range(ORDER):
        grams = (grams << np.uint64(8)) | a[i:len(a) - pad + i]
    own = np.ones(len(a), bool)
    starts = np.cumsum(sizes + pad) - sizes - pad
    for i in range(pad):
        own[starts + i] = False
    return grams[own[pad:]].astype(np.int64), sizes


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams with counts, merged within the task."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys))

    for batch in batches:
        column = texts(batch)
        for start, end in slices(column, 1 << 20):
            keys, n = np.unique(_stream(column[start:end].to_pylist())[0], return_counts=True)
            parts.append((keys, n.astype(np.float64)))
            if len(parts) > 24:
                parts = [merged()]
    if parts:
        keys, n = merged()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], names=["gram", "n"])


def _low(gram: Column, n: int) -> Column:
    """The last ``n`` bytes of an n-gram."""
    return gram.bitwiseAND((1 << (8 * n)) - 1)


def _discounts(tables: list[DataFrame]) -> list[tuple[float, float, float]]:
    """Per order the discounts of counts one, two, and three or more."""
    rows = None
    for i, table in enumerate(tables):
        few = table.where("n <= 4").select(F.lit(i).alias("order"), "n")
        rows = few if rows is None else rows.unionAll(few)
    held = {(r["order"], r["n"]): float(r["count"]) for r in rows.groupBy("order", "n").count().collect()}
    return [_discount(*[held.get((i, n), 0.0) for n in (1, 2, 3, 4)]) for i in range(len(tables))]


def _discount(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5
    return tuple(min(max(d, 0.1), i + 0.9) for i, d in enumerate(raw))


def _context(gram: Column, n: int) -> Column:
    """The bytes before the last one of an n-gram of ``n``."""
    return F.shiftright(_low(gram, n), 8)


def _next(gram: Column) -> Column:
    return gram.bitwiseAND(255).cast("int")


@dataclass(frozen=True)
class Model:
    """``counts``: (gram, n) of the longest n-grams. ``orders``: from one byte up, a row per
    context of trusted text: (context, free, next), where ``next`` has the probability of each
    byte that follows and ``free`` is the share left to the lower order."""
    counts: DataFrame
    orders: list[DataFrame]


def fit(trusted: DataFrame) -> Model:
    """The model of all whole texts of ``trusted``. At most 256 bytes follow a context, so a
    context is one row; the rows of an order are joined to the contexts that are a byte shorter."""
    counted = (only(trusted, "text").where("text is not null").mapInArrow(_counts, "gram long, n long")
               .groupBy("gram").agg(F.sum("n").alias("n")))
    tables = [materialise(counted, "grams")]
    for n in range(ORDER - 1, 0, -1):
        lower = tables[0].groupBy(_low(F.col("gram"), n).alias("gram")).agg(F.count("*").alias("n"))
        tables.insert(0, materialise(lower, "grams"))
    orders: list[DataFrame] = []
    for n, (table, (d1, d2, d3)) in enumerate(zip(tables, _discounts(tables)), 1):
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        rows = table.select(_context(F.col("gram"), n).alias("context"), "n", cut.alias("cut"),
                            F.struct(_next(F.col("gram")).alias("byte"), (F.col("n") - cut).alias("own")).alias("e"))
        rows = rows.groupBy("context").agg(
            F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("free"), F.collect_list("e").alias("seen"))
        if orders:
            below = orders[-1].select(F.col("context").alias("low"), F.col("next").alias("lower"))
            rows = rows.join(below, _low(F.col("context"), n - 2) == F.col("low"))
        known = bool(orders)

        def entry(e: Column) -> Column:
            lower_p = F.try_element_at("lower", e["byte"]) if known else F.lit(1 / 256)
            return F.struct(e["byte"], (e["own"] / F.col("total") + F.col("free") * lower_p).alias("p"))

        rows = rows.select("context", "free", F.map_from_entries(F.transform("seen", entry)).alias("next"))
        orders.append(materialise(rows, "model"))
    return Model(tables[-1], orders)


def probabilities(grams: DataFrame, model: Model) -> DataFrame:
    """(gram, bits) of any n-grams of full length, backing off to shorter contexts. The
    contexts of all orders of an n-gram are looked up in one join."""
    tables = [m.withColumn("order", F.lit(n)) for n, m in enumerate(model.orders, 1)]
    every = reduce(DataFrame.unionByName, tables)
    gram = F.col("gram")
    keys = F.array(*[F.struct(F.lit(n).alias("order"), _context(gram, n).alias("context"))
                     for n in range(1, ORDER + 1)])
    asked = grams.select("gram").distinct().select("gram", F.explode(keys).alias("k")).select("gram", "k.*")
    found = asked.join(every, ["order", "context"], "left").select(
        "gram", "order", "free", F.try_element_at("next", _next(gram)).alias("p"))
    of = lambda c, n: F.max(F.when(F.col("order") == n, F.col(c))).alias(f"{c}{n}")
    rows = found.groupBy("gram").agg(*[of(c, n) for n in range(1, ORDER + 1) for c in ("free", "p")])
    p = F.lit(1 / 256)
    for n in range(1, ORDER + 1):
        p = F.coalesce(F.col(f"p{n}"), F.coalesce(F.col(f"free{n}"), F.lit(1.0)) * p)
    return rows.select("gram", (-F.log2(p)).alias("bits"))


def _scores(batches: Iterator[pa.RecordBatch], table, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """A row with the size of a document and the bits of its common n-grams, and a row per
    other n-gram with its count."""
    known, bits = table.value
    slots = hash_slots(known)
    for batch in batches:
        column = texts(batch)
        for start, end in slices(column, 1 << 20):
            grams, sizes = _stream(column[start:end].to_pylist())
            at = find_slots(slots, known, grams)
            cost = np.where(at >= 0, bits[at], 0.0) if len(known) else np.zeros(len(grams))
            total = np.concatenate([[0.0], np.cumsum(cost)])
            ends = np.cumsum(sizes)
            rest = np.flatnonzero(at < 0)
            owner = np.searchsorted(ends, rest, side="right")
            pairs, n = np.unique((owner.astype(np.int64) << 40) | grams[rest], return_counts=True)
            row = batch.column("row")[start:end]
            none = len(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.chunked_array([row, row.take(pa.array(pairs >> 40))]).combine_chunks()]
                + [pa.concat_arrays([batch.column(k)[start:end], pa.nulls(none, batch.column(k).type)]) for k in keys]
                + [pa.array(np.concatenate([sizes, n])),
                   pa.array(np.concatenate([total[ends] - total[ends - sizes], np.zeros(none)])),
                   pa.concat_arrays([pa.nulls(len(sizes), pa.int64()), pa.array(pairs & ((1 << 40) - 1))])],
                names=["row", *keys, "n", "bits", "gram"])


def code_lengths(docs: DataFrame, model: Model, keys: tuple[str, ...]) -> DataFrame:
    """``keys``, bytes and bits of every whole text, null counting as empty."""
    common = model.counts.orderBy(F.desc("n"), "gram").limit(TABLE)
    top = (common.join(model.orders[-1], _context(F.col("gram"), ORDER) == F.col("context"))
           .select("gram", F.try_element_at("next", _next(F.col("gram"))).alias("p")).toArrow().sort_by("gram"))
    bits = -np.log2(np.append(top["p"].to_numpy(), 1.0))
    table = docs.sparkSession.sparkContext.broadcast((top["gram"].to_numpy(), bits))
    rows = only(docs, *keys, "text").withColumn("row", F.monotonically_increasing_id())
    own = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c in keys)
    scored = materialise(rows.mapInArrow(lambda b: _scores(b, table, list(keys)),
                                         f"row long, {own}, n long, bits double, gram long"), "scores")
    others = scored.where("gram is not null").select("row", "gram", "n")
    looked = others.join(probabilities(others, model), "gram")
    more = looked.groupBy("row").agg(F.sum(F.col("n") * F.col("bits")).alias("more"))
    return (scored.where("gram is null").join(more, "row", "left")
            .select(*keys, F.col("n").alias("n_bytes"),
                    (F.col("bits") + F.coalesce("more", F.lit(0.0))).alias("bits")))


def quantiles(rows: DataFrame, column: str, share: float) -> DataFrame:
    """(every, lang, at): the ``share`` quantile of ``column`` per language, null being one, and one
    row with ``every`` set over all. Values are counted in steps, so no group is sorted whole."""
    from pyspark.sql import Window

    steps = rows.where(F.col(column).isNotNull()).select("lang", F.floor(F.col(column) / STEP).alias("step"))
    counted = steps.groupBy("lang", "step").agg(F.count("*").alias("n")).withColumn("every", F.lit(False))
    whole = counted.groupBy("step").agg(F.sum("n").alias("n")).withColumns(
        {"lang": F.lit(None).cast("string"), "every": F.lit(True)})
    own = Window.partitionBy("every", "lang")
    ranked = counted.unionByName(whole).withColumns({
        "upto": F.sum("n").over(own.orderBy("step")), "total": F.sum("n").over(own)})
    return (ranked.where(F.col("upto") >= F.col("total") * share).groupBy("every", "lang")
            .agg(((F.min("step") + 1) * STEP).alias("at")))


def _with_quantiles(rows: DataFrame, found: DataFrame, name: str) -> tuple[DataFrame, Column]:
    """``rows`` with the quantile of their language as ``name``, and the one over all."""
    own = found.where("not every").select(F.col("lang").alias("q_lang"), F.col("at").alias(name))
    every = found.where("every").agg(F.max("at")).scalar()
    return rows.join(own, F.col("lang").eqNullSafe(F.col("q_lang")), "left").drop("q_lang"), every


def perplexities(docs: DataFrame, labels: DataFrame, share: float = 0.995, margin: float = 0.05,
                 weight: int = 400) -> DataFrame:
    """``doc_id``, ``lang``, ``n_bytes``, ``perplexity`` per byte, ``excess``, ``cutoff`` and ``kept``.

    Trusted are the documents that ``labels`` gives quality 1. One half of them, by the md5
    of the id, trains the model; the other, which it has not seen, sets the cutoffs. The rate of a
    short text varies more than that of a long one, so ``excess`` is what a text's bits per byte are
    above the median of its language, counted as if ``weight`` more bytes had stood at the median. A
    document is kept when its excess is at most ``margin`` above the ``share`` quantile of that half's
    documents of its language, or of all languages where that is larger, so that a language with few
    trusted texts is not judged by their chance. A language without any takes the median of all.

    Null and empty texts have no perplexity and are not kept. Without trusted texts in the second half
    nothing is known and every text with a byte is kept. Repeated rows are judged each; other columns
    are ignored, an empty table gives no rows.
    """
    rows = only(docs, "doc_id", "lang", "text")
    digit = F.substring(F.md5(F.col("doc_id").cast("string")), 32, 1)
    half = F.conv(digit, 16, 10).cast("int") % 2
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id", half.alias("half"))
    trusted = keep_ids(rows, good.where("half = 0"), "doc_id")
    lengths = materialise(code_lengths(rows, fit(trusted), ("doc_id", "lang")), "lengths")
    held = materialise(keep_ids(lengths.where("n_bytes > 0"), good.where("half = 1"), "doc_id"), "held")
    rated = held.withColumn("rate", F.col("bits") / F.col("n_bytes"))
    usual = materialise(quantiles(rated, "rate", 0.5), "usual")

    def excess(of: DataFrame) -> DataFrame:
        beside, every = _with_quantiles(of, usual, "usual")
        above = (F.col("bits") - F.coalesce("usual", every) * F.col("n_bytes")) / (F.col("n_bytes") + weight)
        return beside.withColumn("excess", F.when(F.col("n_bytes") > 0, above))

    limits = materialise(quantiles(excess(held), "excess", share), "limits")
    out, every = _with_quantiles(excess(lengths), limits, "limit")
    out = out.withColumn("cutoff", F.greatest("limit", every) + margin)
    perplexity = F.when(F.col("n_bytes") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("n_bytes")))
    return out.select("doc_id", "lang", "n_bytes", perplexity.alias("perplexity"), "excess", "cutoff",
                      F.coalesce(F.col("excess") <= F.col("cutoff"), F.col("n_bytes") > 0).alias("kept"))
