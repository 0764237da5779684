"""Quality rules whose cutoffs follow each language and source.

Every text is measured once. The measures of all texts are counted in quantile sketches per
language and source: a value falls into a bucket of at most 1/64 of its size, and a sketch is
the count of each bucket. Sketches merge by adding counts, so partial sketches combine before
the shuffle, and the sketch of a language is the sum over its sources. A rule's cutoff is a
fence above (or below) the quartiles of its group; texts beyond a fence are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.llm.common import only, shingle_hashes, slices, texts, word_hashes
from tidepanel.session import materialise

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rule: numerator, denominator, side, least spread, and what is added to the denominator, so
#: that one line or phrase decides nothing in a short text. Ratios are in thousandths.
RULES = {
    "symbols": ("n_symbols", "n_words", "high", 50, 0),
    "dup_lines": ("n_dup_lines", "n_lines", "high", 100, 3),
    "repeats": ("n_repeat_words", "n_words", "high", 100, 20),
    "long_words": ("word_chars", "n_words", "high", 500, 0),
    "short_words": ("word_chars", "n_words", "low", 500, 0),
}


def _count(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = texts(batch)
        rows = []
        for start, end in slices(column):
            rows += _measures(column[start:end].to_pylist())
        table = np.array(rows, dtype=np.int64).reshape(-1, len(MEASURES))
        yield pa.RecordBatch.from_arrays(
            [batch.column(k) for k in keys] + [pa.array(table[:, i]) for i in range(len(MEASURES))],
            names=keys + list(MEASURES))


def _measures(values: list[bytes]) -> list[tuple]:
    words = [v.split() for v in values]  # bytes split at space and 09 to 0D
    n = np.array([len(w) for w in words], dtype=np.int64)
    repeated = _repeated(word_hashes([w for own in words for w in own]), n)
    out = []
    for value, own, r in zip(values, words, repeated):
        lines = [x for x in value.split(b"\n") if x.strip()]
        chars = len(b"".join(own).decode("utf-8", "replace"))
        symbols = len(value) - len(value.translate(None, SYMBOLS))
        out.append((len(own), chars, symbols, len(lines), len(lines) - len(set(lines)), int(r)))
    return out


def _repeated(h: np.ndarray, n: np.ndarray, width: int = 3) -> np.ndarray:
    """Words per text in windows of ``width`` words that the text has twice or more."""
    ends = np.cumsum(n)
    owner = np.repeat(np.arange(len(n)), n)
    windows = shingle_hashes(h, width)
    if not len(windows):
        return np.zeros(len(n), np.int64)
    at = np.flatnonzero(owner[:len(windows)] == owner[width - 1:])
    key = windows[at] + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(h), bool)
    for i in range(width):
        covered[at[twice] + i] = True
    total = np.concatenate([[0], np.cumsum(covered)])
    return total[ends] - total[ends - n]


def measures(docs: DataFrame, keys: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The counts of every whole text. Null text counts as empty; other columns are ignored."""
    rows = only(docs, *keys, "text")
    schema = T.StructType([rows.schema[k] for k in keys]
                          + [T.StructField(m, T.LongType()) for m in MEASURES])
    return rows.mapInArrow(lambda batches: _count(batches, list(keys)), schema)


def bucket(value: Column) -> Column:
    """The sketch bucket of a whole number: itself below 128, else its seven leading bits and
    its size, so a bucket spans at most 1/64 of its values."""
    e = F.greatest(F.lit(0), F.length(F.bin(value)) - 7)
    return (e * 64 + F.call_function("shiftright", value, e)).cast("long")


def bucket_top(b: Column) -> Column:
    """The largest value of a bucket."""
    e = F.greatest(F.lit(0), F.call_function("div", b, F.lit(64)) - 1).cast("int")
    return F.when(b < 128, b).otherwise(F.call_function("shiftleft", b - e * 64 + 1, e) - 1)


def ratio(rule: str) -> Column:
    above, below, _, _, more = RULES[rule]
    return F.when(F.col(below) > 0, F.call_function("div", F.col(above) * 1000, F.col(below) + more))


def sketches(measured: DataFrame) -> DataFrame:
    """Bucket counts per rule for every source within a language, every language, and all
    texts: ``level`` 0, 1 and 2. Null language or source is a group like any other."""
    rule = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), ratio(r).alias("v")) for r in RULES]))
    by_source = (measured.select("lang", "source", rule.alias("r")).where("r.v is not null")
                 .groupBy("lang", "source", F.col("r.rule").alias("rule"),
                          bucket(F.col("r.v")).alias("bucket")).agg(F.count("*").alias("n")))
    none = F.lit(None).cast("string")
    by_lang = by_source.groupBy("lang", "rule", "bucket").agg(F.sum("n").alias("n"))
    of_all = by_lang.groupBy("rule", "bucket").agg(F.sum("n").alias("n"))
    return (by_source.withColumn("level", F.lit(0))
            .unionByName(by_lang.withColumns({"source": none, "level": F.lit(1)}))
            .unionByName(of_all.withColumns({"lang": none, "source": none, "level": F.lit(2)})))


def quartiles(sketch: DataFrame) -> DataFrame:
    """Row count, first and third quartile per group of a sketch."""
    from pyspark.sql import Window

    own = Window.partitionBy("level", "lang", "source", "rule")
    ranked = sketch.withColumns({
        "upto": F.sum("n").over(own.orderBy("bucket")), "total": F.sum("n").over(own)})
    at = lambda share: F.min(F.when(F.col("upto") * 4 >= F.col("total") * share,
                                    bucket_top(F.col("bucket"))))
    return ranked.groupBy("level", "lang", "source", "rule").agg(
        F.max("total").alias("n"), at(1).alias("q1"), at(3).alias("q3"))


def cutoffs(sketch: DataFrame, fence: int = 3, least_rows: int = 200) -> DataFrame:
    """One row per language and source with a cutoff per rule. A source with fewer than
    ``least_rows`` texts takes the merged sketch of its language, a small language that of all."""
    q = quartiles(sketch)
    own, by_lang, of_all = (q.where(F.col("level") == i).alias(f"l{i}") for i in range(3))
    both = (own.join(by_lang, F.col("l0.lang").eqNullSafe(F.col("l1.lang"))
                     & (F.col("l0.rule") == F.col("l1.rule")))
            .join(of_all, F.col("l0.rule") == F.col("l2.rule")))
    pick = lambda c: (F.when(F.col("l0.n") >= least_rows, F.col(f"l0.{c}"))
                      .when(F.col("l1.n") >= least_rows, F.col(f"l1.{c}")).otherwise(F.col(f"l2.{c}")))
    chosen = both.select(F.col("l0.lang").alias("g_lang"), F.col("l0.source").alias("g_source"),
                         F.col("l0.rule").alias("rule"), pick("q1").alias("q1"), pick("q3").alias("q3"))

    def limit(r: str) -> Column:
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(RULES[r][3])) * fence
        value = F.col("q3") + spread if RULES[r][2] == "high" else F.col("q1") - spread
        return F.max(F.when(F.col("rule") == r, value)).alias(f"cut_{r}")

    return chosen.groupBy("g_lang", "g_source").agg(*[limit(r) for r in RULES])


def quality_rules(docs: DataFrame, fence: int = 3, least_rows: int = 200,
                  least_words: int = 50) -> DataFrame:
    """Measures and verdict of every document.

    ``base_failed`` marks texts with fewer than ``least_words`` words or with over half of
    their words in repeated windows. ``kept`` is false for those and for texts beyond a cutoff
    of their language and source; ``failed`` lists the rules. Texts without a word fail the
    base rules and enter no sketch. Repeated rows are judged each; an empty table gives none.
    The measures are written once to the shared folder, since sketches and verdict need them.
    """
    measured = materialise(measures(docs), "measures")
    cuts = cutoffs(sketches(measured), fence, least_rows)
    joined = measured.join(cuts, F.col("lang").eqNullSafe(F.col("g_lang"))
                           & F.col("source").eqNullSafe(F.col("g_source")), "left")
    base = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    beyond = {r: (ratio(r) > F.col(f"cut_{r}")) if RULES[r][2] == "high" else
              (ratio(r) < F.col(f"cut_{r}")) for r in RULES}
    failed = F.filter(F.array(*[F.when(c, F.lit(r)) for r, c in beyond.items()]),
                      lambda x: x.isNotNull())
    return (joined.withColumns({"base_failed": base, "failed": failed})
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
            .drop("g_lang", "g_source"))
