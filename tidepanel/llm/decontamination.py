"""Benchmark decontamination by SimHash of item-sized windows.

Words are runs of letters and digits without case. A shingle is five words (all words of a
shorter item) and weighs as many characters as its words have.

1. Windows. A window similar enough to an item holds most of the item's weight, so it cannot
   lack all of a set of words through which more than the rest of that weight runs. Per item
   such anchor words are chosen, the longest of every stretch. Where an anchor stands in a
   document, the window of the item's length that would align with it is looked at. Equal
   windows are looked at once.
2. Fingerprints of 64 bits of windows and items by SimHash over the weighted shingles.
3. Multi-index: fingerprints are cut in blocks. Two that differ in at most ``RADIUS`` bits
   differ in at most ``RADIUS // BLOCKS`` bits of one block, so each block of an item is
   entered with all values that near, and a window is looked up by each of its own blocks.
   All pairs of window and item of its length within the radius are found.
4. The exact weighted similarity of the shingle sets decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import is_few, only
from tidepanel.session import materialise

WIDTH = 5
RADIUS = 19
#: Bits of each block of a fingerprint.
BLOCKS = (13, 13, 13, 13, 12)
#: An anchor is chosen from every so many words, the fewest that will do.
STRETCHES = (20, 10, 5, 1)


def _words(text: Column) -> Column:
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")


def _shingles(words: Column) -> Column:
    """Distinct shingles as (hash, weight) structs; ``words`` holds no empty word."""
    def one(i: Column) -> Column:
        joined = F.array_join(F.slice(words, i, F.lit(WIDTH)), " ")
        return F.struct(F.xxhash64(joined).alias("h"), F.length(joined).alias("w"))

    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - WIDTH + 1))
    return F.when(F.size(words) > 0, F.array_distinct(F.transform(places, one))) \
        .otherwise(F.array().cast("array<struct<h:bigint,w:int>>"))


def _fingerprint(shingles: Column) -> Column:
    """The sign of each bit's weighted vote."""
    votes = F.aggregate(
        shingles, F.array_repeat(F.lit(0), 64),
        lambda acc, s: F.transform(acc, lambda v, b: v + F.when(
            F.getbit(s["h"], b) == 1, s["w"]).otherwise(-s["w"])))
    return F.transform(votes, lambda v: (v > 0).cast("int"))


def _blocks(bits: Column) -> Column:
    """(block, value) of each block of a fingerprint."""
    out, at = [], 1
    for i, n in enumerate(BLOCKS):
        value = F.aggregate(F.slice(bits, at, n), F.lit(0), lambda a, b: a * 2 + b)
        out.append(F.struct(F.lit(i).alias("block"), value.alias("value")))
        at += n
    return F.array(*out)


def _near(value: Column) -> Column:
    """All values of a block that differ from ``value`` in at most the radius' share of bits."""
    flips = F.filter(F.sequence(F.lit(0), F.lit((1 << max(BLOCKS)) - 1)),
                     lambda x: F.bit_count(x) <= RADIUS // len(BLOCKS))
    return F.transform(flips, lambda x: value.bitwiseXOR(x))


def items(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, n, shingles, weight) of the items that have words."""
    rows = only(benchmark, "item_id", "text").select(
        "item_id", F.array_remove(_words(F.col("text")), "").alias("words")).where(F.size("words") > 0)
    rows = rows.distinct().withColumn("shingles", _shingles(F.col("words")))
    weight = F.aggregate("shingles", F.lit(0).cast("long"), lambda a, s: a + s["w"])
    return rows.select("item_id", "words", F.size("words").alias("n"), "shingles", weight.alias("weight"))


def anchors(item: DataFrame, percent: int) -> DataFrame:
    """(word, n, offset): the anchors of every item.

    From every stretch of words the one is chosen that is longest and stands in most shingles.
    A window without any of these words lacks all shingles with one of them; where that
    leaves room for the similarity, shorter stretches are taken, down to every word.
    """
    placed = item.select("item_id", "words", "n", F.posexplode("words").alias("at", "word"))
    met = F.least("at", F.col("n") - WIDTH) - F.greatest(F.col("at") - WIDTH + 1, F.lit(0)) + 1
    worth = F.length("word") * F.greatest(met, F.lit(1))
    parts = F.greatest(F.lit(1), F.floor(F.col("n") / F.col("stretch")))  # of about equal length
    chosen = (placed.withColumn("stretch", F.explode(F.array(*map(F.lit, STRETCHES))))
              .groupBy("item_id", "words", "n", "stretch", F.floor(F.col("at") * parts / F.col("n")))
              .agg(F.max(F.struct(worth.alias("worth"), "at", "word")).alias("x"))
              .groupBy("item_id", "words", "n", "stretch")
              .agg(F.collect_list("x.at").alias("ats"), F.collect_set("x.word").alias("marks")))
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - WIDTH + 1))
    own = F.array_distinct(F.transform(places, lambda i: F.slice("words", i, F.lit(WIDTH))))
    weight = lambda s: F.aggregate(
        s, F.lit(0), lambda a, x: a + F.length(F.array_join(x, " ")))
    covered = weight(F.filter(own, lambda x: F.arrays_overlap(x, "marks")))
    enough = chosen.where((F.col("stretch") == 1) | (covered * 100 > weight(own) * (100 - percent)))
    ats = enough.groupBy("item_id", "words", "n").agg(F.max_by("ats", "stretch").alias("ats"))
    return (ats.select("n", "words", F.explode("ats").alias("offset"))
            .select(F.element_at("words", F.col("offset") + 1).alias("word"), "n", "offset").distinct())


def windows(docs: DataFrame, anchor: DataFrame) -> DataFrame:
    """(doc_id, n, start, words) where an anchor stands, cut at the ends of the text."""
    at = docs.select("doc_id", F.posexplode(_words(F.col("text"))).alias("at", "word"))
    hits = materialise(at.join(anchor, "word").select(
        F.col("doc_id").alias("h_id"), "n", F.greatest(F.lit(0), F.col("at") - F.col("offset")).alias("start"))
        .distinct(), "hits")
    sent = F.broadcast(hits) if is_few(hits) else hits
    same = F.col("doc_id").eqNullSafe(F.col("h_id"))
    split = docs.join(sent, same, "left_semi").select("doc_id", _words(F.col("text")).alias("all"))
    cut = F.array_remove(F.slice("all", F.col("start") + 1, F.col("n")), "")
    return split.join(sent, same).select("doc_id", "n", "start", cut.alias("words"))


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, start, similarity): windows of documents, from word ``start``, whose
    weighted shingles are at least ``percent`` per cent similar to those of an item.

    Null texts and texts or items without words match nothing. Items with equal text are
    reported each; rows that share a document id, or have none, share their windows' places
    but each is compared by its own text. Other columns are ignored.
    """
    item = materialise(items(benchmark), "items")
    found = materialise(
        windows(only(docs, "doc_id", "text"), materialise(anchors(item, percent), "anchors"))
        .withColumn("key", F.md5(F.array_join("words", " "))), "windows")
    distinct = (found.where(F.size("words") > 0).groupBy("key", "n").agg(F.first("words").alias("words"))
                .withColumn("shingles", _shingles(F.col("words"))))
    marked = materialise(distinct.select("key", "n", "shingles", _fingerprint(F.col("shingles")).alias("bits")),
                         "fingerprints")
    index = (item.withColumn("bits", _fingerprint(F.col("shingles")))
             .select("item_id", "n", F.explode(_blocks(F.col("bits"))).alias("b"))
             .select("item_id", "n", "b.block", F.explode(_near(F.col("b.value"))).alias("value")))
    probes = marked.select("key", "n", F.explode(_blocks(F.col("bits"))).alias("b")).select("key", "n", "b.*")
    # Each item has hundreds of entries per block: the index is dealt out, never sent whole.
    near = probes.join(index.hint("merge"), ["n", "block", "value"]).select("key", "n", "item_id").distinct()
    full = (near.join(marked.select("key", "n", "shingles"), ["key", "n"])
            .join(item.select("item_id", F.col("shingles").alias("of_item"), "weight"), "item_id"))
    heavy = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, s: a + s["w"])
    shared = heavy(F.array_intersect("shingles", "of_item"))
    union = heavy(F.col("shingles")) + F.col("weight") - shared
    same = full.select("key", "n", "item_id", shared.alias("shared"), union.alias("union")) \
        .where(F.col("shared") * 100 >= F.col("union") * percent)
    return (found.join(same, ["key", "n"])
            .select("doc_id", "item_id", "start", (F.col("shared") / F.col("union")).alias("similarity")))


def contamination(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` its ``doc_id``, the ids of the items found in it, the highest
    similarity and whether there is one (``contaminated``)."""
    found = (matches(docs, benchmark, percent).groupBy(F.col("doc_id").alias("m_id"))
             .agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("similarity").alias("similarity")))
    rows = docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("m_id")), "left")
    none = F.array().cast(f"array<{dict(benchmark.dtypes)['item_id']}>")
    return rows.select("doc_id", F.coalesce("items", none).alias("items"),
                       F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
                       F.col("items").isNotNull().alias("contaminated"))
