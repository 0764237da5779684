"""Near duplicates by bottom-k sketches of word shingles.

A text's sketch is the ``k`` smallest hashes of its shingles under one hash function; for two
texts, the ``k`` smallest of both sketches are a sample of the union of their shingles, and
the share of it that both hold estimates their similarity.

1. Texts with equal shingle sets are one class; only its representative goes on.
2. Inverted lists: the classes that retain each value. Texts similar enough share at least
   ``overlap`` retained values (but for a chance under one in a billion), so they also share
   one of the rarest ``size - overlap + 1`` of either; each class enters those lists only.
   A value that nobody else retains makes no list, yet takes up one of these places.
3. Each list links its members to its most typical one, so pairs grow with the lists' length,
   not its square. The union sketch filters the pairs, the full sets confirm them.
4. A list may still hold several components. Members of short lists are then paired, filtered
   and confirmed like the others. Of long lists, members with enough shingles in common with
   others go on: those outside the list's largest component meet all members in blocks of bounded
   size. A task counts the common shingles of two blocks by matrix products and hands on what
   ties its components together, so no pairs are emitted.

Shingles are 64-bit hashes throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import keep_ids, mixed, only, shingle_hashes, slices, texts, word_hashes
from tidepanel.llm.components import components
from tidepanel.session import materialise

#: Retained values per text.
K = 32
#: Lists of at most so many members are compared pair by pair.
SHORT = 32
#: Members and shingles of a block of a long list, about, and shingles counted at a time.
MEMBERS, SHINGLES, COUNTED = 1024, 1 << 18, 4096


def least_overlap(k: int, similarity: float, miss: float = 1e-9) -> int:
    """The overlap that the union sketch of two similar texts reaches but for chance ``miss``."""
    below, n = 0.0, -1
    while below <= miss and n < k:
        n += 1
        below += math.comb(k, n) * similarity ** n * (1 - similarity) ** (k - n)
    return max(1, n)


def shingle_sets(values: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: words without case of A-Z, the whole
    sequence where there are fewer words than ``width``."""
    words = [v.lower().split() for v in values]  # bytes split at space and 09 to 0D
    h, out, at = word_hashes([w for own in words for w in own]), [], 0
    for own in words:
        mine = h[at:at + len(own)]
        at += len(own)
        out.append(np.unique(shingle_hashes(mine, min(width, len(own)))) if own else mine)
    return out


def _arrays(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _sketches(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column, ids = texts(batch), batch.column("doc_id")
        for start, end in slices(column):
            sets = shingle_sets(column[start:end].to_pylist(), width)
            one = [int(s.sum(dtype=np.uint64).view(np.int64)) for s in sets]
            two = [int(mixed(s + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [ids[start:end], pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), _arrays([s[:k] for s in sets])],
                names=["doc_id", "n_shingles", "s1", "s2", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column, ids = texts(batch), batch.column("doc_id")
        for start, end in slices(column):
            yield pa.RecordBatch.from_arrays(
                [ids[start:end], _arrays(shingle_sets(column[start:end].to_pylist(), width))],
                names=["id", "shingles"])


def _similar(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return shared * 100 >= (a + b - shared) * percent


def _confirmed(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, k: int, overlap: int,
               percent: int) -> DataFrame:
    """The pairs (a, b) that the union sketch lets through and the full sets confirm."""
    own = lambda s, c: sketches.select(F.col("id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in s])
    near = pairs.join(own(["n", "sketch"], "a"), "a").where("n_a is not null")
    near = near.join(own(["n", "sketch"], "b"), "b")
    near = near.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    both = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    need = F.least(F.lit(overlap), F.ceil(F.size(union) * percent / 100))
    near = near.where(both >= need).select("a", "b")
    full = lambda c: sets.select(F.col("id").alias(c), F.col("shingles").alias(f"set_{c}"))
    held = near.join(full("a"), "a").join(full("b"), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return held.where(_similar(shared, F.size("set_a"), F.size("set_b"), percent)).select("a", "b")


def _lists(classes: DataFrame, k: int, overlap: int, percent: int) -> DataFrame:
    """(value, id, n, weight): the lists of each class, ``weight`` its typicality."""
    retained = classes.select("id", F.explode("sketch").alias("value"))
    df = retained.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    met = (retained.join(df, "value").groupBy("id")
           .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("met"),
                F.sum(F.log("df")).alias("weight")))
    size = F.size("sketch")
    places = size - F.least(F.lit(overlap), F.ceil(size * percent / 100)) + 1
    left = (places - (size - F.size("met"))).cast("int")
    return (met.join(classes, "id").where(left > 0)
            .select("id", "n", "weight", F.explode(F.slice("met", F.lit(1), left)).alias("m"))
            .select("id", "n", "weight", F.col("m.value").alias("value"), F.col("m.df").alias("df")))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable over links of at
    least ``percent`` per cent similarity) and ``kept`` (the id is the component's).

    Null or empty text, or text without words, has no shingles and no links. A null id is
    linked with nothing: its component is null and it is kept. Rows that repeat an id are one
    node, so links of any of them count for all. Other columns are ignored; an empty table
    gives no rows.
    """
    overlap = least_overlap(k, percent / 100)
    rows = only(docs, "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    stored = materialise(rows.mapInArrow(
        lambda b: _sketches(b, width, k),
        f"doc_id {kind}, n_shingles long, s1 long, s2 long, sketch array<long>"), "sketches")
    some = stored.where("n_shingles > 0 and doc_id is not null")
    classes = (some.groupBy("n_shingles", "s1", "s2")
               .agg(F.min("doc_id").alias("id"), F.first("sketch").alias("sketch")))
    classes = materialise(classes.withColumnRenamed("n_shingles", "n"), "classes")
    member = classes.select(F.col("n").alias("n_shingles"), "s1", "s2", F.col("id").alias("class_id"))

    lists = _lists(classes, k, overlap, percent)
    shared = lists.groupBy("value").agg(
        F.count("*").alias("members"), F.max_by("id", F.struct("weight", -F.col("id"))).alias("center"))
    lists = materialise(lists.join(shared.where("members > 1"), "value")
                        .select("value", "id", "n", "weight", "center"), "lists")
    sets = materialise(keep_ids(rows.withColumnRenamed("doc_id", "id"), lists, "id")
                       .withColumnRenamed("id", "doc_id")
                       .mapInArrow(lambda b: _sets(b, width), f"id {kind}, shingles array<long>"), "sets")

    pairs = lists.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    # Rows that repeat an id tie the classes they are in.
    ties = (some.join(member, ["n_shingles", "s1", "s2"]).where("doc_id <> class_id")
            .select(F.col("class_id").alias("a"), F.col("doc_id").alias("b")))
    links = _confirmed(pairs, classes, sets, k, overlap, percent).unionByName(ties)
    found = materialise(components(materialise(links, "links")), "components")
    confirmed = lambda pairs: _confirmed(pairs, classes, sets, k, overlap, percent)
    ids = _across(lists, found, sets, percent, confirmed)
    return (stored.join(ids, stored["doc_id"] == ids["id"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: each component counts as one id, so few links are left."""
    def of(rows: DataFrame, end: str) -> DataFrame:
        own = found.select(F.col("id").alias("k"), "component")
        return (rows.join(own, F.col(end) == F.col("k"), "left")
                .withColumn(end, F.coalesce("component", end)).drop("k", "component"))

    ends = links.select(F.explode(F.array("a", "b")).alias("id"))
    every = found.unionByName(ends.join(found, "id", "left_anti").distinct()
                              .select("id", F.col("id").alias("component")))
    top = components(of(of(links, "a"), "b").distinct()).select(F.col("id").alias("k"), F.col("component").alias("top"))
    return (every.join(top, F.col("component") == F.col("k"), "left")
            .select("id", F.coalesce("top", "component").alias("component")))


def _across(lists: DataFrame, found: DataFrame, sets: DataFrame, percent: int, confirmed) -> DataFrame:
    """Components after the links between members of lists that the centers left apart."""
    # Lists with one center are one list.
    rows = materialise(_apart(lists.select(F.col("center").alias("key"), "id", "n", "weight").distinct(), found), "apart")
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"))
    short = rows.join(sizes.where(F.col("size") <= SHORT), "key")
    found = materialise(_joined(found, materialise(confirmed(_pairs(short, percent)), "links")), "components")
    rows = _apart(rows.join(sizes.where(F.col("size") > SHORT).select("key"), "key"), found)
    # A class with a partner has enough shingles in common with others; only such go on.
    active = materialise(rows.select("id", "n").distinct(), "active")
    held = sets.join(active, "id").select("id", "n", F.explode("shingles").alias("shingle"))
    often = held.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1").select("shingle")
    able = materialise(held.join(often, "shingle").groupBy("id", "n").agg(F.count("*").alias("common"))
                       .where(F.col("common") * 100 >= F.col("n") * percent).select("id"), "able")
    rows = rows.join(able, "id", "left_semi")
    rows = materialise(_apart(rows, found), "apart")
    return _joined(found, materialise(_in_blocks(rows, sets, percent), "links"))


def _pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Members (a, b) of one short list that are in different components and near in size."""
    a, b = lists.alias("a"), lists.alias("b")
    near = F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent
    apart = (F.col("a.id") < F.col("b.id")) & (F.col("a.component") != F.col("b.component"))
    return (a.join(b, (F.col("a.key") == F.col("b.key")) & apart & near)
            .select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct())


def _apart(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Members with their component, of lists that hold several."""
    tagged = lists.drop("component").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = (tagged.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
               .where("lo <> hi").select("key"))
    return tagged.join(several, "key", "left_semi")


def _in_blocks(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that tie the components of lists: members outside a list's largest component
    meet all of it, block by block."""
    blocks = lambda m, n: F.ceil(F.greatest(m / MEMBERS, n / SHINGLES)).cast("int")
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("m"), F.sum("n").alias("shingles"))
    lists = sizes.groupBy("key").agg(
        F.max(F.struct("m", "component", "shingles")).alias("most"), F.sum("m").alias("m"), F.sum("shingles").alias("s"))
    lists = lists.select("key", F.col("most.component").alias("main"), blocks(F.col("m"), F.col("s")).alias("all"),
                         blocks(F.col("m") - F.col("most.m"), F.col("s") - F.col("most.shingles")).alias("outside"))
    placed = rows.select("key", "id", "component").join(lists, "key").join(sets, "id")
    slot = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    names = ["key", "l", "r", "id", "component", "shingles"]
    left = placed.where("component <> main").withColumn("l", slot("outside")).withColumn("r", every("all")).select(
        *[F.col(c).alias(c) for c in names])
    right = placed.withColumn("r", slot("all")).withColumn("l", every("outside")).select(names)
    kind = dict(rows.dtypes)["id"]
    return left.groupBy("key", "l", "r").cogroup(right.groupBy("key", "l", "r")).applyInArrow(
        lambda a, b: _compared(a, b, percent), f"a {kind}, b {kind}")


def _compared(left: pa.Table, right: pa.Table, percent: int) -> pa.Table:
    """Of the similar pairs of two blocks, as many as tie together the components they link."""
    a, b = left["shingles"].combine_chunks(), right["shingles"].combine_chunks()
    flat = [np.asarray(x.flatten()) for x in (a, b)]
    n = [np.asarray(pa.compute.list_value_length(x)).astype(np.int64) for x in (a, b)]
    met = np.intersect1d(*flat)
    sides = []  # member and place in ``met`` of each shingle that both blocks have, by place
    for values, sizes in zip(flat, n):
        at = np.searchsorted(met, values)
        known = np.flatnonzero(met[np.minimum(at, len(met) - 1)] == values) if len(met) else at[:0]
        order = known[np.argsort(at[known], kind="stable")]
        sides.append((np.repeat(np.arange(len(sizes)), sizes)[order], at[order]))
    shared = np.zeros((len(a), len(b)))
    for lo in range(0, len(met), COUNTED):
        held = []
        for (member, at), sizes in zip(sides, n):
            part = slice(*np.searchsorted(at, [lo, lo + COUNTED]))
            one = np.zeros((len(sizes), min(COUNTED, len(met) - lo)), np.float32)
            one[member[part], at[part] - lo] = 1
            held.append(one)
        shared += held[0] @ held[1].T
    codes = pa.chunked_array([*left["component"].chunks, *right["component"].chunks]).combine_chunks() \
        .dictionary_encode().indices.to_numpy()
    own, other = codes[:len(a)], codes[len(a):]
    near = (shared * 100 >= (n[0][:, None] + n[1][None, :] - shared) * percent) & (own[:, None] != other[None, :])
    i, j = np.nonzero(near)
    first = np.unique(own[i].astype(np.int64) << 32 | other[j], return_index=True)[1]
    top = list(range(int(codes.max(initial=-1)) + 1))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    kept = []
    for k in first.tolist():
        x, y = root(int(own[i[k]])), root(int(other[j[k]]))
        if x != y:
            top[x] = y
            kept.append(k)
    return pa.table({"a": left["id"].take(pa.array(i[kept])), "b": right["id"].take(pa.array(j[kept]))})
