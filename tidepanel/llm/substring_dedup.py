"""Repeated passages by suffix arrays of shards.

A byte goes if it lies in a string of ``length`` bytes (a window) that also starts anywhere else.

1. Each window is owned by one place in it: where, of the hashes of its runs of ``GRAM`` bytes, the
   least starts. Windows that follow each other mostly share their owner; the text they cover is a
   snippet. Every window is in one snippet, and equal windows have owners with equal hashes, so
   only snippets with the same owner hash, a group, can share windows.
2. Groups of one snippet need no more. Equal snippets are one class; the windows of a class with
   several members all repeat, so their places are known without comparing.
3. Of groups with several classes, one snippet of each class is cut from its text and dealt to
   the shards, whole groups together. A shard's suffix array, made by induced sorting, and its
   common prefixes give the windows that repeat. A group beyond ``PART`` bytes is dealt to several
   shards; these also hand on a hash of each different window, which a count joins.
4. Places found are gathered by text, where the bytes that are left are put together.

Hashes of owners, classes and windows have 128 bits together. Texts are told apart by 84 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import mixed, only, slices, texts
from tidepanel.llm.periodic_runs import window_minima
from tidepanel.llm.suffix_arrays import common_prefixes, joined, suffix_array
from tidepanel.session import materialise

#: Bytes of a run that can own a window.
GRAM = 32
#: Bytes of snippets in a shard, and of the part of a group that one shard holds, about.
SHARD, PART = 1 << 20, 3 << 19
#: Bytes of text hashed together.
HELD = 1 << 20
_SIZE_BITS, _SECOND_BITS = 11, 20
_LOW = np.uint64(0xFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: A random value for each byte.
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)


def _doubled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of strings of twice the width."""
    out = h[:-width] * _ODD + h[width:] if len(h) > width else h[:0]
    return out ^ (out >> np.uint64(29))


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` bytes, a power of two."""
    h, size = _BYTES[data], 1
    while size < width:
        h, size = _doubled(h, size), 2 * size
    return h


def window_hashes(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the ``length`` bytes from each place on."""
    width = 1 << (length.bit_length() - 1)
    h = gram_hashes(data, width)
    one, two = h[at], h[at + length - width]
    return mixed(one * _ODD + two).view(np.int64), mixed(two * _ODD ^ one).view(np.int64)


def snippets(data: np.ndarray, sizes: np.ndarray, length: int):
    """(text, start in the text, size, owner hash, class hash) of the snippets of texts that lie
    one after the other in ``data``."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    h = gram_hashes(data, GRAM)
    values = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    owner = (window_minima(values, length - GRAM + 1) & _LOW).astype(np.int64)
    # Windows that lie within a text.
    marks = np.zeros(len(data) + 1, np.int64)
    whole = sizes >= length
    marks[begins[whole]] += 1
    marks[ends[whole] - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(marks)[:len(owner)] > 0)
    if not len(at):
        return (np.zeros(0, np.int64),) * 5
    text = np.searchsorted(ends, at, side="right")
    turns = np.flatnonzero((owner[at[1:]] != owner[at[:-1]]) | (text[1:] != text[:-1])) + 1
    first, last = at[np.append(0, turns)], at[np.append(turns, len(at)) - 1]
    size, text = last - first + length, text[np.append(0, turns)]
    # Four strings of a power of two cover a snippet.
    width = 1 << (length.bit_length() - 1)
    h_wide = h
    for w in (1 << k for k in range(GRAM.bit_length() - 1, width.bit_length() - 1)):
        h_wide = _doubled(h_wide, w)
    kind = size.astype(np.uint64)
    for k in range(4):
        kind = mixed(kind * _ODD + h_wide[first + (size - width) * k // 3])
    return text, first - begins[text], size, mixed(h[owner[first]]).view(np.int64), kind.view(np.int64)


def _marks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = texts(batch)
        t, u = (np.asarray(batch.column(c), np.int64) for c in ("t", "u"))
        for start, end in slices(column, HELD):
            own = column[start:end].to_pylist()
            sizes = np.array([len(x) for x in own], np.int64)
            text, lo, size, owner, kind = snippets(np.frombuffer(b"".join(own), np.uint8), sizes, length)
            place = (u[start + text] << (63 - _SECOND_BITS)) | (lo << _SIZE_BITS) | size
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (owner, kind, t[start + text], place)],
                                             names=["owner", "kind", "t", "place"])


def _places(df: DataFrame, *keep: str) -> DataFrame:
    """``place`` taken apart: the second key of the text, start and size."""
    lo_bits = 63 - _SECOND_BITS - _SIZE_BITS
    return df.select(*keep, "t", F.shiftright("place", 63 - _SECOND_BITS).alias("u"),
                     F.shiftright("place", _SIZE_BITS).bitwiseAND((1 << lo_bits) - 1).alias("start"),
                     F.col("place").bitwiseAND((1 << _SIZE_BITS) - 1).alias("size"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted snippets of each text; of neighbouring rows with one text, the first gives them."""
    last = None
    for batch in batches:
        column, wanted = texts(batch), batch.column("wanted")
        keys = list(zip(batch.column("t").to_pylist(), batch.column("u").to_pylist()))
        for start, end in slices(column):
            out = []
            for i in range(start, end):
                if keys[i] != last:
                    last, data = keys[i], column[i].as_py()
                    out += [{**w, "t": last[0], "u": last[1], "data": data[w["start"]:w["start"] + w["size"]]}
                            for w in wanted[i].as_py()]
            yield pa.RecordBatch.from_pylist(out, schema=_CUT)


_CUT = pa.schema([("owner", pa.int64()), ("part", pa.int64()), ("kind", pa.int64()), ("split", pa.bool_()),
                  ("single", pa.bool_()), ("t", pa.int64()), ("u", pa.int64()), ("start", pa.int64()),
                  ("data", pa.binary())])
_FOUND = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("t", pa.int64()), ("u", pa.int64()),
                    ("start", pa.int64()), ("end", pa.int64()), ("known", pa.bool_())])


def _arrays(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Shards of whole groups, in the order of the groups."""
    held, size, last = [], 0, None
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["owner"], row["part"])
            if held and size >= SHARD and key != last:
                yield from _shard(held, length)
                held, size = [], 0
            if held and key == last and row["kind"] == held[-1]["kind"]:
                continue  # the class was cut from another copy of its text as well
            held.append(row)
            size, last = size + len(row["data"]), key
    if held:
        yield from _shard(held, length)


def _shard(rows: list[dict], length: int) -> Iterator[pa.RecordBatch]:
    """Known places of windows that repeat (without hashes), and the different windows of split
    groups with their hashes."""
    text, begin = joined([r["data"] for r in rows])
    before, common = common_prefixes(text, suffix_array(text))
    column = lambda name, kind=np.int64: np.array([r[name] for r in rows], kind)
    t, u, start, split, single = (column("t"), column("u"), column("start"), column("split", bool), column("single", bool))
    repeats = np.zeros(len(text), bool)
    second = np.flatnonzero(common >= length)
    repeats[second] = repeats[before[second]] = True
    owner = np.searchsorted(begin, np.arange(len(text)), side="right") - 1
    at = np.flatnonzero(repeats)
    at = at[single[owner[at]]]
    if len(at):
        turns = np.flatnonzero((np.diff(at) > length) | (np.diff(owner[at]) != 0)) + 1
        first, end = at[np.append(0, turns)], at[np.append(turns, len(at)) - 1] + length
        k = owner[first]
        off = start[k] - begin[k]
        none = pa.nulls(len(k), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, pa.array(t[k]), pa.array(u[k]), pa.array(first + off), pa.array(end + off),
             pa.array(np.ones(len(k), bool))], schema=_FOUND)
    sizes = np.array([len(r["data"]) for r in rows])
    within = np.arange(len(text)) - begin[owner]
    heads = np.flatnonzero(split[owner] & (within + length <= sizes[owner]) & (common < length))
    if len(heads):
        data = np.maximum(text, 2).astype(np.int64) - 2
        one, two = window_hashes(data.astype(np.uint8), heads, length)
        k = owner[heads]
        place = start[k] + within[heads]
        yield pa.RecordBatch.from_arrays(
            [pa.array(one), pa.array(two), pa.array(t[k]), pa.array(u[k]), pa.array(place), pa.array(place + length),
             pa.array(repeats[heads] | ~single[k])], schema=_FOUND)


def _left(data: bytes, spans: list[dict]) -> tuple[list[tuple[int, int]], bytes]:
    """Spans merged where they touch, and the bytes outside them."""
    merged: list[list[int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    ends = [0, *[x for m in merged for x in m], len(data)]
    return [tuple(m) for m in merged], b"".join(data[s:e] for s, e in zip(ends[::2], ends[1::2]))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = texts(batch)
        for start, end in slices(column):
            rows = [(d, *_left(d, s or [])) for d, s in zip(
                column[start:end].to_pylist(), batch.column("spans")[start:end].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[start:end], pa.array([len(d) for d, _, _ in rows], pa.int64()),
                 pa.array([[{"start": s, "end": e} for s, e in m] for _, m, _ in rows], _SPANS),
                 pa.array([k for _, _, k in rows], pa.binary()),
                 pa.array([hashlib.sha256(k).hexdigest() for _, _, k in rows])],
                names=["doc_id", "n_bytes", "removed", "kept", "kept_sha256"])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def without_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``removed`` (start and end of the byte spans that repeat), ``kept``
    (the bytes outside them, joined) and ``kept_sha256``.

    A null text is empty; a text shorter than ``length`` (at least 64, at most 1,000) keeps
    all. Rows are documents of their own even if they repeat, ids and texts alike, so a text of
    two equal rows goes from both. Null ids stay. Other columns are ignored; an empty table gives
    no rows. What is kept may end within a character, so it is binary.
    """
    if not 2 * GRAM <= length <= 1000:
        raise ValueError("length must be from 64 to 1,000")
    kind = dict(docs.dtypes)["doc_id"]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = only(docs, "doc_id", "text").select(
        "doc_id", text.alias("text"), F.xxhash64(text).alias("t"),
        F.pmod(F.xxhash64(F.lit(1), text), F.lit(1 << _SECOND_BITS)).alias("u"))
    marks = materialise(rows.select("t", "u", "text").where(F.octet_length("text") >= length).mapInArrow(
        lambda b: _marks(b, length), "owner long, kind long, t long, place long"), "marks")
    several = materialise(marks.groupBy("owner").agg(F.count("*").alias("n")).where("n > 1").select("owner"), "owners")
    again = materialise(marks.join(several, "owner", "left_semi"), "again")
    classes = materialise(_places(
        again.groupBy("owner", "kind").agg(F.count("*").alias("n"), F.min(F.struct("t", "place")).alias("r"))
        .select("owner", "kind", "n", "r.*"), "owner", "kind", "n"), "classes")

    groups = classes.groupBy("owner").agg(F.count("*").alias("classes"), F.sum("size").alias("bytes")).where("classes > 1")
    parts = F.ceil(F.col("bytes") / PART)
    mixed_groups = materialise(classes.join(groups, "owner").select(
        "owner", "kind", "t", "u", "start", "size", (F.col("n") == 1).alias("single"),
        F.pmod("kind", parts).alias("part"), (parts > 1).alias("split")), "mixed")
    found = materialise(_in_shards(rows, mixed_groups, length), "found")

    hashes = found.where("h1 is not null")
    met = hashes.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    late = hashes.where("not known").join(met, ["h1", "h2"], "left_semi")
    whole = classes.where("n > 1").select("owner", "kind")
    copied = _places(again.join(whole, ["owner", "kind"], "left_semi"))
    span = ["t", "u", "start", "end"]
    spans = (found.where("h1 is null").select(*span).unionAll(late.select(*span))
             .unionAll(copied.select("t", "u", "start", (F.col("start") + F.col("size")).alias("end"))))
    by_text = spans.groupBy("t", "u").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return rows.join(by_text, ["t", "u"], "left").select("doc_id", "text", "spans").mapInArrow(
        _kept, f"doc_id {kind}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary, "
        "kept_sha256 string")


def _in_shards(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """What the suffix arrays of the wanted snippets find."""
    shards = 1 + (wanted.agg(F.sum("size")).first()[0] or 0) // SHARD
    lists = wanted.groupBy("t", "u").agg(F.collect_list(F.struct(
        "owner", "part", "kind", "split", "single", "start", "size")).alias("wanted"))
    ddl = lambda schema: ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)
    cut = rows.select("t", "u", "text").join(lists, ["t", "u"]).mapInArrow(_cut, ddl(_CUT))
    dealt = cut.repartition(shards, "owner", "part").sortWithinPartitions("owner", "part", "kind")
    return dealt.mapInArrow(lambda b: _arrays(b, length), ddl(_FOUND))


_DDL = {pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary"}
