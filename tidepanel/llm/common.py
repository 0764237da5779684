"""What the text operators share: folds, byte-sized slices of Arrow batches, hashed words."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.session import materialise

#: Rows of at most this size are worth a broadcast: 16 bytes each, 32 MB together.
BROADCAST_ROWS = 2_000_000


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no model learns from: crc32 of the id's digits leaves 1 when divided by 3.
    A null id is in no fold, so it is not held out."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
    return F.coalesce(fold == 1, F.lit(False))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, whatever else the table has."""
    return df.select(*[F.col(n) for n in names])


def is_few(rows: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table is small enough to travel to the other side of a join."""
    return rows.count() <= most


def _by_ids(df: DataFrame, ids: DataFrame, on: str, how: str) -> DataFrame:
    ids = materialise(ids.select(on).distinct(), "ids")
    return df.join(F.broadcast(ids) if is_few(ids) else ids, on, how)


def keep_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose id is in ``ids``. The ids travel to the texts when a count of them
    shows that they are few; otherwise both sides are shuffled. Either way gives the same rows."""
    return _by_ids(df, ids, on, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose id is null or not in ``ids``."""
    return _by_ids(df, ids, on, "left_anti")


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """A text column as UTF-8 bytes, null as empty."""
    return batch.column(column).cast(pa.binary()).fill_null(b"")


def slices(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most`` bytes of text each. A longer text is a run of its own."""
    sizes = np.asarray(pa.compute.binary_length(column), dtype=np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += int(n) + 1
    if start < len(sizes):
        yield start, len(sizes)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` neighbours in ``h``."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
    return mixed(out)


def small_table(spark, rows: list[dict], schema: str) -> DataFrame:
    """A table of a few given rows, as one literal of the plan."""
    fields = ", ".join(":".join(field.split()) for field in schema.split(","))
    held = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{fields}>>")
    return spark.range(1).select(F.inline(held))


def hash_slots(keys: np.ndarray) -> np.ndarray:
    """An open hash table of the places in ``keys``; -1 is free."""
    size = 1 << max(4, int(4 * len(keys)).bit_length())
    table = np.full(size, -1, np.int32)
    slot, left = _place(keys, size), np.arange(len(keys), dtype=np.int32)
    while len(left):
        free = table[slot] < 0
        table[slot[free]] = left[free]  # of several, the last one stays
        placed = table[slot] == left
        slot, left = (slot[~placed] + 1) & (size - 1), left[~placed]
    return table


def _place(keys: np.ndarray, size: int) -> np.ndarray:
    h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(65 - size.bit_length())).astype(np.int64)


def find_slots(table: np.ndarray, keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted key, -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int32)
    size = len(table)
    slot = _place(wanted, size)
    at = table[slot]
    open_ = np.flatnonzero((at >= 0) & (keys[at] != wanted))
    while len(open_):
        slot[open_] = (slot[open_] + 1) & (size - 1)
        at[open_] = table[slot[open_]]
        p = at[open_]
        open_ = open_[(p >= 0) & (keys[p] != wanted[open_])]
    return at
