"""Token counts from pre-token counts.

A text's tokens are the tokens of its pre-tokens, so each distinct pre-token is tokenised once
and its count is joined to the pre-token frequencies of the documents; no ids are built.

Frequent pre-tokens are most of the rows of such a join. They are found by counting, tokenised
once on Spark, and their counts travel to the documents as a dictionary of bounded size; the
frequencies of all others are shuffled by pre-token and meet their count there. Which
pre-tokens are in the dictionary changes the cost only, never the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import only, slices, texts

#: Fixed value: the byte-level splitting pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters every version of Unicode classes alike; other texts are split by the library.
SETTLED = regex.compile(r"[^\u0000-ɏ‐-‧‰-⁞₠-€]")
#: The dictionary: entries at most, their length in characters, the least local count.
ENTRIES, LONGEST, LEAST = 1 << 18, 48, 4
_loaded: dict = {}


def _tokenizer(path: str):
    if path not in _loaded:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        special = [a.content for a in t.get_added_tokens_decoder().values()]
        cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        _loaded[path] = t, cut, set(special), regex.compile(PATTERN)
    return _loaded[path]


def _plain(path: str, text: str) -> list[str]:
    """The pre-tokens of a text without special strings."""
    t, _, _, pattern = _tokenizer(path)
    if not SETTLED.search(text):
        return pattern.findall(text)
    return [text[a:b] for _, (a, b) in t.pre_tokenizer.pre_tokenize_str(text)]


def pieces(path: str, text: str) -> Counter:
    """How often a text has each pre-token. A special string is a piece of its own, which the
    library turns to one id wherever it stands."""
    _, cut, _, _ = _tokenizer(path)
    if cut is None or not cut.search(text):
        return Counter(_plain(path, text))
    out = Counter()
    for part in cut.split(text):
        out.update([part] if cut.fullmatch(part) else _plain(path, part))
    out.pop("", None)
    return out


def lengths(path: str, found: list[str]) -> list[int]:
    """Tokens of each piece."""
    t = _tokenizer(path)[0]
    return [len(e.ids) for e in t.encode_batch(found, add_special_tokens=False)]


def _frequent(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Pieces a task sees often, with counts. Rare ones are given up when many are held."""
    held: Counter = Counter()
    for batch in batches:
        column = texts(batch)
        for start, end in slices(column):
            for value in column[start:end].to_pylist():
                held.update(pieces(path, value.decode("utf-8", "replace")))
            if len(held) > 2 * ENTRIES:
                held = Counter({k: n for k, n in held.items() if n >= LEAST})
                if len(held) > ENTRIES:
                    held = Counter(dict(held.most_common(ENTRIES // 2)))
    often = [(k, n) for k, n in held.items() if n >= LEAST and len(k) <= LONGEST]
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in often], pa.string()),
                                      pa.array([n for _, n in often], pa.int64())],
                                     names=["piece", "n"])


def _sized(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("piece"), pa.array(lengths(path, batch.column("piece").to_pylist()), pa.int64())],
            names=["piece", "tokens"])


def dictionary(docs: DataFrame, path: str) -> dict[str, int]:
    """Token counts of the frequent pieces, at most ``ENTRIES`` of ``LONGEST`` characters."""
    seen = only(docs, "text").mapInArrow(lambda b: _frequent(b, path), "piece string, n long")
    top = seen.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(ENTRIES)
    sized = top.select("piece").mapInArrow(lambda b: _sized(b, path), "piece string, tokens long")
    found = sized.toArrow()
    return dict(zip(found["piece"].to_pylist(), found["tokens"].to_pylist()))


def _frequencies(batches: Iterator[pa.RecordBatch], path: str, known) -> Iterator[pa.RecordBatch]:
    """A row with what the dictionary covers of a document, and a row per other piece."""
    sizes = known.value
    for batch in batches:
        column, rows, ids = texts(batch), batch.column("row"), batch.column("doc_id")
        for start, end in slices(column):
            out: list[tuple] = []
            for row, key, value in zip(rows[start:end].to_pylist(), ids[start:end].to_pylist(),
                                       column[start:end].to_pylist()):
                covered = 0
                for p, k in pieces(path, value.decode("utf-8", "replace")).items():
                    size = sizes.get(p)
                    if size is None:
                        out.append((row, None, None, p, k))
                    else:
                        covered += k * size
                out.append((row, key, len(value), None, covered))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), ids.type, pa.int64(),
                                                            pa.string(), pa.int64()))],
                names=["row", "doc_id", "n_bytes", "piece", "n"])


def _weighed(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by piece: each distinct piece is tokenised once, carried over a batch's end."""
    last, size = None, 1
    for batch in batches:
        piece = batch.column("piece").to_pylist()
        fresh = [p for i, p in enumerate(piece)
                 if p is not None and p != (piece[i - 1] if i else last)]
        sizes = iter(lengths(path, fresh))
        tokens = []
        for p, k in zip(piece, batch.column("n").to_pylist()):
            if p is not None and p != last:
                last, size = p, next(sizes)
            tokens.append(k if p is None else k * size)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("row", "doc_id", "n_bytes")] + [pa.array(tokens, pa.int64())],
            names=["row", "doc_id", "n_bytes", "tokens"])


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Per document ``n_bytes`` (UTF-8), ``n_tokens`` and whether they exceed ``limit``.

    ``path`` is a ``tokenizers`` file with byte-level pre-tokens. Null text counts as empty and
    has no tokens. Rows are told apart by their place in the input, so repeated rows and null
    ids give a row each, and other columns are ignored. An empty table gives no rows.
    """
    known = docs.sparkSession.sparkContext.broadcast(dictionary(docs, path))
    rows = only(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    own = f"row long, doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long"
    frequencies = rows.mapInArrow(lambda b: _frequencies(b, path, known), f"{own}, piece string, n long")
    # A piece that is too long for the dictionary, yet frequent, is spread over some places.
    spread = F.when(F.length("piece") > LONGEST, F.col("row") % 64)
    place = F.xxhash64(F.coalesce(F.col("piece"), F.col("row").cast("string")), spread)
    return (frequencies.repartition(place).sortWithinPartitions("piece")
            .mapInArrow(lambda b: _weighed(b, path), f"{own}, tokens long")
            .groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
                                F.sum("tokens").alias("n_tokens"))
            .drop("row").withColumn("over_limit", F.col("n_tokens") > limit))
