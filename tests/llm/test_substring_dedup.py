"""Repeated passages against all strings of the length."""

import collections
import hashlib
import os

import numpy as np
import pytest

from tests.conftest import SF, frame
from tidepanel.llm import substring_dedup as D
from tidepanel.llm.queries import QUERIES
from tidepanel.llm.suffix_arrays import MARK, common_prefixes, joined, suffix_array


def plain(texts, length):
    """(bytes, removed spans, bytes left) of each text, by counting every string of the length."""
    held = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i:i + length] for d in held for i in range(len(d) - length + 1))
    out = []
    for d in held:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.concatenate([[False], np.cumsum(gone)[:-1] > 0, [False]])
        turns = np.flatnonzero(gone[1:] != gone[:-1])
        spans = [(int(s), int(e)) for s, e in zip(turns[::2], turns[1::2])]
        out.append((len(d), spans, bytes(b for b, g in zip(d, gone[1:]) if not g)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    for _ in range(100):
        some = [bytes(rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(0, 30))).astype(np.uint8))
                for _ in range(int(rng.integers(0, 6)))]
        text, _ = joined(some + some[:1])
        order, symbols = suffix_array(text), text.tolist()
        assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])
        before, common = common_prefixes(text, order)
        for a, b in zip(order[1:], order[:-1]):
            n = 0
            while symbols[a + n] == symbols[b + n] > MARK:
                n += 1
            assert (before[a], common[a]) == (b, n)


def corpus(rng):
    """Texts that share passages, hold copies and repeat themselves."""
    letters = lambda n, k=26: "".join(chr(97 + x) for x in rng.integers(0, k, n))
    shared = [letters(int(n)) for n in rng.integers(50, 400, 4)]
    out = [letters(int(n)) for n in rng.integers(0, 300, 20)]
    out += [letters(int(rng.integers(0, 80))) + shared[int(rng.integers(4))] + letters(int(rng.integers(0, 80))) for _ in range(60)]
    long = letters(600)
    for _ in range(15):  # near copies with an edit each
        at = int(rng.integers(600))
        out.append(long[:at] + "é" + long[at + 1:])
    return out + [out[0], out[25], out[25], "ab" * 200, "a" * 300, letters(40) * 6, letters(70) + "ab" * 60]


@pytest.mark.parametrize("part", [256 << 10, 700])
def test_equal_to_all_strings(spark, monkeypatch, part):
    monkeypatch.setattr(D, "PART", part)
    monkeypatch.setattr(D, "SHARD", 2000)
    texts = corpus(np.random.default_rng(5))
    got = D.without_repeats(frame(spark, list(enumerate(texts)), "doc_id long, text string"), 64).collect()
    mine = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in got}
    assert mine == dict(enumerate(plain(texts, 64)))
    assert 40 < sum(bool(s) for _, s, _ in mine.values()) < len(texts)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {r.doc_id: (n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
            for r, (n, spans, kept) in zip(docs, plain([r.text for r in docs], 200))}
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op12_suffix_array_dedup"](spark, SF).collect()}
    assert got == want and any(v[1] for v in got.values())


def test_odd_rows(spark):
    a, b = "".join(chr(97 + i * i % 26) + str(i) for i in range(60)), "".join(chr(97 + i * 7 % 26) + str(i * 3) for i in range(60))
    rows = [(1, None, "x"), (2, "", "x"), (None, a, "x"), (3, a, "x"), (4, b, "y"), (5, "z" * 100_000, "y"), (5, "z" * 63, "y")]
    df = frame(spark, rows, "doc_id long, text string, owner string")
    got = sorted((r.doc_id or 0, r.n_bytes, len(r.kept), len(r.removed)) for r in D.without_repeats(df, 64).collect())
    assert got == sorted([(1, 0, 0, 0), (2, 0, 0, 0), (0, len(a), 0, 1), (3, len(a), 0, 1), (4, len(b), len(b), 0),
                          (5, 100_000, 0, 1), (5, 63, 63, 0)])
    twice = frame(spark, [(1, b, ""), (1, b, "")], "doc_id long, text string, kind string")
    assert [len(r.kept) for r in D.without_repeats(twice, 64).collect()] == [0, 0]
    assert D.without_repeats(df.limit(0)).count() == 0
