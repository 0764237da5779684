"""Suffix arrays by induced sorting, and the common prefixes that go with them, in numpy.

The text of a shard is several strings, each closed by a mark. Symbols are the bytes plus two,
the mark is 1 and the end of the text 0.

1. A suffix is smaller (S) or larger (L) than the next one; an S after an L is leftmost-smaller.
2. The substrings between leftmost-smaller places are sorted by inducing from any order of those
   places. Equal ones share a name; if names repeat, the text of names is sorted in turn. Its
   alphabet has no bound, so its suffixes are sorted by ranks of doubled length.
3. From the sorted leftmost-smaller suffixes all L suffixes are induced bucket by bucket in
   increasing order, then all S suffixes in decreasing order. A step takes all entries of a bucket
   that are known so far, so a shard costs a few array operations per symbol and bucket.
4. The common prefix with the suffix before it is kept in text order: where the symbols before
   both suffixes agree, it is one less than that of the place before, so only the others are
   compared.
"""

from __future__ import annotations

import numpy as np

MARK, END = 1, 0
_SYMBOLS = 258


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of the strings, and where each starts."""
    sizes = np.array([len(s) for s in strings], np.int64)
    start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    text = np.full(int((sizes + 1).sum()) + 1, MARK, np.uint16)
    inner = np.ones(len(text), bool)
    inner[start + sizes] = inner[-1] = False
    text[inner] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 2
    text[-1] = END
    return text, start


def smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last is."""
    n = len(text)
    rises = np.ones(n, bool)
    step = np.sign(text[1:].astype(np.int32) - text[:-1])
    # Equal neighbours are of the kind of the next change.
    change = np.where(step != 0, np.arange(n - 1), n - 1)
    next_change = np.minimum.accumulate(change[::-1])[::-1]
    rises[:-1] = np.append(step, 1)[next_change] > 0
    return rises


class _Induction:
    """Places suffixes in buckets of their first symbol."""

    def __init__(self, text: np.ndarray, rises: np.ndarray):
        self.text, self.rises = text, rises
        size = np.bincount(text, minlength=_SYMBOLS)
        self.end = np.cumsum(size)
        self.start = self.end - size
        self.out = np.full(len(text), -1, np.int32)

    def _before(self, block: np.ndarray, rises: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The suffixes one to the left of a block that are of the wanted kind, by bucket, in the
        block's order; their buckets, and their number within."""
        at = block - 1
        at = at[at >= 0]
        at = at[self.rises[at] == rises]
        symbol = self.text[at]
        order = np.argsort(symbol, kind="stable")
        at, symbol = at[order], symbol[order]
        return at, symbol, np.arange(len(at)) - np.searchsorted(symbol, symbol)

    def run(self, lms: np.ndarray) -> np.ndarray:
        """The suffix array from leftmost-smaller places in the order given."""
        own = np.bincount(self.text[lms], minlength=_SYMBOLS)
        symbol = self.text[lms]
        order = np.argsort(symbol, kind="stable")
        sorted_lms, symbol = lms[order], symbol[order]
        number = np.arange(len(lms)) - np.searchsorted(symbol, symbol)
        self.out[self.end[symbol] - own[symbol] + number] = sorted_lms
        head = self.start.copy()

        def larger(block):
            at, symbol, number = self._before(block, False)
            if len(at):
                self.out[head[symbol] + number] = at
                head[:] += np.bincount(symbol, minlength=_SYMBOLS)

        for c in np.flatnonzero(self.end > self.start):
            done = self.start[c]
            while done < head[c]:
                done, block = head[c], self.out[done:head[c]]
                larger(block)
            larger(self.out[self.end[c] - own[c]:self.end[c]])
        tail = self.end.copy()

        def lesser(block):
            at, symbol, number = self._before(block[::-1], True)
            if len(at):
                self.out[tail[symbol] - 1 - number] = at
                tail[:] -= np.bincount(symbol, minlength=_SYMBOLS)

        tail[END] -= 1  # the end of the text stays
        for c in np.flatnonzero(self.end > self.start)[::-1]:
            done = self.end[c]
            while done > tail[c]:
                done, block = tail[c], self.out[tail[c]:done]
                lesser(block)
            lesser(self.out[self.start[c]:head[c]])
        return self.out


def _equal(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` symbols from ``a`` and from ``b`` on agree."""
    words = np.ndarray(len(text), "<u8", np.append(text, np.zeros(4, np.uint16)).tobytes(), strides=(2,))
    equal, left, at = np.ones(len(a), bool), np.arange(len(a)), 0
    while len(left):
        rest = np.minimum(size[left] - at, 4).astype(np.uint64)
        differ = (words[a[left] + at] ^ words[b[left] + at]) << (np.uint64(64) - np.uint64(16) * rest)
        equal[left[differ != 0]] = False
        at += 4
        left = left[(differ == 0) & (size[left] > at)]
    return equal


def _ranked(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a text of names, by ranks of doubled length."""
    n, width = len(names), 1
    rank = names.astype(np.int64) + 1
    while True:
        key = rank * (n + 1)
        key[:n - width] += rank[width:]
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(True, key[1:] != key[:-1]))
        if rank[order[-1]] == n or width >= n:
            return order
        width *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The places of the text in the order of their suffixes."""
    rises = smaller(text)
    lms = np.flatnonzero(rises[1:] & ~rises[:-1]) + 1
    if not len(lms):
        return np.arange(len(text) - 1, -1, -1, dtype=np.int32)
    found = _Induction(text, rises).run(lms)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    placed = found[is_lms[found]]
    number = np.full(len(text), -1, np.int64)
    number[lms] = np.arange(len(lms))
    size = np.append(np.diff(lms) + 1, 1)[number[placed]]
    alike = size[1:] == size[:-1]
    alike[alike] = _equal(text, placed[1:][alike], placed[:-1][alike], size[1:][alike])
    names = np.empty(len(lms), np.int64)
    names[number[placed]] = np.cumsum(np.append(False, ~alike))
    ordered = lms[np.argsort(names)] if not alike.any() else lms[_ranked(names)]
    return _Induction(text, rises).run(ordered)


def common_prefixes(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the place whose suffix comes just before, and the length of the common
    prefix, which ends at a mark. The first suffix has none before it: -1 and 0."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    marks = np.flatnonzero(text <= MARK)
    left = marks[np.searchsorted(marks, np.arange(n))] - np.arange(n)  # symbols up to the mark
    known = before > 0
    known[0] = False
    at = np.flatnonzero(known)
    same = text[at - 1] == text[before[at] - 1]
    known[at] = same & (text[at - 1] > MARK)  # one less than at the place to the left
    starts = np.flatnonzero(~known & (before >= 0))
    length = np.zeros(n, np.int64)
    length[starts] = _common(text, starts, before[starts], np.minimum(left[starts], left[before[starts]]))
    origin = np.maximum.accumulate(np.where(known, -1, np.arange(n)))
    return before, np.maximum(length[origin] - (np.arange(n) - origin), 0)


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many symbols from ``a`` and from ``b`` on agree, up to ``most``."""
    words = np.ndarray(len(text), "<u8", np.append(text, np.zeros(4, np.uint16)).tobytes(), strides=(2,))
    out, open_, at = most.copy(), np.flatnonzero(most > 0), 0
    while len(open_):
        differ = words[a[open_] + at] ^ words[b[open_] + at]
        off = differ != 0
        low = differ[off] & (~differ[off] + np.uint64(1))
        place = at + (np.bitwise_count(low - np.uint64(1)).astype(np.int64) >> 4)
        out[open_[off]] = np.minimum(out[open_[off]], place)
        at += 4
        open_ = open_[~off]
        open_ = open_[out[open_] > at]
    return out
