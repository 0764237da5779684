"""Plain versions of the operators, one text after the other."""

import collections
import functools
import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quality(text):
    w = WORD.findall(text)
    runs = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if runs[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            len(lines) - len(set(lines)), len(covered))


def quality_verdicts(rows, rules, fence=3, least=200):
    """Kept ids by exact sketches: rows are (id, lang, source, text)."""
    def bucket_top(v):
        e = max(0, v.bit_length() - 7)
        return (((v >> e) + 1) << e) - 1

    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    held = {i: dict(zip(names, quality(t or ""))) for i, _, _, t in rows}
    ratio = lambda m, r: m[rules[r][0]] * 1000 // (m[rules[r][1]] + rules[r][4]) if m[rules[r][1]] else None
    groups = collections.defaultdict(list)
    for i, lang, source, _ in rows:
        for r in rules:
            v = ratio(held[i], r)
            if v is not None:
                for key in ((lang, source), (lang,), ()):
                    groups[key, r].append(bucket_top(v))
    kept = set()
    for i, lang, source, _ in rows:
        m, good = held[i], True
        for r, (_, _, side, floor, _) in rules.items():
            v = ratio(m, r)
            if v is None:
                continue
            key = next(k for k in ((lang, source), (lang,), ()) if k == () or len(groups[k, r]) >= least)
            s = sorted(groups[key, r])
            q1, q3 = s[math.ceil(len(s) / 4) - 1], s[math.ceil(len(s) * 3 / 4) - 1]
            spread = max(q3 - q1, floor) * fence
            good &= v <= q3 + spread if side == "high" else v >= q1 - spread
        if good and m["n_words"] >= 50 and m["n_repeat_words"] * 100 <= m["n_words"] * 50:
            kept.add(i)
    return held, kept


def secrets(text):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found)


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in found).encode()).hexdigest()


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def groups(ids, linked):
    """Smallest id reachable, for pairs that ``linked`` accepts."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(ids)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if find(a) != find(b) and linked(a, b):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {i: find(i) for i in ids}


def near_duplicates(texts, width, percent):
    sets = {i: shingles(t, width) for i, t in texts.items()}

    def linked(a, b):
        x, y = sets[a], sets[b]
        if not x or not y or min(len(x), len(y)) * 100 < max(len(x), len(y)) * percent:
            return False
        both = len(x & y)
        return both * 100 >= (len(x) + len(y) - both) * percent

    return sets, groups(texts, linked)


def item_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def contamination(texts, items, percent=80, width=5):
    """Items of which some window of a text has weighted shingles similar enough."""
    def bag(words):
        return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))}

    weight = lambda s: sum(len(" ".join(x)) for x in s)
    item = {i: (item_words(t), bag(item_words(t))) for i, t in items.items() if item_words(t)}
    starts = collections.defaultdict(set)
    for i, (w, _) in item.items():
        for at in range(max(1, len(w) - width + 1)):
            starts[tuple(w[at:at + width])].add((i, at))
    found = {}
    for d, text in texts.items():
        w, hit = item_words(text), set()
        sizes = {min(width, len(x)) for x, _ in item.values()}
        windows = {(i, max(0, p - at + shift)) for size in sizes for p in range(len(w) - size + 1)
                   for i, at in starts.get(tuple(w[p:p + size]), ()) for shift in (-2, -1, 0, 1, 2)}
        for i, start in windows:
            own, of_item = bag(w[start:start + len(item[i][0])]), item[i][1]
            both = weight(own & of_item)
            if both * 100 >= (weight(own) + weight(of_item) - both) * percent:
                hit.add(i)
        found[d] = sorted(hit)
    return found


class KneserNey:
    """Interpolated modified Kneser-Ney over bytes, from plain counts."""

    def __init__(self, trusted, order=5):
        self.order = order
        top = collections.Counter()
        for t in trusted:
            x = bytes(order - 1) + t.encode()
            top.update(x[i:i + order] for i in range(len(x) - order + 1))
        self.counts = {order: top}
        for n in range(order - 1, 0, -1):
            self.counts[n] = collections.Counter(g[1:] for g in self.counts[n + 1])
        self.discounts, self.total, self.freed = {}, {}, {}
        for n, counted in self.counts.items():
            k = collections.Counter(counted.values())
            d = [0.5, 0.75, 0.9]
            if k[1] and k[2]:
                y = k[1] / (k[1] + 2 * k[2])
                raw = (1 - 2 * y * k[2] / k[1], 2 - 3 * y * k[3] / k[2], 3 - 4 * y * k[4] / k[3] if k[3] else 1.5)
                d = [min(max(v, 0.1), i + 0.9) for i, v in enumerate(raw)]
            self.discounts[n], self.total[n], self.freed[n] = d, collections.Counter(), collections.Counter()
            for g, c in counted.items():
                self.total[n][g[:-1]] += c
                self.freed[n][g[:-1]] += d[min(c, 3) - 1]
        self.p = functools.lru_cache(None)(self._p)

    def _p(self, g):
        n = len(g)
        if not n:
            return 1 / 256
        if g[:-1] not in self.total[n]:
            return self.p(g[1:])
        c, total = self.counts[n].get(g, 0), self.total[n][g[:-1]]
        own = (c - self.discounts[n][min(c, 3) - 1]) / total if c else 0.0
        return own + self.freed[n][g[:-1]] / total * self.p(g[1:])

    def rate(self, text):
        """Bits per byte."""
        x = bytes(self.order - 1) + text.encode()
        n = len(x) - self.order + 1
        return -sum(math.log2(self.p(x[i:i + self.order])) for i in range(n)) / n


class Ppm:
    """One language's context tree, with the exclusion of longer contexts' symbols."""

    def __init__(self, texts, order=3):
        self.order = order
        self.seen = collections.defaultdict(collections.Counter)
        for t in texts:
            x = bytes(order) + t.encode()
            for i in range(order, len(x)):
                for k in range(order + 1):
                    self.seen[x[i - k:i]][x[i]] += 1
        self.cost = functools.lru_cache(None)(self._cost)
        self.escape = functools.lru_cache(None)(self._escape)

    def _escape(self, context):
        own = self.seen.get(context)
        if not own:
            return 0.0
        lower = lambda s: self.cost(context[1:], s) if context else 8.0
        out = sum(2.0 ** -lower(s) for s in own)
        return math.log2((sum(own.values()) + len(own)) / len(own)) + math.log2(max(1 - out, 2.0 ** -20))

    def _cost(self, context, symbol):
        own = self.seen.get(context, {})
        if symbol in own:
            return math.log2((sum(own.values()) + len(own)) / own[symbol])
        return self.escape(context) + (self.cost(context[1:], symbol) if context else 8.0)

    def bits(self, text):
        x = bytes(self.order) + text.encode()
        return sum(self.cost(x[i - self.order:i], x[i]) for i in range(self.order, len(x)))


def pfair(sizes, parts):
    """Slots of (source, block) by earliest deadline first, frame after frame."""
    out, slot, frame = {}, 0, 0
    while any(n > frame * parts[s] for s, n in sizes.items()):
        q = {s: min(parts[s], n - frame * parts[s]) for s, n in sizes.items() if n > frame * parts[s]}
        size = sum(q.values())
        open_ = sorted((-(-(j + 1) * size // k), s, j, j * size // k) for s, k in q.items() for j in range(k))
        for t in range(size):
            pick = next(b for b in open_ if b[3] <= t)
            open_.remove(pick)
            out[pick[1], frame * parts[pick[1]] + pick[2]] = (slot + t, slot + pick[3], slot + pick[0])
        slot, frame = slot + size, frame + 1
    return out


def perplexity_verdicts(docs, labels, share=0.995, margin=0.05, weight=400, step=0.001):
    """Per document its bits a byte, its excess over the median of its language, and its cutoff."""
    good = {r.doc_id for r in labels if r.quality == 1 and r.doc_id in docs}
    half = {i: int(hashlib.md5(str(i).encode()).hexdigest()[-1], 16) % 2 for i in good}
    model = KneserNey([docs[i].text for i in good if half[i] == 0])
    rate = {i: model.rate(r.text) for i, r in docs.items() if r.text}
    held = [i for i in good if half[i] == 1 and i in rate]

    def quantile(value, lang, share):
        steps = sorted(math.floor(value(i) / step) for i in held if lang is ... or docs[i].lang == lang)
        return (steps[math.ceil(len(steps) * share) - 1] + 1) * step if steps else None

    langs = {r.lang for r in docs.values()}
    every = quantile(rate.get, ..., 0.5)
    usual = {k: quantile(rate.get, k, 0.5) or every for k in langs}

    def excess(i):
        n = len(docs[i].text.encode())
        return (rate[i] - usual[docs[i].lang]) * n / (n + weight)

    most = quantile(excess, ..., share)
    cut = {k: max(quantile(excess, k, share) or most, most) + margin for k in langs}
    return {i: (rate[i], excess(i), cut[docs[i].lang]) for i in rate}
