"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, and
columns whose names clash with those that the operators make."""

import hashlib
import math
import random

import pytest

from tests.conftest import frame
from tests.llm import brute
from tidepanel.llm import (decontamination, language_id, language_model, mixing, near_duplicates,
                           preferences, quality_rules, secrets, token_counts, toxicity)
from tidepanel.llm.common import drop_ids, keep_ids

SCHEMA = ("doc_id long, text string, lang string, source string, row string, n string, score string, "
          "spans string, slot string, gram string, words string, id string, kept string")
WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]


def prose(seed, n):
    h = hashlib.sha256(str(seed).encode()).digest() * (n // 16 + 1)
    return " ".join(WORDS[h[i] % 10] + WORDS[h[i + 1] % 10] for i in range(n))


LONG = prose("long", 30_000)
TEXTS = [
    (None, prose(1, 80), "en", "a"), (None, None, None, None), (1, None, "en", "a"), (2, "", "fr", None),
    (3, " \t\n\r\x0b\x0c ", None, "a"), (4, "12 34, 56!", "en", "b"), (5, LONG, "en", "a"),
    (6, prose(6, 90), "en", "a"), (6, prose(6, 90), "en", "a"), (7, prose(6, 90), "en", "b"),
    (8, prose(6, 90).upper(), "en", "b"), (9, "one two", "fr", "b"), (10, "One  two", "fr", "b"),
    (11, "Ünïcode ÄÖ ’ \U0001f600 日本語 <|endoftext|> x", "fr", "a"),
    (12, "password = 'abcdefgh12' ü api_key:zz token: token: abcdefghij", "en", "a"),
    (13, "x" * 70_000, "en", "a"), (14, "dup line here\n" * 40, "fr", "a"), (2 ** 62, prose(20, 120), "fr", "z")]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, [t + ("c",) * 9 for t in TEXTS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return frame(spark, [(i, int(i % 2), int(i in (5, 7)), "c") for i in range(5, 15)] + [(None, 1, 1, "c"), (6, None, None, "c")],
                 "doc_id long, quality int, toxic int, text string")


def plain(rows):
    """Rows per (doc_id, text), to compare tables with repeated rows."""
    return sorted(((r.doc_id is not None, r.doc_id or 0), *r[1:]) for r in rows)


def test_ids(spark, odd):
    ids = frame(spark, [(6,), (None,), (6,)], "doc_id long")
    assert sorted(r.doc_id for r in keep_ids(odd, ids, "doc_id").collect()) == [6, 6]
    assert drop_ids(odd, ids, "doc_id").count() == len(TEXTS) - 2


def test_quality_rules(odd, none):
    got = quality_rules.quality_rules(odd).collect()
    want = sorted(brute.quality(t or "") for _, t, *_ in TEXTS)
    assert sorted(tuple(r[m] for m in quality_rules.MEASURES) for r in got) == want
    assert all(not r.kept and r.base_failed for r in got if r.n_words < 50)
    assert quality_rules.quality_rules(none).collect() == []


@pytest.mark.parametrize("values", [[0], [1, 1, 1, 1], list(range(1000)), [5, 5000, 10 ** 9]])
def test_buckets_bound_their_values(spark, values):
    from pyspark.sql import functions as F

    rows = frame(spark, [(v,) for v in values], "v long").select("v", quality_rules.bucket(F.col("v")).alias("b"))
    rows = rows.select("v", "b", quality_rules.bucket_top(F.col("b")).alias("top")).orderBy("v").collect()
    assert all(r.v <= r.top <= r.v * (1 + 1 / 64) for r in rows)
    assert [r.b for r in rows] == sorted(r.b for r in rows)


def test_token_counts(odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    sizes = lambda t: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids))
    got = token_counts.token_counts(odd, path).collect()
    key = lambda x: (x[0] is not None, x)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=lambda x: (x[0] is not None, x[0] or 0, x[1])) == \
        sorted(((i, *sizes(t or "")) for i, t, *_ in TEXTS), key=lambda x: (x[0] is not None, x[0] or 0, x[1])), key
    assert token_counts.token_counts(none, path).collect() == []


def test_token_counts_without_a_dictionary(odd, monkeypatch):
    """What the dictionary holds changes no count."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    with_it = sorted((r.n_bytes, r.n_tokens) for r in token_counts.token_counts(odd, path).collect())
    monkeypatch.setattr(token_counts, "dictionary", lambda docs, path: {})
    assert sorted((r.n_bytes, r.n_tokens) for r in token_counts.token_counts(odd, path).collect()) == with_it


def test_language_id(odd, none):
    got = language_id.identify(odd).collect()
    assert len(got) == len(TEXTS)
    assert {r.lang_pred for r in got} <= {"en", "fr", "und"}
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3, 4))
    assert all(r.lang_pred != "und" and 0 <= r.score <= 1 for r in got if r.doc_id in (5, 6, 11))
    assert language_id.identify(none).collect() == []
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}


@pytest.mark.parametrize("paths", [6, 200, 1 << 20])
def test_language_id_with_more_paths_than_travel(spark, odd, monkeypatch, paths):
    """A hot language does not take paths from a small one, and every path has its exact cost."""
    rows = ([(i, prose(i, 40), "en") for i in range(60)] + [(100, "zażółć gęślą jaźń", "pl"), (101, "日本語の文", "ja")]
            + [(200, "gęś", None), (201, "語", None), (202, "", None), (203, None, None), (204, "the zeta 日本 ż", None)])
    docs = frame(spark, rows, "doc_id long, text string, lang string").repartition(3)
    learned = {k: brute.Ppm([t for _, t, x in rows if x == k]) for k in ("en", "ja", "pl")}
    monkeypatch.setattr(language_id, "PATHS", paths)
    trees = language_id.fit(docs)
    got = {r.doc_id: r for r in language_id.predict(docs, trees).collect()}
    assert trees.langs == ["en", "ja", "pl"] and len(got) == len(rows)
    for i, text, _ in rows:
        if not text:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        bits = {k: t.bits(text) for k, t in learned.items()}
        best = min(sorted(bits), key=bits.get)
        assert got[i].lang_pred == best
        assert math.isclose(got[i].score, 1 / sum(2.0 ** (bits[best] - b) for b in bits.values()), rel_tol=1e-6)
    assert len(language_id.identify(odd).collect()) == len(TEXTS)


def test_secret_scans(odd, none):
    got = secrets.find_secrets(odd).collect()
    assert sorted(len(r.spans) for r in got) == sorted(len(brute.secrets(t or "")) for _, t, *_ in TEXTS)
    spans = [(s.start, s.end, s.kind) for r in got if r.doc_id == 12 for s in r.spans]
    assert spans == [(a, b, k) for a, _, b, k in brute.secrets(dict((i, t) for i, t, *_ in TEXTS)[12])]
    assert secrets.find_secrets(none).collect() == []


def test_trigram_queries_are_mandatory():
    for rule in secrets.RULES:
        assert bool(secrets.trigram_query(rule.pattern)) == (rule.kind != "hex")
    assert secrets.trigram_query("abc|xy") == []
    assert secrets.trigram_query("a(b|c)de+f") == sorted([frozenset({"abd", "bde"}), frozenset({"acd", "cde"})], key=sorted)


def test_redaction_of_overlapping_spans(spark):
    from pyspark.sql import functions as F

    rows = frame(spark, [("0123456789", [(2, 5), (3, 4), (4, 6), (9, 10)]), ("abc", [])],
                 "text string, spans array<struct<start:int,end:int>>")
    out = rows.select(secrets.redacted(F.col("text"), F.col("spans"), "#").alias("x")).collect()
    assert [r.x for r in out] == ["01#678#", "abc"]


def test_near_duplicates(odd, none):
    got = near_duplicates.near_duplicates(odd, 3, 85).collect()
    component = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert len(got) == len(TEXTS)
    assert component == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 6, 9: 9, 10: 9, 11: 11, 12: 12, 13: 13,
                         14: 14, 2 ** 62: 2 ** 62}
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert near_duplicates.near_duplicates(none).collect() == []


@pytest.mark.parametrize("members", [1024, 20])
def test_near_copies_of_one_text(spark, monkeypatch, members):
    """A large group of near copies around the limit, some with edits in common, beside texts that
    share a passage; in one block and in several."""
    monkeypatch.setattr(near_duplicates, "MEMBERS", members)
    base, rows = prose("base", 120).split(), []
    for i in range(90):
        w = list(base)
        for j in range(i % 9 + i % 4):
            w[(i % 30 * 13 + j * 17) % 120] = f"edit{i % 45}x{j}"
        rows.append((i, " ".join(w)))
    passage = prose("shared", 40)
    rows += [(100 + i, prose(("own", i), 60) + " " + passage) for i in range(40)]
    docs = frame(spark, rows, "doc_id long, text string")
    got = {r.doc_id: r for r in near_duplicates.near_duplicates(docs, 3, 85).collect()}
    _, component = brute.near_duplicates(dict(rows), 3, 85)
    assert {i: r.component_id for i, r in got.items()} == component
    assert 1 < len(set(component.values()) - set(range(100, 140))) < 90


def test_least_overlap():
    m = near_duplicates.least_overlap(32, 0.85)
    below = sum(math.comb(32, i) * 0.85 ** i * 0.15 ** (32 - i) for i in range(m))
    assert below <= 1e-9 and 1 < m < 32


def test_decontamination(spark, odd, none):
    words = LONG.split()
    edited = words[500:560]
    edited[20] = "edited"
    items = [(1, " ".join(words[100:130])), (2, " ".join(edited)), (3, "One, TWO!"), (4, ""), (5, None), (6, "..."),
             (7, " ".join(words[100:130]).upper()), (8, "nowhere to be found " * 8), (None, "alpha")]
    benchmark = frame(spark, [i + ("c",) for i in items], "item_id long, text string, n string")
    got = decontamination.contamination(odd, benchmark).collect()
    assert len(got) == len(TEXTS)
    want = brute.contamination({i: t for i, t, *_ in TEXTS if i is not None}, {i: t for i, t in items if i is not None})
    assert {r.doc_id: r.items for r in got if r.doc_id is not None} == want
    assert want[5] == [1, 2, 7] and want[9] == [3]
    assert decontamination.contamination(none, benchmark).collect() == []
    assert not any(r.contaminated for r in decontamination.contamination(odd, benchmark.where("false")).collect())


def test_mixing(odd, none):
    got = mixing.mix(odd, parts=20, block=2).collect()
    assert sorted(r.position for r in got) == sorted({r.position for r in got}) and len(got) == len(TEXTS)
    assert all(r.release <= r.slot < r.deadline and r.n == "c" for r in got)
    assert mixing.mix(none).collect() == []


def test_mixing_keeps_within_a_block(spark):
    """Less than one block from the shares at every slot while no source runs out."""
    rows = [(i, s) for s, n in (("a", 600), ("b", 300), ("c", 100)) for i in range(n)]
    docs = frame(spark, rows, "doc_id long, source string")
    got = mixing.mix(docs, {"a": 6.0, "b": 3.0, "c": 1.0}, parts=100, block=1).collect()
    placed = {s: sorted(r.slot for r in got if r.source == s) for s in "abc"}
    for t in range(1, 1001):
        for s, w in (("a", 0.6), ("b", 0.3), ("c", 0.1)):
            assert abs(sum(x < t for x in placed[s]) - w * t) < 1
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0.0})


def test_mixing_keeps_to_weights_that_are_no_parts(spark):
    """One hot source and more small ones than a frame has blocks: less than two blocks from the
    unrounded shares at every slot, less than one at the ends of frames."""
    weights = {f"s{i}": (0.2 + i % 7 + i / 1000) for i in range(250)}
    weights["hot"] = 0.45 / 0.55 * sum(weights.values())
    total = sum(weights.values())
    sizes = {s: math.ceil(w / total * 6_000) + 2 for s, w in weights.items()}
    docs = frame(spark, [(i, s) for s, n in sizes.items() for i in range(n)], "doc_id long, source string")
    got = mixing.mix(docs, weights, block=1).collect()
    at = {r.slot: r.source for r in got}
    assert sorted(at) == list(range(len(got))) and len(got) == sum(sizes.values())
    assert all(r.release <= r.slot < r.deadline for r in got)
    given = dict.fromkeys(weights, 0)
    for t in range(1, 6_001):
        given[at[t - 1]] += 1
        most = max(abs(given[s] - w / total * t) for s, w in weights.items())
        assert most < (1 + 1e-3 if t % mixing.PARTS == 0 else 2)


def test_perplexity(odd, none, labels):
    got = language_model.perplexities(odd, labels).collect()
    assert len(got) == len(TEXTS)
    assert all((r.perplexity is None) == (r.n_bytes == 0) for r in got)
    assert all(not r.kept for r in got if r.n_bytes == 0)
    assert language_model.perplexities(none, labels).collect() == []
    assert all(r.kept == (r.n_bytes > 0) for r in language_model.perplexities(odd, labels.where("false")).collect())


def test_toxicity(spark, odd, none, labels):
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert all(r.spans == [] and r.words == 0 for r in got if r.doc_id in (1, 2, 3))
    assert toxicity.toxicity(none, labels).collect() == []
    assert {r.score for r in toxicity.toxicity(odd, labels.where("false")).collect()} == {0.5}


def test_toxic_words_are_found(spark):
    rows, labels = [], []
    for i in range(240):
        words = prose(i, 40).split()
        toxic = i % 3 == 0
        if toxic:
            words[5 + i % 20] = "vilemonger" + WORDS[i % 7]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs = frame(spark, rows, "doc_id long, text string")
    got = toxicity.toxicity(docs, frame(spark, labels, "doc_id long, quality int, toxic int")).collect()
    assert [r.predicted for r in sorted(got)] == [int(i % 3 == 0) for i in range(240)]
    text = dict(rows)
    assert all(text[r.doc_id][s.start:s.end].startswith("vilemonger") for r in got for s in r.spans)


def test_preferences(spark):
    schema = "conv_id long, turn long, role string, text string, prompt string"
    chosen = [(1, 0, "user", "q", "c"), (1, 1, "assistant", "good", "c"), (2, 0, "user", "q", "c"),
              (3, 0, None, None, "c"), (3, None, "system", "s", "c"), (None, 0, "user", "q", "c"),
              (4, 0, "user", "a", "c"), (5, 0, "user", "x", "c"), (5, 0, "user", "x", "c"), (6, 0, "user", "only", "c")]
    rejected = [(1, 0, "user", "q", "c"), (1, 1, "assistant", "bad", "c"), (2, 0, "user", "q", "c"), (2, 1, "assistant", "r", "c"),
                (3, 0, "", "", "c"), (3, None, "system", "s", "c"), (4, 0, "user", "b", "c"), (5, 0, "user", "x", "c")]
    got = {r.conv_id: r for r in preferences.preference_pairs(
        frame(spark, chosen, schema), frame(spark, rejected, schema)).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    one = got[1]
    assert one.prompt == "<|user|>\nq<|end|>\n" and one.n_common == 1 and one.differs
    assert one.chosen == "<|assistant|>\ngood<|end|>\n" and one.rejected == "<|assistant|>\nbad<|end|>\n"
    assert [one.chosen[s.start:s.end] for s in one.chosen_mask] == ["good<|end|>\n"]
    assert (got[2].chosen, got[2].chosen_mask, got[2].differs) == ("", [], False) and len(got[2].rejected_mask) == 1
    assert (got[3].n_common, got[3].chosen, got[3].rejected) == (2, "", "") and got[3].prompt.startswith("<|system|>")
    assert got[4].prompt == "" and got[4].chosen_mask == []
    assert got[5].n_common == 1 and got[5].chosen == "<|user|>\nx<|end|>\n"
    none = frame(spark, [], schema)
    assert preferences.preference_pairs(none, none).collect() == []


def test_replies_of_others(spark):
    schema = "conv_id string, turn long, role string, text string, reply string, partner string"
    rows = [("b", 0, "user", "q"), ("b", 1, "assistant", "from b"), ("b", 2, "user", "late"),
            ("c", 0, "user", "no reply"), ("d", 1, "assistant", None), ("d", 1, "assistant", None),
            ("e", None, "assistant", "no number"), ("f", None, "system", "s"), ("f", 1, "assistant", "x"),
            ("f", 1, "assistant", "y"), (None, 0, "assistant", "nobody")]
    df = frame(spark, [(*r, "r", "p") for r in rows], schema)
    chosen, rejected = (sorted((r.conv_id, r.turn is not None, r.role, r.text or "") for r in side.collect())
                        for side in preferences.with_replies_of_others(df))
    kept = [r for r in rows if r[0] in ("b", "d", "f") and r[3] != "late"]
    assert chosen == sorted((i, t is not None, role, x or "") for i, t, role, x in kept)
    other = {"b": "", "d": "y", "f": "from b"}
    assert rejected == sorted((i, t is not None, role, other[i] if role == "assistant" else x) for i, t, role, x in kept)
    single = preferences.with_replies_of_others(df.where("conv_id = 'b'"))[1].collect()
    assert sorted(r.text for r in single) == ["from b", "q"]
    assert preferences.with_replies_of_others(df.limit(0))[1].count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    from tidepanel.llm.components import components

    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(120 + 60 * seed)]
    links += [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2000 + i) for i in range(90)] + [(5, 5), (None, 7)]
    got = components(frame(spark, links, "a long, b long")).collect()
    ids = {x for a, b in links if a is not None and a != b for x in (a, b)}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            lo, hi = sorted((find(a), find(b)))
            parent[hi] = lo
    assert sorted((r.id, r.component) for r in got) == sorted((i, find(i)) for i in ids)
    some = {r.id: r.component for r in components(frame(spark, links, "a long, b long"), 1).collect()}
    assert set(some) == ids and all(find(some[i]) == find(i) for i in ids)
