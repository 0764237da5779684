"""Every query over the whole of the smallest tables, against a plain version of it."""

import collections
import math
import os
import zlib

import numpy as np
import pytest

from checks.compare import connect, difference
from tests.conftest import SF
from tests.llm import brute
from tidepanel.llm import language_id, mixing, quality_rules, toxicity
from tidepanel.llm.queries import QUERIES, SQL, TOKENIZER

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    return {r.doc_id: r for r in rows}


def result(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


def test_names_are_those_of_the_list():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_toxicity(spark, docs):
    got = result(spark, "op1_toxicity")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert set(got) == set(docs) and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())
    own = [i for i in labels if i in got and not got[i].held_out]
    assert np.mean([got[i].predicted == labels[i] for i in own]) >= 0.9
    unseen = [i for i in labels if i in got and got[i].held_out]
    assert unseen and np.mean([got[i].predicted == labels[i] for i in unseen]) >= 0.9


@pytest.mark.parametrize("seed", range(4))
def test_marginals(seed):
    rng = np.random.default_rng(seed)
    sizes = np.array([3, 0, 1300, 1, 40])
    score, pair = rng.normal(-1, 2, sizes.sum()), rng.uniform(-3, 3, (2, 2))
    if seed == 0:  # nothing but the start of a text decides
        score, pair = np.zeros(sizes.sum()), np.array([[3.0, -3.0], [-3.0, 3.0]])
        score[3] = 25
    got, at = toxicity.marginals(score, *toxicity._ends(sizes), pair), 0
    for n in sizes[sizes > 0]:
        e, a = np.exp(np.stack([np.zeros(n), score[at:at + n]], 1)), np.exp(pair)
        f, b = [e[0]], [np.ones(2)]
        for t in range(1, n):
            f.append((f[-1] @ a) * e[t] / (f[-1] @ a).sum())
            b.insert(0, a @ (e[n - t] * b[0]) / (a @ (e[n - t] * b[0])).sum())
        want = [x[1] * y[1] / (x @ y) for x, y in zip(f, b)]
        assert np.allclose(got[at:at + n], want, rtol=1e-9, atol=1e-12)
        alone = toxicity.marginals(score[at:at + n], *toxicity._ends(np.array([n])), pair)
        assert np.allclose(got[at:at + n], alone, rtol=1e-12, atol=0)
        at += n


def test_perplexity(spark, docs):
    got = result(spark, "op2_perplexity")
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    want = brute.perplexity_verdicts(docs, labels)
    assert set(got) == set(docs)
    for i, r in got.items():
        if i not in want:
            assert (r.perplexity, r.excess, r.kept) == (None, None, False)
            continue
        rate, excess, cut = want[i]
        assert math.isclose(math.log2(r.perplexity), rate, abs_tol=1e-6)
        assert math.isclose(r.excess, excess, abs_tol=2e-6) and math.isclose(r.cutoff, cut, abs_tol=2e-6)
        assert r.kept == (excess <= cut)
    known = {r.doc_id: r.quality for r in labels if r.doc_id in docs}
    assert np.mean([got[i].kept for i, q in known.items() if q == 1 and docs[i].text]) >= 0.97


def test_language_id(spark, docs):
    got = result(spark, "op3_language_id")
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in docs}
    assert {i: r.held_out for i, r in got.items()} == held
    langs = sorted({r.lang for r in docs.values()})
    trees = {k: brute.Ppm([r.text for i, r in docs.items() if r.lang == k and not held[i]]) for k in langs}
    for i in docs:
        bits = {k: t.bits(docs[i].text) for k, t in trees.items()}
        best = min(langs, key=lambda k: bits[k])
        assert got[i].lang_pred == best
        assert math.isclose(got[i].score, 1 / sum(2.0 ** max(-1000, bits[best] - b) for b in bits.values()), rel_tol=1e-6)
    assert np.mean([got[i].lang_pred == docs[i].lang for i in docs if held[i]]) >= 0.97


def test_code_lengths_are_of_a_distribution(spark):
    trees = language_id.fit(spark.createDataFrame([("abracadabra, a banana", "x")], "text string, lang string"))
    paths = [(int.from_bytes(c + bytes([s])),) for c in (b"abr", b"xab", b"zzz", b"ana") for s in range(256)]
    got = language_id.path_costs(spark.createDataFrame(paths, "path long"), trees.low, trees.contexts).collect()
    total = collections.Counter()
    for r in got:
        total[r.path >> 8] += 2.0 ** -r.bits[0]
    assert len(total) == 4 and all(0.9 < x <= 1 + 1e-6 for x in total.values())


def test_secret_scans(spark, docs):
    got = result(spark, "op4_secret_scans")
    for i, r in docs.items():
        found = brute.secrets(r.text)
        kinds = collections.Counter(k for *_, k in found)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert got[i].base_sha256 == brute.digest(found)
        assert set(f"{k}:{a}:{b}" for a, _, b, k in found) <= set(got[i].spans.split(","))


def test_near_duplicates(spark, docs):
    got = result(spark, "op5_near_duplicates")
    sets, component = brute.near_duplicates({i: r.text for i, r in docs.items()}, 3, 85)
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in got.items()} == component
    assert all(r.kept == (i == component[i]) for i, r in got.items())


def test_decontamination(spark, docs):
    got = result(spark, "op6_decontamination")
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = brute.contamination({i: r.text for i, r in docs.items()}, items)
    assert {i: r.items for i, r in got.items()} == {i: ",".join(map(str, x)) for i, x in want.items()}
    assert any(want.values()) and all(r.contaminated == bool(r.items) for r in got.values())


def test_mixing(spark, docs):
    got = result(spark, "op7_mixing")
    assert set(got) == set(docs)
    check_mixture(list(got.values()), mixing.PARTS, mixing.BLOCK)


def check_mixture(rows, parts, block):
    """Slots, releases and deadlines as a plain simulation gives them."""
    own = collections.Counter(r.source for r in rows)
    weight = {s: math.sqrt(n) for s, n in own.items()}
    share = {s: max(1, math.floor(w / sum(weight.values()) * parts + 0.5)) for s, w in weight.items()}
    key = lambda s: "" if s is None else "=" + s
    want = brute.pfair({key(s): -(-n // block) for s, n in own.items()}, {key(s): k for s, k in share.items()})
    assert {(key(r.source), r.block): (r.slot, r.release, r.deadline) for r in rows} == want
    assert len({r.position for r in rows}) == len(rows)
    assert all(r.release <= r.slot < r.deadline for r in rows)


def test_token_counts(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    got = result(spark, "op8_token_counts")
    library = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    for i, r in docs.items():
        n = len(library.encode(r.text, add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(r.text.encode()), n > 1024)


def test_quality_rules(spark, docs):
    got = result(spark, "op9_quality_rules")
    rows = [(i, r.lang, r.source, r.text) for i, r in docs.items()]
    held, kept = brute.quality_verdicts(rows, quality_rules.RULES)
    for i, m in held.items():
        assert all(got[i][c] == m[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    assert {i for i, r in got.items() if r.kept} == kept
