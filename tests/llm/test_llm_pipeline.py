"""The pipeline over the smallest tables, against plain versions of its stages."""

import os

import pytest

import corpus_pipeline
from tests.conftest import SF, frame
from tests.llm import brute
from tests.llm.test_llm_queries import check_mixture
from tidepanel.llm import mixing
from tidepanel.session import materialise

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def plain_quality(docs, labels):
    return {i: docs[i] for i, (_, excess, cut) in brute.perplexity_verdicts(docs, labels).items() if excess <= cut}


def plain_redaction(text):
    out, at = [], 0
    for start, _, end, _ in brute.secrets(text):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_run(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    kept = plain_quality(docs, labels)
    _, component = brute.near_duplicates({i: r.text for i, r in kept.items()}, 5, 80)
    kept = {i: r for i, r in kept.items() if component[i] == i}
    leaks = brute.contamination({i: r.text for i, r in kept.items()}, items)
    kept = {i: r for i, r in kept.items() if not leaks[i]}
    assert 0 < len(kept) < len(docs)

    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(kept)
    for i, r in kept.items():
        assert got[i].text == plain_redaction(r.text)
        assert (got[i].lang, got[i].source) == (r.lang, r.source)
    check_mixture(list(got.values()), mixing.PARTS, mixing.BLOCK)


def test_stages_keep_the_columns(spark):
    rows = [(None, "a text without an id", "en", None, 20, "x"), (1, None, None, "s", None, "y"),
            (2, "the same words in both of these rows " * 3, "en", "s", 5, "z"),
            (2, "the same words in both of these rows " * 3, "en", "s", 5, "z"),
            (3, "password=abcdefgh1234 stands here", "en", "s", 33, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string"
    docs = frame(spark, rows, schema)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = materialise(stage(spark, docs, SF), name)
        assert out.columns == docs.columns
        found = sorted(out.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
        assert [r.doc_id for r in found] == ([None, 1, 2, 3] if name == "deduplicate" else [None, 1, 2, 2, 3])
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
