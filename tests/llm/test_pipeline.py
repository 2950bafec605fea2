"""The pipeline's stages against plain walks over the same rows."""

import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm.common import stored, table

from .conftest import BYTE_BPE, CASES
from .test_near_duplicates import brute_force, shingle_set
from .test_passages import WORDS, dedup_by_hand

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    """Rows of the documents and of each stage's result."""
    docs = table(spark, SF, "documents")
    out = [("documents", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        out.append((name, docs.collect()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == table(spark, SF, "documents").columns
    return dict(out)


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "bpe"]


def test_language_stage_keeps_documents_with_letters(results):
    kept = {r["doc_id"] for r in results["language_id"]}
    assert kept == {r["doc_id"] for r in results["documents"] if re.search(r"[^\W\d_]", r["text"] or "")}


def test_line_stage(results):
    want = dedup_by_hand([(r["doc_id"], r["text"]) for r in results["language_id"]])
    assert {r["doc_id"]: r["text"] for r in results["line_dedup"]} == {d: t for d, (t, _, _) in want.items()}
    before = {r["doc_id"]: r for r in results["language_id"]}
    for r in results["line_dedup"]:
        old = before[r["doc_id"]]
        assert (r["lang"], r["source"]) == (old["lang"], old["source"])
        assert r["n_chars"] == (old["n_chars"] if r["text"] == old["text"] else len(r["text"]))


def test_near_duplicate_stage(results):
    rows = [(r["doc_id"], r["text"]) for r in results["line_dedup"]]
    want = {d for d, _, _, kept in brute_force(rows, 80) if kept} | {d for d, t in rows if not shingle_set(t)}
    assert {r["doc_id"] for r in results["near_dedup"]} == want


def test_decontamination_stage(spark, results):
    items = [WORDS.findall(r["text"].lower()) for r in table(spark, SF, "benchmark").collect()]
    grams = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in items]
    kept = {r["doc_id"] for r in results["decontamination"]}
    for r in results["near_dedup"]:
        w = WORDS.findall(r["text"].lower())
        own = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        share = max(len(own & g) / len(g) for g in grams)
        assert share < 1 or r["doc_id"] not in kept
        assert share > 0.5 or r["doc_id"] in kept


def test_token_stage(results):
    library = Tokenizer.from_file(BYTE_BPE)
    texts = {r["doc_id"]: r["text"] for r in results["decontamination"]}
    assert {r["doc_id"] for r in results["bpe"]} == set(texts)
    for r in results["bpe"]:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)


def test_run_equals_the_stages(spark, results):
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted(tuple(r) for r in results["bpe"])


def test_stages_over_cases(spark, cases, no_rows):
    docs = cases
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
    texts = [r["decoded_sha256"] for r in docs.collect()]
    assert 0 < len(texts) < len(CASES)
    empty = no_rows
    for name, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, SF), name)
    assert empty.count() == 0
