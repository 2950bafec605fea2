import math
import random
import zlib

import pytest

from ledgerline.llm import langid

from .conftest import PIECES

DATA = "/root/testdata/sf0.001"


def segmentations(word, table, unseen):
    """All products of piece probabilities over the ways to cut ``word``, summed one by one."""
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        p = table.get(word[:k], (unseen if k == 1 else None,))[0]
        if p is not None:
            total += p * segmentations(word[k:], table, unseen)
    return total


def test_forward_sum_equals_all_segmentations():
    rng = random.Random(1)
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab", "bb"]
    model = langid.PieceModel(["x"], {p: (rng.random() / 10,) for p in pieces}, 1e-4)
    for _ in range(200):
        word = "".join(rng.choices("abc", k=rng.randint(1, 9)))
        want = math.log(segmentations("▁" + word, model.table, model.unseen))
        assert model.log_likelihoods(word)[0] == pytest.approx(want)


def test_expected_counts_are_weighted_by_probability():
    model = langid.PieceModel(["x"], {"▁": (0.5,), "a": (0.2,), "▁a": (0.3,)}, 1e-4)
    counts = langid.Counter()
    model.expected("a", 2.0, 0, counts)
    assert counts["▁a"] == pytest.approx(2 * 0.3 / 0.4) and counts["a"] == counts["▁"] == pytest.approx(2 * 0.1 / 0.4)


def test_long_words_do_not_underflow():
    model = langid.PieceModel(["x", "y"], {"a": (1e-5, 2e-5)}, 1e-6)
    x, y = model.log_likelihoods("a" * 5000)
    assert y - x == pytest.approx(5000 * math.log(2))


def test_expected_counts_of_long_words():
    model = langid.PieceModel(["x"], {"▁": (0.5,), "a": (1e-3,), "aa": (2e-6,), "b": (0.1,)}, 1e-6)
    counts = langid.Counter()
    model.expected("a" * 300 + "漢" * 40, 2.0, 0, counts)
    assert counts["a"] + 2 * counts["aa"] == pytest.approx(600) and counts["▁"] == pytest.approx(2) and counts["漢"] == pytest.approx(80)
    short, logs = langid.Counter(), langid.Counter()
    model.expected("aaabaa", 3.0, 0, short)
    model._expected_by_logs("▁aaabaa", model.edges("▁aaabaa"), 3.0, 0, logs)
    assert dict(logs) == pytest.approx(dict(short))


def test_letter_words():
    assert langid.letter_words("Ab-c1d_é ½x 漢字!") == ["ab", "c", "d", "é", "x", "漢字"]
    assert langid.letter_words(" 12 ½ !?") == []


@pytest.fixture(scope="module")
def model(spark):
    return langid.train(spark.read.parquet(f"{DATA}/documents.parquet"), PIECES)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    true = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [d for d in true if zlib.crc32(str(d).encode()) % 5 == 0]
    assert held and all(found[d]["held_out"] for d in held) and sum(r["held_out"] for r in found.values()) == len(held)
    assert sum(found[d]["lang_pred"] == true[d] for d in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_labels_of_held_out_documents_are_not_read(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    changed = docs.withColumn("lang", langid.F.when(langid.held_out(), "zz").otherwise(langid.F.col("lang")))
    assert "zz" not in langid.train(changed, PIECES, rounds=1).languages


def test_cases(cases, no_rows, model):
    got = langid.predict(cases, model).collect()
    assert len(got) == cases.count()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (3, 4, 12)} == {"und"}
    assert {r["score"] for r in got if r["lang_pred"] == "und"} == {0.0}
    kept = langid.keep_recognised(cases, model, 0.5)
    assert kept.columns == cases.columns
    assert {3, 4, 12}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert langid.predict(no_rows, model).count() == 0
    nothing = langid.train(no_rows, PIECES)
    assert nothing.languages == [] and {r["lang_pred"] for r in langid.predict(cases, nothing).collect()} == {"und"}


def test_long_words_take_linear_time_and_give_the_same(monkeypatch):
    import time

    rng = random.Random(12)
    pieces = {"".join(rng.choices("abcd", k=rng.randint(1, 6))): (rng.random(), rng.random(), rng.random()) for _ in range(60)}
    model = langid.PieceModel(["a", "b", "c"], pieces, 1e-7)
    for n in (1, 2, 7, 50, 400, 900):
        word = "".join(rng.choices("abcde", k=n))
        short = model.log_likelihoods(word)
        monkeypatch.setattr(langid, "LONG_WORD", 0)
        assert model.log_likelihoods(word) == pytest.approx(short, rel=1e-9)
        monkeypatch.undo()
    begin = time.time()
    model.log_likelihoods("".join(rng.choices("abcde", k=200_000)))
    assert time.time() - begin < 10
