import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import decontam, line_dedup

from .conftest import CASES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n):
    return " ".join(f"{rng.choice('abcdefghij')}{rng.randrange(4000)}" for _ in range(n))


@pytest.fixture(scope="module")
def bench():
    rng = random.Random(1)
    return [(k, sentence(rng, rng.randint(15, 60))) for k in range(40)] + [(90, None), (91, ""), (92, "too short here")]


def test_near_pairs_equal_a_scan(bench):
    index = decontam.ItemIndex.build([i for i, _ in bench], [t or "" for _, t in bench])
    assert len(index.ids) == 41 and list(index.short) == [3]
    rng = np.random.default_rng(1)
    base = index.prints[rng.integers(0, 40, 4000)]
    for _ in range(20):
        base = base ^ (np.uint64(1) << rng.integers(0, 64, 4000, dtype=np.uint64)) * rng.integers(0, 2, 4000, dtype=np.uint64)
    for size in np.unique(index.sizes)[:6].tolist():
        w, i = index.near(base, size)
        distance = np.bitwise_count(base[:, None] ^ index.prints[None, :])
        want = np.argwhere((distance <= decontam.RADIUS) & (index.sizes == size)[None, :])
        got = set(zip(w.tolist(), i.tolist()))
        assert set(map(tuple, want.tolist())) <= got and all(distance[a, b] <= decontam.REACH and index.sizes[b] == size for a, b in got)


def test_changed_items_of_all_lengths_are_found():
    """Against all windows, one by one: of passages at 0.8 or more, at least 99 of 100 are found, for items of 5 to 60 words."""
    rng = random.Random(9)
    bench = [(k, " ".join(f"w{int(3000 * rng.random() ** 3)}" for _ in range(5 + k % 56))) for k in range(336)]
    index = decontam.ItemIndex.build([i for i, _ in bench], [t for _, t in bench])
    at_threshold = found = 0
    for k, text in bench * 3:
        piece = text.split()
        for place in rng.sample(sorted({0, 1, 2, len(piece) // 2, len(piece) - 3, len(piece) - 2, len(piece) - 1}), rng.randint(1, 4)):
            piece[place] = f"w{int(3000 * rng.random() ** 3)}"
        doc = [*(f"x{rng.randrange(50)}" for _ in range(30)), *piece, *(f"x{rng.randrange(50)}" for _ in range(30))]
        column = pa.array([" ".join(doc)])
        words, bounds = decontam.hash_words(*next((d, o) for _, _, d, o in decontam.text_slices(column)))
        shingles, _ = decontam.hash_shingles(words, bounds, 5)
        by_shingle = np.convolve(index.weights.weigh(words), np.ones(5, np.int64), "valid")
        n = len(piece)
        best = max(index.similarity(shingles[lo:lo + n - 4], by_shingle[lo:lo + n - 4], k) for lo in range(len(words) - n + 1))
        got = dict(index.search_column(column)).get(0, {}).get(k, (0.0,))[0]
        if best >= 0.8:
            at_threshold += 1
            found += got == pytest.approx(best)
        else:
            assert got == 0.0
    assert at_threshold > 200 and found >= 0.99 * at_threshold, (found, at_threshold)


def test_short_items_are_whole_sequences(spark):
    items = spark.createDataFrame([(1, "Alpha beta"), (2, "beta"), (3, "alpha beta gamma delta"), (4, " \n"), (5, "omega")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x ALPHA\nbeta y"), (2, "alpha x beta"), (3, "beta"), (4, "alpha beta gamma delta epsilon"), (5, "alphabeta"), (6, ""), (7, "alpha"),
                                  (8, "z " * 5000 + "alpha beta")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["first_word"], r["n_words"], r["similarity"]) for r in decontam.find_passages(docs, items).collect())
    assert got == [(1, 1, 1, 2, 1.0), (1, 2, 2, 1, 1.0), (2, 2, 2, 1, 1.0), (3, 2, 0, 1, 1.0), (4, 1, 0, 2, 1.0), (4, 2, 1, 1, 1.0), (4, 3, 0, 4, 1.0),
                   (8, 1, 5000, 2, 1.0), (8, 2, 5001, 1, 1.0)]
    assert {r["doc_id"] for r in decontam.without_passages(docs, items).collect()} == {5, 6, 7}


def exact(words, item):
    """Highest weighted similarity of any window of the item's size, without weights by rarity (all words occur once)."""
    shingles = lambda w: [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    n = min(len(item), len(words))
    best = 0.0
    for lo in range(len(words) - n + 1):
        a, b = shingles(words[lo:lo + n]), shingles(item)
        if a:
            best = max(best, 2 * len(set(a) & set(b)) / (len(a) + len(b)))
    return best


def test_planted_passages_are_found_and_clean_documents_are_not(spark, bench):
    rng = random.Random(2)
    docs, planted = [], set()
    for d in range(300):
        words = sentence(rng, rng.randint(0, 200)).split()
        if d % 3 == 0:
            item, text = bench[rng.randrange(40)]
            piece = text.upper().replace(" ", "\n\t", 2).split(" ")
            if d % 6 == 0 and len(text.split()) > 50:
                piece[20] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = piece
            planted.add((d, item))
        docs.append((d, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = decontam.find_passages(frame, items)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert got == planted
    clean = {r["doc_id"] for r in decontam.without_passages(frame, items).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in planted}
    texts = dict(docs)
    for r in found.collect():
        want = exact(WORDS.findall(texts[r["doc_id"]].lower()), bench[r["item_id"]][1].split())
        assert r["similarity"] == pytest.approx(want, abs=0.06) and r["similarity"] >= 0.8


def test_items_in_slices_give_the_same(spark, bench, monkeypatch):
    frame = spark.createDataFrame([(k, f"start {t} end") for k, t in bench], "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    whole = sorted(map(tuple, decontam.find_passages(frame, items).select("doc_id", "item_id").collect()))
    assert whole == [(k, k) for k in [*range(40), 92]]
    monkeypatch.setattr(decontam, "ITEMS_PER_SLICE", 9)
    assert sorted(map(tuple, decontam.find_passages(frame, items).select("doc_id", "item_id").collect())) == whole
    assert {r["doc_id"] for r in decontam.without_passages(frame, items).collect()} == {90, 91}


def test_near_threshold_passages_do_not_depend_on_slices(spark, monkeypatch):
    rng = random.Random(6)
    bench = [(k, " ".join(f"w{int(150 * rng.random() ** 2)}" for _ in range(rng.randint(25, 50)))) for k in range(60)]
    docs = []
    for d in range(240):
        piece = bench[d % 60][1].split()
        for at in rng.sample(range(len(piece)), rng.randint(1, 3)):
            piece[at] = f"w{rng.randrange(150)}"
        docs.append((d, " ".join(["before", *piece, "after"])))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")

    def found():
        return sorted((r["doc_id"], r["item_id"], r["first_word"], r["n_words"], r["similarity"]) for r in decontam.find_passages(frame, items).collect())

    whole = found()
    assert 40 < len(whole) < 200 and min(r[4] for r in whole) < 0.85
    monkeypatch.setattr(decontam, "ITEMS_PER_SLICE", 15)
    assert found() == whole


def test_decontamination_cases(spark, cases, no_rows):
    items = spark.createDataFrame([(1, CASES[0][1]), (None, "line one line two line three line four"), (2, None)], "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in decontam.find_passages(cases, items).collect()), key=str)
    assert got == sorted([(0, 1), (1, 1), (1, 1), (7, None), (8, None)], key=str)
    assert decontam.find_passages(no_rows, items).count() == 0
    assert decontam.find_passages(cases, items.limit(0)).count() == 0
    assert decontam.without_passages(cases, items).columns == cases.columns
    assert decontam.without_passages(cases, items.limit(0)).count() == cases.count()


def dedup_by_hand(rows):
    """Texts after removal, by walking all windows in order."""
    seen, out = {}, {}
    for d, text in sorted(rows):
        solid = [(i, x.strip("\t\x0b\x0c\r ")) for i, x in enumerate(text.split("\n")) if x.strip("\t\x0b\x0c\r ")]
        gone = set()
        for k in range(len(solid) - 2):
            w = tuple(x for _, x in solid[k:k + 3])
            if seen.setdefault(w, (d, k)) != (d, k):
                gone |= {i for i, _ in solid[k:k + 3]}
        out[d] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone), len(solid), len(gone)
    return out


def test_lines_equal_a_walk(spark):
    rng = random.Random(3)
    passages = [[f"p{a} {b}" for b in range(rng.randint(1, 6))] for a in range(5)]
    rows = []
    for d in range(200):
        lines = []
        for _ in range(rng.randint(0, 6)):
            lines += rng.choice(passages) if rng.random() < 0.4 else [rng.choice(["", " ", f"own {d} {rng.randrange(50)}", "same"])]
        rows.append((d, "\n".join(x + rng.choice(["", " ", "\r"]) for x in lines)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.dedup_lines(frame).collect()}
    assert got == dedup_by_hand(rows) and sum(n for _, _, n in got.values()) > 100
    again = {r["doc_id"]: r["text"] for r in line_dedup.rewrite(frame).collect()}
    assert again == {d: t for d, (t, _, _) in got.items()}


def test_line_cases(cases, no_rows):
    got = {(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(cases).collect()}
    assert (7, CASES[10][1]) in got and (8, "x\ny") in got and (2, None) in got and (3, "") in got
    assert len(line_dedup.dedup_lines(cases).collect()) == len(CASES)
    new = line_dedup.rewrite(cases)
    assert new.columns == cases.columns and new.count() == len(CASES)
    assert line_dedup.dedup_lines(no_rows).count() == line_dedup.rewrite(no_rows).count() == 0


def test_overlapping_copies_of_one_window():
    assert line_dedup.drop_lines("a\na\na\na\nb", [1]) == ("a\nb", 3)


def test_index_without_items():
    index = decontam.ItemIndex.build([], [])
    assert list(index.search_column(pa.array(["some words that match nothing at all", None, ""]))) == []
