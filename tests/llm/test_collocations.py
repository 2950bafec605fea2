import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from ledgerline.llm import collocations


def brute_force(rows, least, inside, reported):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        kept = {p: a for p, a in counts.items() if 2 <= len(p) and a >= least}
        rows = []
        for p, a in kept.items():
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            longer = [b for q, b in kept.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= inside * a for b in longer):
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:reported])]
    return sorted(out)


def corpus():
    rng = random.Random(4)
    words = ["the", "Of", "and", "é", "new", "york", "city", "x" * 200, "a.b", "漢字"]
    rows = [(rng.choice(["en", "en", "fr", None]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ", ", "\n", ". ", "  "]) for _ in range(rng.randint(0, 60))))
            for _ in range(120)]
    rows += [("en", "New York City hall " * 40)] * 3 + [("en", None), (None, ""), ("fr", " \t\n"), ("de", "only once"), ("", "la la la la " * 9)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "'z' as w1", "1 as n", "'z' as slice", "2 as f", "'z' as word").repartition(3)


def found(df, **named):
    return sorted(tuple(r) for r in collocations.collocations(df, **named).collect())


def test_equal_to_brute_force(spark, monkeypatch):
    rows = corpus()
    df = frame(spark, rows)
    assert found(df, least=5) == brute_force(rows, 5, 80, 2000)
    assert found(df, least=3, inside_percent=50, reported=7) == brute_force(rows, 3, 50, 7)
    assert found(df.limit(0)) == []
    # many small slices, tries and hand-overs give the same
    monkeypatch.setattr(collocations, "SLICE", 300)
    monkeypatch.setattr(collocations, "TRIE_PHRASES", 15)
    monkeypatch.setattr(collocations, "HELD", 10)
    monkeypatch.setattr(collocations, "ROW_IDS", 4)
    monkeypatch.setattr(collocations, "VOCABULARY_BYTES", 20)
    assert found(df, least=5) == brute_force(rows, 5, 80, 2000)


def test_words_of_bytes():
    texts = ["Ab cD.e", "", "x", ",, ;", "é\tÉ!z\n\nq", " lead trail ", "x"]
    words, rows, pieces = collocations.split_words(pa.array(texts))
    assert words.to_pylist() == ["ab", "cd", "e", "x", "é", "É", "z", "q", "lead", "trail", "x"]
    assert rows.tolist() == [0, 0, 0, 2, 4, 4, 4, 4, 5, 5, 6]
    same = [a == b for a, b in zip(pieces, pieces[1:])]
    assert same == [True, False, False, False, True, False, False, False, True, False]
    sliced = collocations.split_words(pa.array(["drop", *texts]).slice(1))
    assert sliced[0].to_pylist() == words.to_pylist() and sliced[1].tolist() == rows.tolist()


def test_double_array_finds_its_phrases_only():
    rng = np.random.default_rng(1)
    phrases = np.unique(np.concatenate([np.pad(rng.integers(1, 30, (400, size)), ((0, 0), (0, 4 - size))) for size in (2, 3, 4)]), axis=0)
    trie = collocations.DoubleArray(phrases)
    assert len(set(trie.accepts.tolist())) == len(phrases)
    stream = rng.integers(0, 30, 5000).astype(np.int32)
    have = {tuple(p[p > 0].tolist()): s for p, s in zip(phrases, trie.accepts)}
    prefixes = {p[:k] for p in have for k in range(1, 5)}
    for n, states in enumerate(trie.walk(stream, 4), 1):
        for i, s in enumerate(states.tolist()):
            gram = tuple(stream[i:i + n].tolist())
            assert (s > 0) == (len(gram) == n and gram in prefixes)
            if gram in have:
                assert s == have[gram]


def test_scores_pass_64_bits(spark):
    # the score's arithmetic over counts near the 64-bit bound, by the same expression
    from pyspark.sql import functions as F

    a, l, r = 2**62, 2**62 + 12345, 2**62 + 99
    exact = "decimal(30,0)"
    row = spark.range(1).select(F.call_function("div", F.lit(collocations.SCALE).cast("decimal(8,0)") * F.lit(a).cast("decimal(29,0)"),
                                                F.lit(l).cast(exact) + F.lit(r).cast(exact)).alias("s")).first()
    assert row["s"] == collocations.SCALE * a // (l + r)


def test_phrases_are_counted_as_they_are_found(spark, monkeypatch):
    # one pass a trie gives the exact counts, and each position is walked in one trie only
    rng = np.random.default_rng(3)
    rows = [rng.integers(0, 9, 400).astype(np.int32) for _ in range(6)] + [np.array([5] * 50, np.int32), np.array([1], np.int32)]
    streams = spark.createDataFrame([(r.tobytes(),) for r in rows], "ids binary").repartition(3)
    shorter = None
    monkeypatch.setattr(collocations, "TRIE_PHRASES", 7)
    for size in (2, 3, 4):
        want = Counter(tuple(r[i:i + size].tolist()) for r in rows for i in range(len(r) - size + 1) if r[i:i + size].all())
        shorter = collocations.frequent_phrases(streams, shorter, size, 3)
        got = {tuple(w for w in row[:4] if w): row["f"] for row in shorter.collect()}
        assert got == {p: f for p, f in want.items() if f >= 3}
        assert all(len(p) == size for p in got)


def test_walk_from_some_positions():
    trie = collocations.DoubleArray(np.array([[1, 2, 0, 0], [2, 3, 1, 0], [3, 1, 0, 0]]))
    stream = np.random.default_rng(2).integers(0, 4, 500).astype(np.int32)
    at = np.arange(3, 500, 7)
    for whole, some in zip(trie.walk(stream, 3), trie.walk(stream, 3, at)):
        assert whole[at].tolist() == some.tolist()


def test_fold_is_the_same_in_spark(spark):
    rows = [[1, 2, 3], [2**31 - 1, 2**31 - 1, 2**31 - 1], [500_000, 1, 499_999]]
    want = collocations._fold(list(np.array(rows, np.int64).T))
    df = spark.createDataFrame(rows, "w1 int, w2 int, w3 int").select(collocations._fold(collocations._longs(["w1", "w2", "w3"])).alias("x"))
    assert [r["x"] for r in df.collect()] == want.tolist()
