import random
import re

import numpy as np
import pytest

from ledgerline.llm import minhash
from ledgerline.llm.components import connected_components
from ledgerline.llm.shingles import distinct_by_text, hash_shingles, hash_words

from .conftest import CASES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, width=5):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([" ".join(words)] if words else [])
    return frozenset(" ".join(words[i:i + width]) for i in range(len(words) - width + 1))


def brute_force(rows, percent):
    """(doc_id, n_shingles, component_id, kept) of each row, by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)), d == least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def family(rng, n, length, changes):
    """Copies of one text with some words changed."""
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(length)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_hashes_tell_apart_words_and_places():
    def sets(*texts):
        data = "".join(texts).encode()
        offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
        values, bounds = hash_shingles(*hash_words(np.frombuffer(data, np.uint8), offsets), 5)
        return [frozenset(s.tolist()) for s in distinct_by_text(values, bounds)]

    a, b, c, d, e, f, g = sets("a b c d e f", "A\tB\nC  d e f ", "b a c d e f", "", " \n", "ab c", "a bc")
    assert a == b and a != c and len(a) == 2
    assert d == e == frozenset() and f != g and len(f) == 1
    rng = random.Random(1)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 30))) for _ in range(300)]
    for got, text in zip(sets(*texts), texts):
        assert len(got) == len(shingle_set(text))


def test_plan_shares_a_pattern_for_all_but_few_pairs():
    for percent in (70, 80, 85, 95):
        m, radius = minhash.plan(percent)
        assert radius >= 2 * m - 1
    with pytest.raises(ValueError):
        minhash.plan(5)


def test_histogram_bound_holds():
    rng = np.random.default_rng(1)
    for _ in range(50):
        pool = rng.integers(0, 1 << 60, 400, dtype=np.uint64)
        a, b = np.unique(rng.choice(pool, 200)), np.unique(rng.choice(pool, 300))
        both = len(np.intersect1d(a, b))
        assert minhash.shared_count(a, b) == both
        assert minhash.may_share(minhash.histogram(a), minhash.histogram(b)[None, :])[0] >= both
    full = np.arange(0, 1024 * 300, 1024, dtype=np.uint64)
    assert minhash.may_share(minhash.histogram(full), minhash.histogram(full)[None, :])[0] > len(full)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200), (300, 305), (305, 303)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 130)} | {201: 200, 305: 300, 303: 300}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def roots(edges):
    """Smallest node of each node's component, of the nodes that are not it."""
    root = {k: k for e in edges for k in e}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {k: find(k) for k in root if find(k) != k}


def test_components_of_zigzags_equal_union_find(spark):
    rng = random.Random(4)
    chains = [[1, 3, 4, 2], [2, 5, 6, 3, 4, 1]] + [rng.sample(range(1, n + 1), n) for n in (4, 6, 8)]
    graphs = [list(zip(c, c[1:])) for c in chains]
    graphs.append(graphs[0] + [(100 * s, 100 * s + k) for s in range(1, 40) for k in range(1, 4)])
    for edges in graphs:
        got = [(r["node"], r["root"]) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()]
        assert sorted(got) == sorted(roots(edges).items())


def test_cases_equal_brute_force(cases, no_rows):
    found = minhash.near_duplicates(cases, 85)
    got = result(found)
    want = brute_force(CASES, 85)
    # a row without an id stands for its component only where no other id does
    assert [g[:3] for g in got] == [w[:3] if w[0] is not None else (None, w[1], w[2]) for w in want]
    assert {g[3] for g in got if g[0] == 0} == {True} and {g[3] for g in got if g[0] == 1 and g[2] == 0} == {False}
    assert minhash.near_duplicates(no_rows, 85).count() == 0
    kept = minhash.keep_one(cases, 80)
    assert kept.columns == cases.columns
    texts = [r["text"] for r in kept.collect()]
    assert texts.count(CASES[0][1]) == 1 and texts.count(None) == 2


@pytest.mark.parametrize("percent", [80, 85])
def test_families_equal_brute_force(spark, percent):
    rng = random.Random(percent)
    texts = [t for _ in range(12) for t in family(rng, 25, rng.randint(20, 150), 8)]
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) + " " + passage for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(rng.sample(texts, len(texts)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash.near_duplicates(docs, percent)) == brute_force(rows, percent)


def test_large_family_is_compared_in_blocks(spark):
    rng = random.Random(5)
    rows = [(k, t) for k, t in enumerate(family(rng, 700, 60, 6))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash.near_duplicates(docs, 85)) == brute_force(rows, 85)


def test_one_row_stays_of_near_copies_under_one_id_or_none(spark):

    rng = random.Random(11)
    words = [f"w{rng.randrange(3000)}" for _ in range(200)]

    def copy(k):
        return " ".join([*words[:k], "changed", *words[k + 1:]])

    other = " ".join(f"v{rng.randrange(3000)}" for _ in range(60))
    rows = [(1, copy(3)), (1, copy(190)), (None, copy(50)), (2, other), (2, other), (None, other + " end"), (None, None), (None, ""), (3, " "), (3, " "), (4, "a b"), (None, "a b"), (None, "c d"), (None, "c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' as row", "'z' as group", "'z' as first").repartition(3)
    kept = sorted(((r["doc_id"], r["text"]) for r in minhash.keep_one(docs).collect()), key=str)
    first = [t for i, t in kept if i == 1]
    assert len(first) == 1 and first[0] in (copy(3), copy(190))
    assert kept == sorted([(1, first[0]), (2, other), (None, None), (None, ""), (3, " "), (3, " "), (4, "a b"), (None, "c d")], key=str)


def test_tables_read_once_are_not_written(spark, monkeypatch):
    # a written table is a file for each partition; only those that later steps read several times are written
    from ledgerline.llm import components

    written = []
    real = minhash.stored

    def counted(df, name):
        written.append(name)
        return real(df, name)

    monkeypatch.setattr(minhash, "stored", counted)
    monkeypatch.setattr(components, "stored", counted)
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words), (2, words + " tail"), (3, "other words " * 9), (4, words)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, percent=85).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1}
    assert not {"buckets", "wanted", "roots", "mixed", "least", "cc-min"} & set(written)
    assert written.count("placed") == 1


def test_tables_of_one_step_are_held_and_let_go(spark, monkeypatch):
    # each file written to a local folder starts children of its executor; short-lived and read-once tables are not written
    from ledgerline.llm import components

    written = []
    real = minhash.stored

    def counted(df, name):
        written.append(name)
        return real(df, name)

    monkeypatch.setattr(minhash, "stored", counted)
    monkeypatch.setattr(components, "stored", counted)
    rng = random.Random(3)
    rows = [(k, t) for k, t in enumerate(t for _ in range(4) for t in family(rng, 12, 80, 6))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    kept = minhash.keep_one(docs, 80)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _, _, first in brute_force(rows, 80) if first}
    assert not {"members", "labelled", "groups", "kept"} & set(written)
    # a step of the components writes once; the last of a run finds nothing to do
    steps = []
    monkeypatch.setattr(components, "_large_star", lambda edges, real=components._large_star: steps.append(1) or real(edges))
    written.clear()
    chain = spark.createDataFrame([(k, k + 1) for k in range(9)], "a long, b long")
    assert components.connected_components(chain).count() == 9
    assert written.count("cc") == len(steps)
