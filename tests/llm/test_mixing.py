import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerline.llm import mixing


def filled(sizes, weights, share, most):
    """Targets by sharing again and again until no source is above its bound."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    spare, open_ = share * sum(sizes.values()) / 100, set(names)
    out = {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if spare * weight[s] / total > most * sizes[s] + 1e-9}
        if not over:
            return out | {s: spare * weight[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
        spare -= sum(most * sizes[s] for s in over)
        open_ -= over
    return out


def word_count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(3)
    for _ in range(12):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 60, 900, rng.randint(1, 5000)]) for i in range(rng.randint(1, 9))}
        if rng.random() < 0.5:
            sizes[None] = rng.randint(0, 3000)
        weights = rng.choice([(5, 2, 1), (1,), (3, 7)])
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r["source"]: r for r in mixing.targets(df, weights).collect()}
        want = filled(sizes, weights, 150, 2)
        assert set(got) == set(want)
        for s, r in got.items():
            assert abs(r["target"] - want[s]) < 1e-6 * (1 + want[s]), (sizes, s)
            assert abs(r["words"] - r["target"]) <= 0.5 and r["words"] <= 2 * sizes[s]


def test_schedule_is_a_permutation_of_ranked_blocks(spark):
    wanted = spark.createDataFrame([("a", 5000), ("b", 1300), (None, 7), ("c", 0), ("d", 100)], "source string, words long")
    rows = mixing.schedule(wanted, block_words=10).orderBy("slot").collect()
    blocks = Counter(r["source"] for r in rows)
    assert blocks == {"a": 500, "b": 130, None: 1, "d": 10}
    seen = Counter()
    for r in rows:  # the rank is the number of the source's slots before
        assert r["block"] == seen[r["source"]]
        seen[r["source"]] += 1
    assert len({r["slot"] for r in rows}) == len(rows)
    for at in range(1, len(rows)):  # at any place of the mix, shares are near their weights
        if at in (64, 200, 400, 600):
            part = Counter(r["source"] for r in rows[:at])
            assert all(abs(part[s] - at * blocks[s] / len(rows)) < 8 for s in blocks)
    assert mixing.schedule(wanted.limit(0)).count() == 0


def test_points_below_a_bound_are_counted(spark):
    digits = 6
    grid = [int(f"{i:06b}"[::-1], 2) for i in range(64)]
    bounds = [0, 1, 7, 31, 32, 50, 64]
    df = spark.createDataFrame([(p,) for p in grid], "point long")
    got = {r["point"]: r for r in df.select("point", *[mixing._count_below(F.col("point"), digits, F.lit(b).cast("long")).alias(f"b{b}") for b in bounds]).collect()}
    for i, p in enumerate(grid):
        for b in bounds:
            assert got[p][f"b{b}"] == sum(q < b for q in grid[:i]), (i, b)


def test_mix_takes_whole_blocks_of_shuffled_tapes(spark, cases, monkeypatch):
    """Every edge case, brute force over the tapes, and chunks and blocks so small that all are split."""
    monkeypatch.setattr(mixing, "CHUNK", 4)
    docs = cases.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("big")).when(F.col("doc_id") % 3 == 1, F.lit("tiny")))
    docs = docs.unionByName(docs.where("doc_id = 9"))  # a repeated long row
    mixed = mixing.mix(docs, block_words=7)
    got = mixed.collect()
    rows = [(r["source"], r["doc_id"], r["text"]) for r in docs.collect()]
    sizes = defaultdict(int)
    for s, _, t in rows:
        sizes[s] += word_count(t)
    want = filled(sizes, (5, 2, 1), 150, 2)
    expected = Counter()
    for s in sizes:
        tape = sorted(((hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest(), -1 if i is None else i, word_count(t)), i) for q, i, t in rows if q == s)
        at, limit = 0, int(want[s] + 0.5)
        taken = [0] * len(tape)
        for _ in range(2):
            for k, ((_, _, n), _) in enumerate(tape):
                taken[k] += max(0, min(at + n, limit) - at)
                at += n
        expected.update((i, n, sizes[s], taken[k]) for k, ((_, _, n), i) in enumerate(tape))
    totals = mixing.document_totals(mixed).collect()
    assert Counter((r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in totals) == expected
    assert len(totals) == len(rows)
    # a slot holds one block of one source, whole but for the source's last
    slots = defaultdict(list)
    for r in got:
        if r["slot"] is not None:
            slots[r["slot"]].append(r)
    assert all(len({r["source"] for r in part}) == 1 for part in slots.values())
    short = Counter(part[0]["source"] for part in slots.values() if sum(r["n_words"] for r in part) != 7)
    assert all(n == 1 for n in short.values())
    assert all(0 <= r["first_word"] and r["first_word"] + r["n_words"] <= r["size"] for part in slots.values() for r in part)
    assert sorted(map(str, mixing.mix(docs.repartition(5), block_words=7).collect())) == sorted(map(str, got))


def test_mix_of_no_rows_and_of_empty_texts(spark, no_rows):
    docs = no_rows.withColumn("source", F.lit("a"))
    assert mixing.document_totals(mixing.mix(docs)).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, " ", None), (None, "", "a")], "doc_id long, text string, source string")
    assert {tuple(r) for r in mixing.document_totals(mixing.mix(empty)).collect()} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0), (None, 0, 0, 0.0, 0)}
