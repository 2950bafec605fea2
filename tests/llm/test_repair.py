import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

from ledgerline.llm import repair

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SOUND = re.compile(r"(s?(ua)+)?\Z")


def damage(rows):
    """conv_id -> rows (turn, role, text) after damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for part in out.values():
        part.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}\0{r[2]}".encode()).hexdigest()))
    return out


def fault_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = text.strip(SPACE)
        out.append(1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least (cost, audit, repaired turns) by whole strings: every partial repair of least (cost, audit) for each regular state."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}
    now = {0: (0, "", ())}

    def put(out, state, cost, audit, turns):
        if state is not None and (state not in out or (cost, audit) < out[state][:2]):
            out[state] = (cost, audit, turns)

    # inserts and edits are not merged by state in between, so that no shorter audit hides a better one
    def gaps(states):
        found = [(q, v) for q, v in states.items()]
        more = found
        for _ in range(2):
            more = [(step[q, c], (cost + 5, audit + "I", (*turns, (names[c], "")))) for q, (cost, audit, turns) in more for c in "ua" if (q, c) in step]
            found = found + more
        return found

    for (_, role, text), fault in zip(rows, faults):
        out = {}
        extra = 5 if fault == 3 else 0
        for q, (cost, audit, turns) in gaps(now):
            put(out, q, cost + 2, audit + "D", turns)
            if fault not in (1, 2):
                put(out, step.get((q, role[:1])), cost + extra, audit + "K", (*turns, (role, text)))
                for c in "ua":
                    put(out, step.get((q, c)), cost + 1 + extra, audit + "R", (*turns, (names[c], text)))
        now = out
    return min((v for q, v in gaps(now) if q in (0, 3)), key=lambda v: v[:2])


def expected(rows):
    given = {r[0] for r in rows}
    after = damage(rows)
    out = {}
    for conv in given:
        part = after[conv]
        faults = fault_of(part)
        turns = [t for t, _, _ in part if t is not None]
        initials = [r[:1] for _, r, _ in part]
        cost, audit, repaired = cheapest(part, faults)
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def test_parse_equals_all_repairs_one_by_one():
    """Every choice of edits with up to two inserts in each gap, judged by the pattern alone."""
    rng = random.Random(5)
    gaps = ["", "u", "a", "uu", "ua", "au", "aa"]
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.randint(0, 3)) for _ in range(rng.randint(0, 3))]
        options = []
        for c, fault in rows:
            extra = 5 if fault == 3 else 0
            edits = [(2, "D", "")] + ([] if fault in (1, 2) else [(extra, "K", c), (1 + extra, "R", "u"), (1 + extra, "R", "a")])
            options.append([(5 * len(g) + cost, "I" * len(g) + audit, g + made) for g in gaps for cost, audit, made in edits])
        options.append([(5 * len(g), "I" * len(g), g) for g in gaps])
        best = min((sum(p[0] for p in parts), "".join(p[1] for p in parts)) for parts in itertools.product(*options)
                   if SOUND.match("".join(p[2] for p in parts)))
        table = {s: repair.parse([(c, f, 0) for c, f in rows], s) for s in repair.STACKS}
        cost, audits, closing = repair.join_segments([table])
        assert (cost, "".join(audits) + closing) == best, rows


def test_segments_join_to_the_whole():
    rng = random.Random(6)
    for _ in range(40):
        rows = [(rng.choice("ssuuuaaat"), rng.choice([0, 0, 0, 1, 2, 3]), rng.choice([0, 0, 0, 2])) for _ in range(rng.randint(1, 40))]
        cost, audits, closing = repair.join_segments([{s: repair.parse(rows, s) for s in repair.STACKS}])
        cuts = sorted(rng.sample(range(len(rows) + 1), min(3, len(rows))))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)]) if b > a]
        again = repair.join_segments([{s: repair.parse(p, s) for s in repair.STACKS} for p in parts])
        assert (again[0], "".join(again[1]) + again[2]) == (cost, "".join(audits) + closing)


def test_repair_equals_brute_force(spark, monkeypatch):
    """Nulls, ties, repeated rows, empty texts, missing turns, other roles, and a conversation with half of the rows."""
    rng = random.Random(7)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", None, "a b.", "x. \t", "so. on", "ok", "\x0b", "naïve…", "q" * 5000 + ".", " " * 5000 + "!"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"]
    rows = []
    for conv in [*range(120), None]:
        for turn in rng.sample([*range(12), None, 600, 1000], rng.randint(1, 9)):
            row = (conv, turn, rng.choice(roles), rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 1, 3])
            if rng.random() < 0.1:
                rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    for turn in range(900):
        rows.append((777, turn, ["user", "assistant"][turn % 2] if rng.random() < 0.9 else rng.choice(roles), rng.choice([f"t{turn}.", f"t{turn}", "same."])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' as segment", "'z' as key", "1 as times").repartition(5)
    want = expected(rows)
    got = {r[0]: tuple(r)[1:] for r in repair.repair(df).collect()}
    assert got == want
    monkeypatch.setattr(repair, "SEGMENT_TURNS", 3)
    assert {r[0]: tuple(r)[1:] for r in repair.repair(df).collect()} == want
    assert repair.repair(df.limit(0)).count() == 0


def test_repaired_turns_are_sound(spark):
    rows = [(1, 0, "system", "Be."), (1, 1, "user", "Hi."), (1, 2, "user", "There?"), (1, 3, "assistant", "Yes."), (2, 0, "assistant", "cut"), (3, 5, "user", "Q?")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = defaultdict(list)
    for r in repair.repaired_turns(df).orderBy("conv_id", "place").collect():
        turns[r["conv_id"]].append((r["role"], r["text"]))
    want = damage(rows)
    for conv in (1, 2, 3):
        assert SOUND.match("".join(r[0] for r, _ in turns[conv]))
        assert turns[conv] == list(cheapest(want[conv], fault_of(want[conv]))[2])


def test_one_long_conversation_in_linear_time():
    import time

    def seconds(n):
        begin = time.time()
        repair.parse((("u", 0, 0) for _ in range(n)), 0)
        return time.time() - begin

    seconds(1000)
    assert seconds(40_000) < 8 * max(seconds(10_000), 0.05)
