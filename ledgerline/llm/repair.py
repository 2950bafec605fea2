"""Conversation structure repair: generalised LR parsing of role sequences with weighted edits.

Grammar of a sound conversation (s system, u user, a assistant):

    C -> (nothing) | H P        H -> (nothing) | s        P -> u a | P u a

Its LR automaton reads the role initials of a conversation's rows.  At each
row every stack top is advanced by all edits: keep the row (cost 0, only where
the top allows a shift of its initial), rerole it to user or assistant (1),
delete it (2; the only edit of blank and duplicate rows), insert a user or
assistant turn with empty text before it (5); a truncated row that stays costs
5 more.  Equal stack tops are merged, the least (cost, audit) staying.  In this
automaton equal tops stand on equal stacks, so no repair is lost.

The audit is the string of the edits' initials (D, I, K, R).  Audits are
compared without being written out: at a row's end no audit is the beginning
of another one, so two audits order by those of the tops they came from and,
from one top, by the edits of this row.

A conversation is cut into segments of consecutive turns, each parsed from
every possible top by its own task; a conversation's segments are then joined
in order, best repair by best repair.  Only the digest of the repaired texts
takes a whole conversation's rows one after another, streamed.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batched, map_arrow, stored

SEGMENT_TURNS = 256
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
INITIALS = {"u": "user", "a": "assistant"}
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3

# The automaton.  States: 0 start; 1 H read; 2 first u; 3 P read; 4 further u; 5 "u a" and 6 "P u a" at their end; 7 s read.
SHIFT = {(0, "s"): 7, (1, "u"): 2, (3, "u"): 4, (2, "a"): 5, (4, "a"): 6}
REDUCE = {5: ("P", 2), 6: ("P", 3), 7: ("H", 1)}
EMPTY = {(0, "u"): "H"}  # reductions of nothing, by the next initial
GOTO = {(0, "H"): 1, (1, "P"): 3}
# Stacks by their tops, at the end of a row; a segment may begin with each of them.
STACKS = {0: (0,), 1: (0, 1), 2: (0, 1, 2), 3: (0, 1, 3), 4: (0, 1, 3, 4)}
ACCEPTING = {0: "", 1: "II", 2: "I", 3: "", 4: "I"}  # inserts that end a conversation at each top


def read(top: int, initial: str) -> int | None:
    """Top of the stack after reading ``initial`` on top of ``top`` with all reductions; None where it is no shift."""
    stack = list(STACKS[top])
    if (stack[-1], initial) in EMPTY:
        stack.append(GOTO[stack[-1], EMPTY[stack[-1], initial]])
    state = SHIFT.get((stack[-1], initial))
    if state is None:
        return None
    stack.append(state)
    while stack[-1] in REDUCE:
        name, length = REDUCE[stack[-1]]
        del stack[-length:]
        stack.append(GOTO[stack[-1], name])
    assert STACKS[stack[-1]] == tuple(stack)
    return stack[-1]


NEXT = {(top, c): read(top, c) for top in STACKS for c in "sua"}


def edits(top: int, initial: str, fault: int) -> list[tuple[int, int, str]]:
    """(next top, cost, audit) of all edits of one row: inserts before it, then one of keep, rerole and delete."""
    out = [(top, DELETE, "D")]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = CUT_SHORT if fault == TRUNCATED else 0
    ready, inserted = [(top, 0, "")], top
    for made in (1, 2):  # a third insert would come back to a top that reads the same
        inserted = NEXT[inserted, "a" if NEXT[inserted, "a"] is not None else "u"]
        ready.append((inserted, made * INSERT, "I" * made))
    for at, cost, audit in ready:
        if NEXT.get((at, initial)) is not None:
            out.append((NEXT[at, initial], cost + KEEP + extra, audit + "K"))
        out += [(NEXT[at, c], cost + REROLE + extra, audit + "R") for c in INITIALS if NEXT[at, c] is not None]
    return out


_EDITS = {(top, c, fault): edits(top, c, fault) for top in STACKS for c in ("s", "u", "a", "") for fault in range(4)}


def advance(tops: dict[int, tuple], step) -> dict[int, tuple]:
    """Tops after one step: ``step(top)`` gives (next top, cost, audit); equal tops merge to the least (cost, audit).

    A top's value is (cost, rank of its audit, trail); ranks order audits and trails are linked lists of their parts.
    """
    best: dict[int, tuple] = {}
    for top, (cost, rank, trail) in tops.items():
        for to, more, audit in step(top):
            found = (cost + more, (rank, audit), trail)
            if to not in best or found[:2] < best[to][:2]:
                best[to] = found
    order = {key: k for k, key in enumerate(sorted({b[1] for b in best.values()}))}
    return {to: (cost, order[key], (trail, key[1])) for to, (cost, key, trail) in best.items()}


def parse(rows: Iterable[tuple[str, int, int]], start: int = 0) -> dict[int, tuple[int, str]]:
    """Cheapest (cost, audit) by final top for rows (initial, fault, further equal rows, all deleted) from one top."""
    tops = {start: (0, 0, None)}
    for initial, fault, more in rows:
        known = initial if initial in ("s", "u", "a") else ""
        tops = advance(tops, lambda top: _EDITS[top, known, fault])
        if more:
            tops = {top: (cost + DELETE * more, rank, (trail, "D" * more)) for top, (cost, rank, trail) in tops.items()}
    return {top: (cost, written(trail)) for top, (cost, _, trail) in tops.items()}


def written(trail) -> str:
    """The audit of a linked list of parts."""
    parts = []
    while trail is not None:
        trail, part = trail
        parts.append(part)
    return "".join(reversed(parts))


def join_segments(tables: list[dict[int, dict[int, tuple[int, str]]]]) -> tuple[int, list[str], str]:
    """(cost, audit of each segment, closing inserts) of a conversation from its segments' results by first and last top."""
    tops = {0: (0, 0, None)}
    for table in tables:
        tops = advance(tops, lambda top, table=table: [(to, cost, audit) for to, (cost, audit) in table[top].items()])
    top, (cost, _, trail) = min(tops.items(), key=lambda t: (t[1][0] + INSERT * len(ACCEPTING[t[0]]), t[1][1]))
    parts = []
    while trail is not None:
        trail, part = trail
        parts.append(part)
    return cost + INSERT * len(ACCEPTING[top]), parts[::-1], ACCEPTING[top]


class Repairer:
    """Applies audits to rows in order and yields the repaired (role, text) turns."""

    def __init__(self):
        self.top = 0

    def _inserted(self) -> tuple[str, str]:
        initial = "a" if NEXT[self.top, "a"] is not None else "u"
        self.top = NEXT[self.top, initial]
        return INITIALS[initial], ""

    def apply(self, audit: Iterator[str], role: str, text: str, times: int) -> Iterator[tuple[str, str]]:
        """Turns of ``times`` equal rows; takes their edits from ``audit``."""
        for _ in range(times):
            edit = next(audit)
            while edit == "I":
                yield self._inserted()
                edit = next(audit)
            if edit == "K":
                self.top = NEXT[self.top, role[0]]
                yield role, text
            elif edit == "R":  # the top reads either a user or an assistant turn
                initial = "a" if NEXT[self.top, "a"] is not None else "u"
                self.top = NEXT[self.top, initial]
                yield INITIALS[initial], text

    def close(self, inserts: str) -> Iterator[tuple[str, str]]:
        """Turns inserted behind the last row."""
        for _ in inserts:
            yield self._inserted()


def damaged(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text; null role or text: one space) with damage by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes its ``[.!?]`` away, 3 repeats
    it, 4 makes its role user.  Nulls in the key are one space too.
    """
    blank = F.lit(" ")
    source = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                          F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (source.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                          F.when(kind == 3, 2).otherwise(1).alias("times"), kind.alias("kind")).where("kind <> 0").drop("kind"))


def runs(turns: DataFrame) -> DataFrame:
    """One row per different (conv_id, turn, role, text) with ``times``, digest ``key``, ``fault`` and ``initial``; written.

    Rows of one turn are in the order of ``key``, equal ones side by side.
    First faults: blank texts, then rows whose role and text come earlier in
    the conversation, then texts whose last character that is not white space
    is none of ``.!?``.  Counts combine before each shuffle, so neither a text
    nor a row repeated any number of times is a hot group.
    """
    spaced = "[^\\x20\\x09-\\x0D]"
    grouped = (turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
               .withColumn("key", F.md5(F.concat("role", F.lit("\x00"), "text"))))
    rows = stored(grouped, "turns")
    firsts = rows.groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k")).agg(F.min(F.struct(F.col("turn"))).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = rows.select("conv_id", "turn", "key").join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")))
    later = repeated.where(~F.col("turn").eqNullSafe(F.col("first.turn"))).select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("key").alias("k"))
    end = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    fault = (F.when(~F.col("text").rlike(spaced), BLANK).when(F.col("k").isNotNull(), DUPLICATE)
             .when(~F.substring(end, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("key") == F.col("k"))
    return stored(rows.join(later, same, "left").select(
        "conv_id", "turn", "role", "text", "times", "key", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"),
        F.floor(F.col("turn") / SEGMENT_TURNS).alias("segment")), "runs")


def _grouped(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """(first ``width`` values, rows) of consecutive rows that agree in them; rows are streamed."""
    rows = (row for batch in batches for lo in range(0, batch.num_rows, 1024)
            for row in zip(*(c.to_pylist() for c in batch.slice(lo, 1024).columns)))
    return itertools.groupby(rows, key=lambda row: row[:width])


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for part in batched(rows, 1000):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def segments(rows: DataFrame) -> DataFrame:
    """One row per segment of the rows of ``runs``: conv_id, segment, counts, and its cheapest repairs by first and last top (``table``).

    A conversation's first segment is parsed from the start alone.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("turns", pa.int64()), ("least", pa.int64()), ("most", pa.int64()),
                        ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
                        ("first", pa.string()), ("last", pa.string()), ("table", pa.binary())])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv, segment, start), part in _grouped(batches, 3):
            tops = {s: {s: (0, 0, None)} for s in (STACKS if segment != start else [0])}
            faults, illegal, first, last = [0, 0, 0, 0], 0, None, None
            turns, least, most = 0, None, None
            for _, _, _, turn, initial, fault, times in part:
                if turn is not None and turn != most:
                    turns, least, most = turns + 1, turn if least is None else least, turn
                faults[fault] += 1
                faults[fault if fault == BLANK else DUPLICATE] += times - 1
                illegal += (last is not None and last + initial not in ("su", "ua", "au")) + (times - 1)
                first, last = initial if first is None else first, initial
                known = initial if initial in ("s", "u", "a") else ""
                for s, now in tops.items():
                    now = advance(now, lambda top: _EDITS[top, known, fault])
                    if times > 1:
                        now = {top: (cost + DELETE * (times - 1), rank, (trail, "D" * (times - 1))) for top, (cost, rank, trail) in now.items()}
                    tops[s] = now
            table = {s: {top: (cost, written(trail)) for top, (cost, _, trail) in now.items()} for s, now in tops.items()}
            yield conv, segment, turns, least, most, faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal, first, last, pickle.dumps(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(parsed(batches), schema)

    starts = rows.groupBy(F.col("conv_id").alias("c")).agg(F.min(F.struct("segment")).alias("s"))
    light = rows.select("conv_id", "segment", "turn", "initial", "fault", "times", "key").join(starts, F.col("conv_id").eqNullSafe(F.col("c")))
    ordered = (light.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "turn", "key")
               .select("conv_id", "segment", F.col("s.segment").alias("start"), "turn", "initial", "fault", "times"))
    return map_arrow(ordered, run, "conv_id long, segment long, turns long, least long, most long, blank long, duplicate long, truncated long, "
                                   "illegal long, first string, last string, table binary")


def audits(parts: DataFrame) -> DataFrame:
    """Rows of two kinds from the rows of ``segments``: each segment's audit, and one row per conversation with its totals.

    conv_id, segment, audit; for a conversation's row (``totals`` not null)
    the audit is that of the turns inserted at its end.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("audit", pa.string()), ("totals", pa.list_(pa.int64()))])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), part in _grouped(batches, 1):
            tables, names, totals, turns, least, most, last = [], [], [0, 0, 0, 0], 0, None, None, None
            for _, segment, n, lo, hi, *counts, first, end, table in part:
                names.append(segment)
                tables.append(pickle.loads(table))
                totals = [a + b for a, b in zip(totals, counts)]
                totals[3] += last is not None and last + first not in ("su", "ua", "au")
                last = end
                if lo is not None:
                    turns, least, most = turns + n, lo if least is None else least, hi
            cost, texts, closing = join_segments(tables)
            yield from ((conv, segment, text, None) for segment, text in zip(names, texts))
            yield conv, None, closing, [0 if least is None else most - least + 1 - turns, *totals, cost]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(joined(batches), schema)

    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "segment").select("conv_id", "segment", *[
        c for c in parts.columns if c not in ("conv_id", "segment")])
    return map_arrow(ordered, run, "conv_id long, segment long, audit string, totals array<long>")


def _streams(turns: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """Per conversation, in order: each segment's audit (place 0) before its rows (1), closing inserts and totals (2); a mark (3) of each given id."""
    none, text = F.lit(None).cast("long"), F.lit(None).cast("string")
    audit = found.select("conv_id", F.when(F.col("totals").isNull(), 0).otherwise(2).alias("place"), "segment", none.alias("turn"), text.alias("key"),
                         text.alias("role"), F.col("audit").alias("text"), none.alias("times"), "totals")
    empty = F.lit(None).cast("array<bigint>").alias("totals")
    body = rows.select("conv_id", F.lit(0).alias("place"), "segment", "turn", "key", "role", "text", "times", empty)
    marks = (turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
             .select("conv_id", F.lit(3).alias("place"), none.alias("segment"), none.alias("turn"), text.alias("key"), text.alias("role"), text.alias("text"),
                     none.alias("times"), empty))
    # within a segment its audit, which has no times, comes first
    both = audit.unionByName(body).unionByName(marks).withColumn("row", F.col("times").isNotNull())
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", "place", "segment", "row", "turn", "key")
            .select("conv_id", "place", "role", "text", "times", "totals"))


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    """('turn', role, text), ('audit', text) and ('totals', list) items of one conversation's stream."""
    state, audit = Repairer(), iter("")
    for _, place, role, text, times, totals in rows:
        if times is not None:
            yield from (("turn", *turn) for turn in state.apply(audit, role, text, times))
        elif place == 0:
            audit = iter(text)
            yield "audit", text
        elif place == 2:
            yield "audit", text
            yield from (("turn", *turn) for turn in state.close(text))
            yield "totals", totals


def _worked(turns: DataFrame) -> DataFrame:
    rows = runs(damaged(turns))
    return _streams(turns, rows, stored(audits(segments(rows)), "audits"))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role and text of each turn."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), rows in _grouped(batches, 1):
            kept = (item for item in _repaired(rows) if item[0] == "turn")
            yield from ((conv, k, role, text) for k, (_, role, text) in enumerate(kept))

    return map_arrow(_worked(turns), lambda batches: _batches(made(batches), schema), "conv_id long, place long, role string, text string")


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Null texts and roles are one space: blank, and of no role of the grammar;
    so is an empty role.  Null turns come first.  A null conversation id is a
    conversation of its own.  Rows of one turn are ordered by a digest of role
    and text, equal rows side by side.  A conversation without rows after the
    damage has zeros, an empty audit and the digest of no text.  Texts of any
    length are taken whole; other columns are not read; no rows give no rows.

    The digest streams a conversation's rows through one task; it holds the
    audit and one batch of rows.  All else is shared out by segments.
    """
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in names], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), rows in _grouped(batches, 1):
            digest, audit, numbers, begun = hashlib.sha256(), [], [0] * len(names), False
            for kind, *value in _repaired(rows):
                if kind == "turn":
                    digest.update(("\n" * begun + f"{value[0]}:{value[1]}").encode())
                    begun = True
                elif kind == "audit":
                    audit.append(value[0])
                else:
                    numbers = value[0]
            yield conv, *numbers, "".join(audit), digest.hexdigest()

    return map_arrow(_worked(turns), lambda batches: _batches(digests(batches), schema),
                     "conv_id long, " + ", ".join(f"{n} long" for n in names) + ", audit string, repaired_sha256 string")
