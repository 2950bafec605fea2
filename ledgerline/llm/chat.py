"""Chat formatting at token level: segments are encoded by themselves and reserved ids are spliced between them.

Every turn is ``open role, text, close``.  The open and close marks are
reserved ids above the vocabulary, so no text can make them.  Roles without a
mark of their own are written out between marks.  The readable form shows the
marks as control strings; where a text contains a control string, a backslash
is put after its first character (and one more where some stand there), which
is taken away again on reading, so any text survives.

The loss mask is 1 on the ids of assistant texts: marks of +1 and -1 at the
segment borders are summed from the left.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import vocabulary
from .common import map_arrow

# The control strings of the template, in the order of their reserved ids.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]"]
# Open and close marks by role; any other role is written as [ROLE] name [/ROLE] text [/TURN].
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
TRAINED = "assistant"
_ESCAPE = re.compile("([<\\[])(\\\\*)(" + "|".join(re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True)) + ")")


def escape(text: str) -> str:
    """``text`` with a backslash inside each control string, so that none is left whole."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return _ESCAPE.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def segments(role: str, text: str) -> list[tuple[str, bool, bool]]:
    """(string, is a control string, is trained on) of one turn; texts are escaped."""
    body = (escape(text), False, role == TRAINED)
    if role in MARKS:
        left, right = MARKS[role]
        return [(left, True, False), body, (right, True, False)]
    return [("[ROLE]", True, False), (escape(role), False, False), ("[/ROLE]", True, False), body, ("[/TURN]", True, False)]


def assemble(parts: list[tuple[str, bool, bool]], bpe) -> tuple[np.ndarray, np.ndarray]:
    """Ids of encoded segments with reserved ids spliced in, and the loss mask by prefix sums."""
    reserved = {c: bpe.size + i for i, c in enumerate(CONTROL)}
    encoded = [np.array([reserved[s]], "<u4") if control else np.frombuffer(bpe.ordinary(s), "<u4") for s, control, _ in parts]
    ends = np.cumsum([len(e) for e in encoded])
    step = np.zeros(int(ends[-1]) + 1, np.int64)
    trained = np.array([t for _, _, t in parts])
    np.add.at(step, (ends - [len(e) for e in encoded])[trained], 1)
    np.add.at(step, ends[trained], -1)
    return np.concatenate(encoded), np.cumsum(step[:-1]).astype(np.uint8)


def format_turns(turns: DataFrame, path: str) -> DataFrame:
    """One row per turn: conv_id, turn, formatted (readable), ids (array<int>), loss_mask (array<tinyint>).

    A conversation's output is that of its turns in the order of ``turn``
    (equal turns: of ``formatted``); turns are formatted by themselves, so a conversation
    of any length needs no group.  Null texts and roles are empty.  Null conversation ids
    and turns are kept, and so are repeated rows.  Texts are encoded whole.  Other columns are not read; an empty table gives an empty table.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()),
                        ("ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.int8()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                shown, ids, masks = [], [], []
                for role, text in zip(part.column("role").to_pylist(), part.column("text").to_pylist()):
                    parts = segments(role or "", text or "")
                    shown.append("".join(s for s, _, _ in parts))
                    a, m = assemble(parts, bpe)
                    ids.append(a.astype(np.int32))
                    masks.append(m.astype(np.int8))
                yield pa.RecordBatch.from_arrays([
                    part.column("conv_id"), part.column("turn"), pa.array(shown, pa.string()),
                    pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))], schema=schema)

    source = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return map_arrow(source, run, "conv_id long, turn long, formatted string, ids array<int>, loss_mask array<tinyint>", words=True)


def parse_turn(ids: np.ndarray, mask: np.ndarray, bpe) -> tuple[str, str, str]:
    """(role, text, text under the mask) read from a turn's ids and mask; a masked text is decoded once."""
    at = np.flatnonzero(ids >= bpe.size).tolist()
    names = [CONTROL[int(ids[k]) - bpe.size] for k in at]
    parts = [(a + 1, b) for a, b in zip(at, at[1:])]

    def shown(lo: int, hi: int) -> str:
        return unescape(bpe.decode(ids[lo:hi].tolist()))

    if names[0] == "[ROLE]":
        if names != ["[ROLE]", "[/ROLE]", "[/TURN]"]:
            raise ValueError(f"marks out of order: {names}")
        role, body = shown(*parts[0]), parts[1]
    else:
        role, body = next(r for r, m in MARKS.items() if list(m) == names), parts[0]
    text = shown(*body)
    trained = int(np.count_nonzero(mask))
    if not trained:
        return role, text, ""
    if trained == body[1] - body[0] and mask[body[0]:body[1]].all():
        return role, text, text
    return role, text, unescape(bpe.decode(ids[mask.astype(bool)].tolist()))


def read_turns(formatted: DataFrame, path: str) -> DataFrame:
    """One row per turn, read from the output of ``format_turns`` by itself: conv_id, turn, formatted, role, text, loss.

    ``loss`` is the text under the loss mask, null where it is the text itself.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()), ("role", pa.string()), ("text", pa.string()), ("loss", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids, mask = part.column("ids"), part.column("loss_mask")
                id_at, mask_at = ids.offsets.to_numpy(), mask.offsets.to_numpy()
                all_ids, all_mask = ids.values.to_numpy(), mask.values.to_numpy()
                turns = [parse_turn(all_ids[id_at[k]:id_at[k + 1]], all_mask[mask_at[k]:mask_at[k + 1]], bpe) for k in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([
                    part.column("conv_id"), part.column("turn"), part.column("formatted"), pa.array([r for r, _, _ in turns], pa.string()),
                    pa.array([t for _, t, _ in turns], pa.string()), pa.array([None if x is t else x for _, t, x in turns], pa.string())], schema=schema)

    source = formatted.select("conv_id", "turn", "formatted", "ids", "loss_mask")
    return map_arrow(source, run, "conv_id long, turn long, formatted string, role string, text string, loss string", words=True)


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """One row per conversation, read from the output of ``format_turns``.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn),
    loss_chars and loss_sha256 (all text under the loss mask), formatted_chars.
    Turns are decoded by themselves, wherever they lie.  Only a digest takes a
    conversation's turns one after another, so their texts are streamed through
    one task in order; it holds running digests and one batch of rows, whatever
    the length of the conversation.  Repeated rows count as often as they stand there.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        now, conv = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                for conv_id, role, text, loss, chars in zip(*(c.to_pylist() for c in batch.slice(lo, 512).columns)):
                    if now is None or conv_id != conv:
                        if now is not None:
                            yield [conv, now[0], now[1].hexdigest(), now[2], now[3].hexdigest(), now[4]]
                        now, conv = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], conv_id
                    loss = text if loss is None else loss
                    now[0] += 1
                    now[1].update(f"{role}\n{text}\n".encode())
                    now[2] += len(loss)
                    now[3].update(loss.encode())
                    now[4] += chars
        if now is not None:
            yield [conv, now[0], now[1].hexdigest(), now[2], now[3].hexdigest(), now[4]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in digests(batches):
            rows.append(row)
            if len(rows) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ordered = (read_turns(formatted, path).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
               .select("conv_id", "role", "text", "loss", F.length("formatted").cast("long").alias("chars")))
    return map_arrow(ordered, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
