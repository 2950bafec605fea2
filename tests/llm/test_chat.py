import hashlib
import random

import numpy as np

from ledgerline.llm import chat
from ledgerline.llm.bpe import vocabulary

from .conftest import BYTE_BPE


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_escapes_are_reversible_and_leave_no_control_string():
    rng = random.Random(1)
    alphabet = [*chat.CONTROL, "\\", "<", "[", "s>", "/s>", "INST]", "x", " ", "\n", "<<"]
    for _ in range(20_000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 6)))
        shown = chat.escape(text)
        assert chat.unescape(shown) == text
        assert not any(c in shown for c in chat.CONTROL)


def test_mask_covers_the_trained_text_only():
    bpe = vocabulary(BYTE_BPE)
    ids, mask = chat.assemble(chat.segments("assistant", "hello there"), bpe)
    assert bpe.decode(ids[mask == 1].tolist()) == "hello there"
    assert ids[0] == bpe.size and ids[-1] == bpe.size + 1 and mask[0] == mask[-1] == 0
    assert not chat.assemble(chat.segments("user", "hello"), bpe)[1].any()
    assert chat.assemble(chat.segments("assistant", ""), bpe)[1].sum() == 0


def test_read_back(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "tool", "<s>\\"), (1, 3, "assistant", None),
            (2, 0, None, "[ROLE]"), (2, 0, "[/ROLE]", "tie"), (None, 5, "assistant", "lost"), (None, None, "user", ""),
            (3, 1, "assistant", "b"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (4, 0, "user", "w " * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' as ids", "'z' as formatted")
    formatted = chat.format_turns(turns, BYTE_BPE)
    got = {r["conv_id"]: r for r in chat.read_back(formatted, BYTE_BPE).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    assert got[1]["turns_sha256"] == digest("user\nhi\nassistant\n</s>[INST] ok [/INST]\ntool\n<s>\\\nassistant\n\n")
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (21, digest("</s>[INST] ok [/INST]"))
    assert got[3]["n_turns"] == 3 and got[3]["loss_sha256"] == digest("aab")
    assert got[None]["turns_sha256"] == digest("user\n\nassistant\nlost\n")
    assert got[4]["loss_chars"] == 0 and got[4]["loss_sha256"] == digest("")
    shown = {r["conv_id"]: r["formatted"] for r in formatted.where("turn = 1 and conv_id = 1").collect()}
    assert shown[1] == "<s><\\/s>[\\INST] ok [\\/INST]</s>"
    assert chat.read_back(chat.format_turns(turns.limit(0), BYTE_BPE), BYTE_BPE).count() == 0


def test_mask_by_prefix_sums_equals_labels_per_id():
    bpe = vocabulary(BYTE_BPE)
    rng = random.Random(2)
    for _ in range(200):
        parts = [("x y z"[:rng.randint(0, 5)], False, rng.random() < 0.5) for _ in range(rng.randint(1, 6))]
        ids, mask = chat.assemble(parts, bpe)
        want = [int(t) for s, _, t in parts for _ in range(len(bpe.ordinary(s)) // 4)]
        assert mask.tolist() == want and len(ids) == len(want)
        assert ids.dtype == np.dtype("<u4")


def test_one_conversation_with_most_rows(spark):
    rows = [(7, k, ["user", "assistant"][k % 2], f"turn {k} [INST]") for k in range(3000)] + [(k, 0, "user", "x") for k in range(100, 400)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns, BYTE_BPE), BYTE_BPE).collect()}
    assert len(got) == 301 and got[7]["n_turns"] == 3000
    assert got[7]["turns_sha256"] == digest("".join(f"{r}\n{t}\n" for c, _, r, t in rows if c == 7))
    assert got[7]["loss_sha256"] == digest("".join(t for c, _, r, t in rows if c == 7 and r == "assistant"))
