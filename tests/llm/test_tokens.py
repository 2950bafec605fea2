import hashlib
import os
import random
import zlib

os.environ["TOKENIZERS_PARALLELISM"] = "false"

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerline.llm import bpe, packing, token_count
from ledgerline.llm.common import WordCache, chunks, whole_chunk

from .conftest import BYTE_BPE, CASES, PIECES

ALPHABET = [*"abctheion  \n\n\t.,'sve ▁éñüß漢字🙂  \x85\x1c\r½²Ⅷ_0123", "<|endoftext|>", "</s>", "<s>", "   ", "'re", "I'll", " the", "́", "​"]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def test_chunks_concatenate_to_the_text():
    for text in random_texts(2000, 1):
        first, *rest = chunks(text)
        assert first + "".join(map(whole_chunk, rest)) == text


def test_word_cache_is_bounded():
    cache = WordCache(len, limit=10)
    for k in range(1000):
        assert cache[str(k)] == len(str(k))
    assert len(cache) <= 10 and len(cache.old) <= 10
    assert cache["x" * 1000] == 1000 and "x" * 1000 not in cache


def test_own_bpe_and_library_encoder_equal_the_library(library):
    own, bulk = bpe.ByteBpe(BYTE_BPE), packing.LibraryEncoder(BYTE_BPE)
    for text in random_texts(3000, 2):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == want
        assert np.frombuffer(bulk.encode(text), "<u4").tolist() == want
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_decode_of_ids_that_cut_characters(library):
    own = bpe.ByteBpe(BYTE_BPE)
    rng = random.Random(3)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(8)]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_piece_counts_equal_the_library():
    pieces, counter = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_count.PieceCounter(PIECES)
    for text in random_texts(3000, 4) + [t or "" for _, t in CASES]:
        assert counter.count(text) == len(pieces.encode(text)), repr(text)


def test_token_counts_over_cases(cases, no_rows):
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted(map(tuple, token_count.token_counts(cases, PIECES).collect()), key=str)
    want = [(i, len((t or "").encode()), len(pieces.encode(t or "")), len(pieces.encode(t or "")) > 4096) for i, t in CASES]
    assert got == sorted(want, key=str)
    assert token_count.token_counts(no_rows, PIECES).count() == 0


def test_round_trip_over_cases(cases, no_rows, library):
    got = sorted(map(tuple, bpe.round_trip(cases, BYTE_BPE).collect()), key=str)
    want = []
    for i, t in CASES:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(no_rows, BYTE_BPE).count() == 0


def test_decode_ids_column(cases):
    encoded = bpe.encode_and_check(cases, BYTE_BPE).withColumnRenamed("decoded_sha256", "decoded")
    got = sorted((r["doc_id"] is None, r["doc_id"], r["decoded"]) for r in bpe.decode_ids(encoded, BYTE_BPE).collect() if r["doc_id"] is not None)
    assert got == sorted((False, i, t or "") for i, t in CASES if i is not None)


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 16, 17, 20, 31, 32])
def test_pack_round_trip_and_random_access(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    data = packing.pack(ids, bits)
    assert len(data) == (1001 * bits + 7) // 8
    assert (packing.unpack(data, bits, 0, 1001) == ids).all()
    assert (packing.unpack(data, bits, 37, 555) == ids[37:555]).all()
    assert len(packing.unpack(data, bits, 5, 5)) == 0


def test_pack_refuses_ids_that_do_not_fit():
    with pytest.raises(ValueError):
        packing.pack(np.array([8], np.uint32), 3)


def test_packed_folder(spark, cases, no_rows, library, tmp_path):
    path = packing.write_packed(cases, str(tmp_path / "packed"), BYTE_BPE)
    got = sorted(map(tuple, packing.read_packed(spark, path).collect()), key=lambda r: r[1])
    ids = {(i, t): [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in CASES}
    assert [r[0] for r in got] == sorted((i for i, _ in CASES), key=lambda i: (i is not None, i or 0))
    start = 0
    for doc_id, at, n, crc in got:
        assert at == start
        start += n
        assert (n, crc) in {(len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for (i, _), v in ids.items() if i == doc_id}
    assert packing.document_ids(spark, path, 6) == [ids[6, CASES[9][1]]]
    empty = packing.write_packed(no_rows, str(tmp_path / "none"), BYTE_BPE)
    assert packing.read_packed(spark, empty).count() == 0


def test_columns_are_cut_where_no_token_reaches_over():
    """Every character up to U+30FF beside spaces and newlines, random mixes, slices, empty texts: ids as the library gives them."""
    import random

    import pyarrow as pa

    from ledgerline.llm.packing import library

    encoder = library(BYTE_BPE)
    rng = random.Random(8)
    parts = ["a", "B", "é", "à", "ç ", "  ", " ", "\n", "\n\n", "\r\n", "\t", "1", "23", ".", "!", "'s", "漢字", " ", " ", "　", "\x85", " ",
             " ", "<|endoftext|>", "🙂", "ß", "x.", "\x1c", "​", "½", "hello ", "World, "]
    texts = ["a " + chr(c) + " b" + chr(c) + "c \n" + chr(c) + "\nd" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(5000)] + ["", " ", "\n"]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [i.tolist() for i in encoder.encode_column(pa.array(texts))] == want
    assert [i.tolist() for i in encoder.encode_column(pa.array(["left out", *texts]).slice(1, 700))] == want[:700]
    assert encoder.encode_column(pa.array(["", ""]))[1].tolist() == [] and encoder.encode_column(pa.array([], pa.string())) == []
