"""Byte-level BPE encoding and decoding of whole texts.

A pre-token's bytes form a doubly linked list of symbols.  A priority queue
holds the ranks of mergeable neighbours; the lowest rank (the leftmost of
equal ones) is merged first and entries whose symbols have changed meanwhile
are skipped.  Decoding concatenates the vocabulary's byte strings.

The vocabulary is read from a public tokenizer file whose path is a
parameter.  Results of frequent words are remembered within bounds.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordCache, chunks, map_arrow, take_turn, text_lists, whole_chunk

# The pre-token pattern of byte-level BPE vocabularies.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bytes that a byte-level vocabulary writes as the character of the same number.
SHOWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_characters() -> dict[str, int]:
    """Byte by vocabulary character; bytes that are not shown take characters from 256 on, in order."""
    hidden = [b for b in range(256) if b not in set(SHOWN_BYTES)]
    return {chr(b): b for b in SHOWN_BYTES} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merge(symbols: list[int], ranks: list[dict[int, int]], merged: list[int]) -> list[int]:
    """Symbols after all merges; ``ranks[left][right]`` is a pair's rank, ``merged`` gives the symbol of a rank."""
    n = len(symbols)
    if n < 2:
        return symbols
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []
    for i in range(n - 1):
        r = ranks[symbols[i]].get(symbols[i + 1])
        if r is not None:
            queue.append(r << 32 | i)
    heapq.heapify(queue)
    while queue:
        entry = heapq.heappop(queue)
        r, i = entry >> 32, entry & 0xFFFFFFFF
        j = after[i]
        if symbols[i] < 0 or j >= n or ranks[symbols[i]].get(symbols[j]) != r:
            continue
        new = symbols[i] = merged[r]
        symbols[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            s = ranks[new].get(symbols[k])
            if s is not None:
                heapq.heappush(queue, s << 32 | i)
        h = before[i]
        if h >= 0:
            s = ranks[symbols[h]].get(new)
            if s is not None:
                heapq.heappush(queue, s << 32 | h)
    return [s for s in symbols if s >= 0]


class PretokenEncoder:
    """Little-endian 32-bit ids of texts, pre-token by pre-token; those of frequent words are remembered within bounds."""

    MARKS = frozenset(".,;:!?")

    def __init__(self, limit: int = 200_000):
        self.pretokens = regex.compile(PRETOKEN).findall
        self.words = WordCache(self.word_ids, limit)
        self.first = WordCache(self._first, 20_000)
        self.rest = WordCache(self._rest, limit)

    def word_ids(self, word: str) -> bytes:
        """Ids of one pre-token."""
        raise NotImplementedError

    def _first(self, piece: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.pretokens(piece)))

    def _rest(self, piece: str) -> bytes:
        # letters, or letters and one mark, are pre-tokens as they are
        if piece.isalpha():
            return self.word_ids(" " + piece)
        if piece[-1:] in self.MARKS and piece[:-1].isalpha():
            return self.words[" " + piece[:-1]] + self.words[piece[-1]]
        return self._first(whole_chunk(piece))

    def ordinary(self, text: str) -> bytes:
        """Ids of ``text``; special strings count as ordinary text."""
        parts = iter(chunks(text))
        return self.first[next(parts)] + b"".join(map(self.rest.__getitem__, parts))


class ByteBpe(PretokenEncoder):
    """A byte-level BPE vocabulary: ids of a text, text of ids."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        to_byte = byte_characters()
        size = max([*vocab.values(), *[t["id"] for t in spec["added_tokens"]]]) + 1
        self.strings: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(map(to_byte.__getitem__, token)) if all(c in to_byte for c in token) else token.encode()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.of_byte = [0] * 256
        for c, b in to_byte.items():
            self.of_byte[b] = vocab[c]
        self.ranks, self.merged = [{} for _ in range(size)], []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left]][vocab[right]] = rank
            self.merged.append(vocab[left + right])
        names = sorted(self.special, key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None

    @property
    def size(self) -> int:
        """Number of ids, special ones included."""
        return len(self.strings)

    def word_ids(self, word: str) -> bytes:
        """Ids of one pre-token, by merging its bytes."""
        ids = merge(list(map(self.of_byte.__getitem__, word.encode())), self.ranks, self.merged)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of ``text``; special strings become their ids."""
        if self.special_split is None or not any(s in text for s in self.special):
            return self.ordinary(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self.ordinary(p)
                        for p in self.special_split(text) if p)

    def decode_bytes(self, ids: list[int]) -> bytes:
        """The vocabulary strings of ``ids``, concatenated."""
        return b"".join(map(self.strings.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``; bytes that are no UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _read(path: str) -> ByteBpe:
    return ByteBpe(path)


def vocabulary(path: str) -> ByteBpe:
    """The vocabulary of a file, read once per worker."""
    return take_turn(_read(path))


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with a column ``decoded``: the text of the ids in ``ids_col`` (null and empty ids: empty text).

    A column of that name is replaced.  Ids outside the vocabulary raise.
    """
    rows = rows.drop("decoded")
    kept = [c for c in rows.columns if c != ids_col]
    ordered = rows.select(*kept, F.col(ids_col).cast("binary").alias(ids_col))
    names = [*ordered.columns, "decoded"]
    schema = ordered.select("*", F.lit("").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for lo, hi, texts in text_lists(batch.column(ids_col).fill_null(b"")):
                out = [bpe.decode(np.frombuffer(t, "<u4").tolist()) for t in texts]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], names=names)

    return map_arrow(ordered, run, schema, words=True)


def encode_and_check(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian 32-bit) and decoded_sha256 (digest of the decoded ids) per row.

    Null texts are empty and give no ids; the digest is then that of no bytes.  Special strings
    inside a text give their ids, nothing is added, cut or padded.  Ids may
    repeat or be null; other columns are not read; an empty table gives an empty table.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for lo, hi, texts in text_lists(batch.column("text")):
                ids = [bpe.encode(t) for t in texts]
                back = [bpe.decode(np.frombuffer(i, "<u4").tolist()) for i in ids]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back], pa.string())], schema=schema)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(source, run, "doc_id long, n_tokens long, ids binary, decoded_sha256 string", words=True)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row, from ``encode_and_check``."""
    done = encode_and_check(docs, path, id_col, text_col)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")
