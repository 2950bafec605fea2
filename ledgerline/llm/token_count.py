"""Token counts of whole texts for a piece vocabulary with byte fallback, without making ids.

Neighbouring symbols are merged in the order of their pieces' ranks, leftmost
first among equals, by popping a heap and relinking a list of symbols.  The
count is the number of initial symbols (a character outside the vocabulary
counts its UTF-8 bytes) minus the number of merges.

No piece reaches over a space into the next word, nor over two characters
that stand side by side in no piece, so texts are counted word by word and
frequent words are remembered within bounds.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordCache, map_arrow, take_turn, text_lists

SPACE = "▁"
_RUNS = re.compile(r" *[^ ]+| +")


def count_merges(symbols: str, ranks: dict[str, int]) -> int:
    """Number of merges that a run of characters allows."""
    n = len(symbols)
    piece, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []
    for i in range(n - 1):
        r = ranks.get(symbols[i:i + 2])
        if r is not None:
            queue.append((r, i, 2))
    heapq.heapify(queue)
    merges = 0
    while queue:
        _, i, size = heapq.heappop(queue)
        j = after[i]
        if not piece[i] or j >= n or len(piece[i]) + len(piece[j]) != size:
            continue
        merges += 1
        piece[i] += piece[j]
        piece[j] = ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            both = piece[i] + piece[k]
            r = ranks.get(both)
            if r is not None:
                heapq.heappush(queue, (r, i, len(both)))
        h = before[i]
        if h >= 0:
            both = piece[h] + piece[i]
            r = ranks.get(both)
            if r is not None:
                heapq.heappush(queue, (r, h, len(both)))
    return merges


class PieceCounter:
    """Counts of a piece vocabulary (identity normalization, dummy prefix, byte fallback)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        if train.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or train.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: only piece models by BPE without normalization are supported")
        if any(p.type in (4, 5) for p in model.pieces):
            raise ValueError(f"{path}: user-defined or unused pieces are not supported")
        normal = [p for p in model.pieces if p.type == 1]
        order = {s: r for r, s in enumerate(sorted({p.score for p in normal}, reverse=True))}
        self.prefix, self.bytes = norm.add_dummy_prefix, train.byte_fallback
        self.ranks = {p.piece: order[p.score] for p in normal}
        self.pairs = {p.piece[i:i + 2] for p in normal for i in range(len(p.piece) - 1)}
        self.words_apart = not any(SPACE in p.piece.lstrip(SPACE) for p in normal)
        self.lines_apart = self.words_apart and not any("\n" in p.piece for p in normal)
        self.runs = WordCache(self._run, 300_000)
        self.words = WordCache(self._word, 200_000)
        self.raw = WordCache(self._raw, 20_000)

    def _run(self, run: str) -> int:
        start = sum(1 if c in self.ranks else len(c.encode()) if self.bytes else 1 for c in run)
        return start - (count_merges(run, self.ranks) if len(run) > 1 else 0)

    def _raw(self, symbols: str) -> int:
        total, lo, pairs = 0, 0, self.pairs
        for i in range(1, len(symbols)):
            if symbols[i - 1:i + 1] not in pairs:
                total += self.runs[symbols[lo:i]]
                lo = i
        return total + self.runs[symbols[lo:]] if symbols else 0

    def _word(self, word: str) -> int:
        return self._raw(word if word[:1] == "\n" else SPACE + word)

    def count(self, text: str) -> int:
        """Number of tokens of ``text``."""
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        if self.prefix and self.lines_apart and "  " not in text and text[0] != " ":
            return sum(map(self.words.__getitem__, text.replace("\n", " \n").split(" ")))
        text = " " + text if self.prefix else text
        runs = _RUNS.findall(text) if self.words_apart else [text]
        return sum(self.raw[r.replace(" ", SPACE)] for r in runs)


@lru_cache(maxsize=2)
def _read(path: str) -> PieceCounter:
    return PieceCounter(path)


def counter(path: str) -> PieceCounter:
    """The counter of a file, read once per worker."""
    return take_turn(_read(path))


def token_counts(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of each row's whole text, one row per row.

    Null and empty texts have no bytes and no tokens.  Special strings inside a
    text are ordinary text; nothing is added, cut or padded.  Ids may repeat or
    be null; other columns are not read; an empty table gives an empty table.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(path)
        for batch in batches:
            for lo, hi, texts in text_lists(batch.column("text")):
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo), batch.column("n_bytes").slice(lo, hi - lo),
                    pa.array([pieces.count(t) for t in texts], pa.int64())], schema=schema)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    counted = map_arrow(source, run, "doc_id long, n_bytes long, n_tokens long", words=True)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
