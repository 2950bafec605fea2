"""Token ids in bit-packed blocks: fixed-width ids, block offsets, random access.

File format: a folder of Parquet files, one row per block, written by Spark's
committer so that a lost task leaves nothing behind.  A block holds the ids of
whole consecutive documents, each id in the fewest bits that hold the largest
id of the vocabulary, most significant bit first, without gaps:

    shard, block   place of the block; documents ascend over shards and blocks
    first          ids of the shard before the block
    n_ids, bits    number of ids in ``payload`` and bits of each
    doc_ids        the block's document ids, null where null
    ends           for each document, ids of the block up to its end
    payload        the packed ids

Id ``i`` of a block begins at bit ``i * bits``, so any range is read from its
own bytes alone, by numpy.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import PretokenEncoder, byte_characters
from .common import WordCache, int_ranges, map_arrow, slices, take_turn, text_hash

BLOCK_IDS = 1 << 16
SLICE = 8 << 20  # bytes of text encoded at a time
SCHEMA = "shard int, block int, first long, n_ids long, bits int, doc_ids array<long>, ends array<long>, payload binary"


def bits_for(largest: int) -> int:
    """Fewest bits that hold every id up to ``largest``."""
    return max(1, int(largest).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` (below 2**32) at ``bits`` bits each; the last byte is filled with zeros."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits:].ravel()).tobytes()


def unpack(payload: bytes, bits: int, lo: int, hi: int) -> np.ndarray:
    """Ids ``lo`` to ``hi`` (exclusive) of a packed block; reads only their bytes."""
    if hi <= lo:
        return np.zeros(0, np.uint32)
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f">u{bits // 8}", hi - lo, lo * bits // 8).astype(np.uint32)
    first = lo * bits // 8
    part = np.unpackbits(np.frombuffer(payload, np.uint8, (hi * bits + 7) // 8 - first, first))
    part = part[lo * bits - first * 8:][:(hi - lo) * bits].reshape(-1, bits)
    wide = np.zeros((hi - lo, 32), np.uint8)
    wide[:, 32 - bits:] = part
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


SPACE, NEWLINE = 0x20, 0x0A
# White space of more than one byte in UTF-8, by its last byte and the bytes before it.
WIDE_SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_NARROW = np.zeros(256, bool)
_NARROW[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_OPENS_WIDE = np.zeros(256, bool)
_OPENS_WIDE[[c.encode()[0] for c in WIDE_SPACES]] = True
_WIDE_ENDS = {c.encode()[:-1]: np.zeros(256, bool) for c in WIDE_SPACES}
for _c in WIDE_SPACES:
    _WIDE_ENDS[_c.encode()[:-1]][_c.encode()[-1]] = True


def piece_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin in their bytes: at each text's start, and at each single space or newline between other characters.

    No pre-token reaches over such a place (see ``common.chunks``); a piece
    holds the space or newline before it.  Where a character of several bytes
    may be white space, nothing is cut.
    """
    mask = data == SPACE
    mask |= data == NEWLINE
    mask[starts] = False  # a text may begin with a space, and end with one
    mask[starts[1:] - 1] = False
    mask[-1] = False
    at = np.flatnonzero(mask)
    before, after = data[at - 1], data[at + 1]
    wrong = _NARROW[before]
    wrong |= _NARROW[after]
    wrong |= _OPENS_WIDE[after]
    wide = np.flatnonzero(before >= 0x80)
    if len(wide):
        place = at[wide]
        for lead, ends in _WIDE_ENDS.items():
            hit = ends[data[place - 1]]
            for k, byte in enumerate(reversed(lead)):
                hit &= data[np.maximum(place - 2 - k, 0)] == byte
            wrong[wide[hit]] = True
    mask[at[wrong]] = False
    mask[starts] = True
    return np.flatnonzero(mask)


class LibraryEncoder(PretokenEncoder):
    """Texts to 32-bit ids by the tokenizers library.

    A column of texts is cut into pieces by numpy, its different pieces are
    found by Arrow, and each is encoded once by the library's model (frequent
    ones are remembered within bounds); the ids are then gathered by place.
    """

    def __init__(self, path: str):
        super().__init__(limit=100_000)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.largest = self.tokenizer.get_vocab_size() - 1
        self.model = self.tokenizer.model
        self.shown = {b: ord(c) for c, b in byte_characters().items()}
        self.space = chr(self.shown[SPACE])
        self.pieces = WordCache(self._piece, 400_000)

    def word_ids(self, word: str) -> bytes:
        """Ids of one pre-token, by the library's model."""
        shown = word.translate(self.shown) if word.isascii() else word.encode().decode("latin-1").translate(self.shown)
        ids = [t.id for t in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        # letters behind a space, also with one mark at their end, are pre-tokens as they are
        body = piece[1:] if piece[:1] == " " else piece
        if body.isalpha():
            if body.isascii():  # letters stand for themselves, the space has a character of its own
                ids = [t.id for t in self.model.tokenize(body if body is piece else self.space + body)]
                return struct.pack(f"<{len(ids)}I", *ids)
            return self.word_ids(piece)
        if body[-1:] in self.MARKS and body[:-1].isalpha():
            return self.word_ids(piece[:-1]) + self.words[piece[-1]]
        return b"".join(map(self.words.__getitem__, self.pretokens(piece)))

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text with a special string, by the library as it is."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of one text."""
        return self.encode_column(pa.array([text]))[0].astype("<u4").tobytes()

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each of ``texts`` (no nulls), as ``Tokenizer.encode`` gives them without added special tokens."""
        texts = texts.cast(pa.large_string())
        special = np.zeros(len(texts), bool)
        for s in self.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8, int(ends[-1] - ends[0]), int(ends[0]))
        ends = ends - ends[0]
        if not len(data):
            return [np.zeros(0, np.uint32)] * len(texts)
        filled = ends[:-1] < ends[1:]
        starts = piece_starts(data, ends[:-1][filled])
        cuts = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        found = pa.LargeStringArray.from_buffers(len(starts), cuts, pa.py_buffer(data)).dictionary_encode()
        ids = list(map(self.pieces.__getitem__, found.dictionary.to_pylist()))
        sizes = np.array([len(i) >> 2 for i in ids], np.int64)
        places = found.indices.to_numpy()
        counts = sizes[places]
        gathered = np.frombuffer(b"".join(ids), "<u4")[int_ranges((np.cumsum(sizes) - sizes)[places], counts)]
        upto = np.append(0, np.cumsum(counts))[np.searchsorted(starts, ends)]
        out = [gathered[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]
        for k in np.flatnonzero(special):
            out[k] = self.whole(texts[int(k)].as_py())
        return out


@lru_cache(maxsize=2)
def _load(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def library(path: str) -> LibraryEncoder:
    """The encoder of a file, loaded once per worker."""
    return take_turn(_load(path))


def _write_blocks(path: str, end_id: int):
    def blocks(rows: Iterator[tuple]) -> Iterator[tuple]:
        shard = TaskContext.get().partitionId()
        number, first, docs, ends, parts, total = 0, 0, [], [], [], 0
        bits = bits_for(max(library(path).largest, end_id))

        def packed():
            return shard, number, first, total, bits, docs, ends, pack(np.concatenate(parts), bits)

        tail = np.array([end_id], np.uint32)
        for doc_id, ids in rows:
            docs.append(doc_id)
            parts += [ids, tail]
            total += len(ids) + 1
            ends.append(total)
            if total >= BLOCK_IDS:
                yield packed()
                number, first, docs, ends, parts, total = number + 1, first + total, [], [], [], 0
        if docs:
            yield packed()

    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("bits", pa.int32()),
                        ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("payload", pa.binary())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder = library(path)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for lo, hi in slices(pc.binary_length(texts).to_pylist(), SLICE):
                yield from zip(batch.column("doc_id").slice(lo, hi - lo).to_pylist(), encoder.encode_column(texts.slice(lo, hi - lo)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in blocks(encoded(batches)):
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    return run


def write_packed(docs: DataFrame, out: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the ids of each row's whole text and ``end_id`` to the folder ``out``, documents in ascending id order.

    ``path`` is the tokenizer file.  Null texts are empty: their ids are the end
    id alone.  Null ids come first; rows of one id are ordered by a hash of
    their text.  Other columns are not read; an empty table gives no blocks.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         text_hash(F.col(text_col)).alias("row"), F.monotonically_increasing_id().alias("place"))
    ordered = source.repartitionByRange("doc_id", "row", "place").sortWithinPartitions("doc_id", "row", "place")
    map_arrow(ordered.select("doc_id", "text"), _write_blocks(path, end_id), SCHEMA, words=True).write.parquet(out)
    return out


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a packed folder: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A shard's start is the sum over the shards before it; only one number per
    shard (one per writing task) meets in one place or is broadcast.
    """
    blocks = spark.read.schema(SCHEMA).parquet(path)
    shards = blocks.groupBy("shard").agg(F.max(F.col("first") + F.col("n_ids")).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    rows = (blocks.join(F.broadcast(starts), "shard")
            .select((F.col("shard_start") + F.col("first")).alias("start"), "bits", "doc_ids", "ends", "payload"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, bits, docs, ends, payload = (c[i].as_py() for c in batch.columns)
                bounds = [0, *ends]
                ids = unpack(payload, bits, 0, bounds[-1]).astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array([start + b for b in bounds[:-1]], pa.int64()),
                    pa.array([hi - lo for lo, hi in zip(bounds, ends)], pa.int64()),
                    pa.array([zlib.crc32(ids[lo:hi].tobytes()) for lo, hi in zip(bounds, ends)], pa.int64())], schema=schema)

    return map_arrow(rows, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def document_ids(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents of one id, read by random access from the blocks that hold it."""
    hits = spark.read.schema(SCHEMA).parquet(path).where(F.array_contains("doc_ids", doc_id))
    out = []
    for row in hits.orderBy("shard", "block").toLocalIterator():
        for k, d in enumerate(row.doc_ids):
            if d == doc_id:
                out.append(unpack(bytes(row.payload), row.bits, row.ends[k - 1] if k else 0, row.ends[k]).tolist())
    return out
