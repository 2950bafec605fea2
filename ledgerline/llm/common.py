"""Helpers shared by the operators of this subpackage: tables, scratch tables, bounded word caches."""

from __future__ import annotations

import itertools
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

SLICE_BYTES = 1 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application (they need no installed copy)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-"), "ledgerline_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, fn: Callable, schema, words: bool = False) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors.

    Workers outlive a stage: unless ``fn`` uses the word caches (``words``),
    those of an operator that ran before are emptied, and memory that Arrow
    holds in reserve is given back after each task.
    """
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not words:
            take_turn(None)
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(task, schema)


def whole_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as one struct column ``doc``, with doc_id, row (``text_hash``) and text beside it: no name can clash."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs[id_col].cast("long").alias("doc_id"),
                       text_hash(docs[text_col]).alias("row"), docs[text_col].alias("text"))


def keep_where(docs: DataFrame, decide: Callable[[], Callable[[list[str]], list[bool]]], text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that the function made by ``decide`` on each task keeps by their texts (null: empty); no shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = decide()
        for batch in batches:
            for lo, hi, texts in text_lists(batch.column(at)):
                yield batch.slice(lo, hi - lo).filter(pa.array(keep(texts), pa.bool_()))

    return map_arrow(docs, run, docs.schema, words=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table of ``sf_dir`` by Spark's reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read back.

    Cuts lineage: a lost executor costs at most the tasks of one step, and
    ``monotonically_increasing_id`` and the like keep the written values.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def held_tables() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that computes a table at once and holds it on the executors' disks until the block ends.

    For tables that are read again inside the block only, and that have the
    same rows whenever they are computed: lineage stays, so the part of a lost
    executor is computed again.  No files are written in the shared folder.
    Not for a table made from several held ones: its plan has all of theirs.
    """
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.DISK_ONLY))
        held[-1].count()
        return held[-1]

    try:
        yield hold
    finally:
        for df in reversed(held):
            df.unpersist()


def totals_before(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with the total of each of ``sums`` over all rows before it, in an order by range partitions.

    Only one total per partition meets in one place.  The partitioned rows are
    written, so that both readers see the same partitions.
    """
    ranged = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .select("*", F.spark_partition_id().alias("_part"), *[v.alias(f"_{n}") for n, v in sums.items()]), "ranged")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part").agg(*[F.sum(f"_{n}").alias(n) for n in sums])
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", *[F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"_{n}_start") for n in sums])
    return (ranged.select("*", *[F.coalesce(F.sum(f"_{n}").over(inside), F.lit(0)).alias(f"_{n}_in") for n in sums])
            .join(starts, "_part")
            .select(*df.columns, *[(F.col(f"_{n}_in") + F.col(f"_{n}_start")).alias(n) for n in sums]))


def text_hash(text: Column) -> Column:
    """Hash that tells apart rows sharing an id; null and empty text differ."""
    return F.xxhash64(text, text.isNull())


def slices(lengths: Iterable[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive items of about ``limit`` units; a larger item stands alone."""
    lo, total, i = 0, 0, -1
    for i, n in enumerate(lengths):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if i >= lo:
        yield lo, i + 1


class WordCache(dict):
    """Values by word, computed on first use; two generations bound the memory.

    When the young generation holds ``limit`` words it becomes the old one and
    the former old one goes, so words in use survive and nothing grows with
    the input.  Words over ``LONGEST`` characters are computed each time.
    Read with ``cache[word]``.
    """

    LONGEST = 64

    def __init__(self, compute: Callable, limit: int = 100_000):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, word):
        value = self.old.pop(word, None)
        if value is None:
            value = self.compute(word)
            if len(word) > self.LONGEST:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value

    def forget(self) -> None:
        """Drop all words."""
        self.clear()
        self.old = {}


_TURN: list = []


def take_turn(owner):
    """``owner``, after emptying the caches of what this worker ran before.

    Workers outlive a stage; only the operator at work holds words.
    """
    if _TURN and _TURN[0] is not None and _TURN[0] is not owner:
        for cache in vars(_TURN[0]).values():
            if isinstance(cache, WordCache):
                cache.forget()
    _TURN[:] = [owner]
    return owner


def text_lists(column: pa.Array, limit: int = 4 * SLICE_BYTES) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, end row, texts) for slices of a string column of about ``limit`` bytes; nulls are empty."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for lo, hi in slices(lengths, limit):
        yield lo, hi, column.slice(lo, hi - lo).fill_null("").to_pylist()


_CLEAN = re.compile(r"(?<=\S) (?=\S)")


def chunks(text: str) -> list[str]:
    """Pieces of ``text`` that byte-level pre-tokenization never joins.

    The text is cut at each single space, and before each single newline, that
    stands between characters that are not white space.  No pre-token reaches
    over such a cut, so pieces can be encoded one by one and remembered.  Every
    piece but the first stands for itself with a space before it, unless it
    begins with a newline: ``whole_chunk`` gives the text it stands for.
    """
    if " ".join(text.split()) != text.replace("\n", " "):  # other white space, or some side by side
        return _CLEAN.split(text)
    return text.replace("\n", " \n").split(" ")


def whole_chunk(piece: str) -> str:
    """The text that a piece after the first stands for."""
    return piece if piece[:1] == "\n" else " " + piece


def int_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``range(start, start + count)`` for each pair."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


def batched(rows: Iterator, n: int) -> Iterator[list]:
    """Lists of up to ``n`` items."""
    while part := list(itertools.islice(rows, n)):
        yield part
