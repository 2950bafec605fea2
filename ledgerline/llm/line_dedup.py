"""Repeated passages of lines: windows of three consecutive lines, found anywhere, kept once.

Lines are the parts of a text between newlines; blank lines do not count.
Every three consecutive lines of a document (spaces, tabs and other ASCII white
space at their ends aside) are a window.  Of equal windows the first one, by
document id, text hash and place, stays; the lines covered by later ones go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored, text_hash, text_lists, whole_rows

SPAN = 3
_ENDS = "\t\x0b\x0c\r "


def solid_lines(text: str) -> list[tuple[int, str]]:
    """(place, line without white space at its ends) of the lines that are not blank."""
    return [(i, s) for i, line in enumerate(text.split("\n")) if (s := line.strip(_ENDS))]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, texts in text_lists(batch.column("text"), 1 << 20):
            hashes, rows, places = [], [], []
            for r, text in enumerate(texts):
                lines = [s for _, s in solid_lines(text)]
                for k in range(len(lines) - SPAN + 1):
                    hashes.append(hashlib.blake2b("\n".join(lines[k:k + SPAN]).encode(), digest_size=16).digest())
                    rows.append(r)
                    places.append(k)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(hashes, pa.binary()), batch.column("doc_id").slice(lo, hi - lo).take(rows),
                batch.column("row").slice(lo, hi - lo).take(rows), pa.array(places, pa.int32())], names=["window", "doc_id", "row", "place"])


def drop_lines(text: str, windows: list[int]) -> tuple[str, int]:
    """``text`` without the solid lines that the windows cover, and their number."""
    solid = solid_lines(text)
    covered = {solid[k][0] for w in windows for k in range(w, w + SPAN)}
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in covered), len(covered)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, texts in text_lists(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            new, gone, total = [], [], []
            for text, null, windows in zip(texts, part.column("text").is_null().to_pylist(), part.column("windows").to_pylist()):
                total.append(len(solid_lines(text)))
                text, n = drop_lines(text, windows) if windows else (text, 0)
                new.append(None if null else text)
                gone.append(n)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("row"), pa.array(new, pa.string()), pa.array(total, pa.int64()),
                pa.array(gone, pa.int64())], names=["doc_id", "row", "text", "n_lines", "n_removed"])


def later_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row and the places of the windows that repeat an earlier one, one row per document row that has any."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    windows = map_arrow(source, _windows, "window binary, doc_id long, row long, place int")
    first = (windows.groupBy("window").agg(F.min(F.struct("doc_id", "row", "place")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("window", "first"))
    later = windows.join(stored(first, "line-windows"), "window").where(~F.struct("doc_id", "row", "place").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("place")).alias("windows"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, row (``text_hash`` of the given text), text, n_lines, n_removed.

    ``text`` lacks the lines covered by windows that occur earlier; blank lines
    and all others stay as they are.  Documents of fewer than three lines that
    are not blank, null (text stays null) and empty texts are left as they
    are.  A window that overlaps an earlier copy of itself counts as later.
    Null ids come first in the order.  Rows equal in id and text are one
    occurrence and are treated alike.  Other columns are not read.  An empty table gives an empty table.
    """
    later = later_windows(docs, id_col, text_col).select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "windows")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    joined = source.join(later, source["row"].eqNullSafe(later["r"]) & source["doc_id"].eqNullSafe(later["d"]), "left")
    return map_arrow(joined.select("doc_id", "row", "text", "windows"), _without, "doc_id long, row long, text string, n_lines long, n_removed long")


def rewrite(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs``, all rows and columns, with the texts of ``dedup_lines``; ``chars_col``, if there, is the new text's length where it changed."""
    later = later_windows(docs, id_col, text_col).select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "windows")
    whole = whole_rows(docs, id_col, text_col)
    joined = whole.join(later, whole["row"].eqNullSafe(later["r"]) & whole["doc_id"].eqNullSafe(later["d"]), "left")
    joined = joined.select("doc", "text", "windows")
    schema = joined.select("doc", "text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_lists(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                windows = part.column("windows").to_pylist()
                # null where nothing goes: the given text is taken then
                new = [drop_lines(t, w)[0] if w else None for t, w in zip(texts, windows)]
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(new, pa.string())], names=["doc", "text"])

    done = map_arrow(joined, run, schema)
    new = {text_col: F.coalesce("text", F.col("doc").getField(text_col))}
    if chars_col in docs.columns:
        old = F.col("doc").getField(chars_col)
        new[chars_col] = F.when(F.col("text").isNull(), old).otherwise(F.length("text").cast(docs.schema[chars_col].dataType))
    return done.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
