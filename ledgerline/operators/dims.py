"""Dimension joins with a checked key, and a broadcast only within a checked size.

A duplicate key would silently multiply fact rows in an inner join, so every
keyed dimension is checked for one at any size, by an aggregate over the whole
table.  The same job counts rows and bytes: within both bounds the table is
marked for broadcast; beyond them it is returned unhinted and Spark plans the
join from its own sizes.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 32 << 20
TASK_ROWS = 1 << 18  # rows that one task holds in aggregates and sorts


class DuplicateKeyError(ValueError):
    pass


# Check results per (plan, input files, key).  Rewritten data gets new
# part-file names, so a memoised result never outlives the files it describes.
_CHECKS: dict[tuple, tuple[int, int, int]] = {}
_LOCK = threading.Lock()


def table_size(df: DataFrame, key: str | None = None) -> tuple[int, int, int]:
    """(rows, most rows of one key that is not NULL, bytes) of the whole table, memoised per input files."""
    memo = (df.semanticHash(), tuple(sorted(df.inputFiles())), key)
    with _LOCK:
        if memo in _CHECKS:
            return _CHECKS[memo]
    width = sum((F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if f.dataType.simpleString() == "string" else F.lit(16)
                 for f in df.schema.fields), F.lit(16))
    if key is None:
        counted = df.agg(F.count(F.lit(1)).alias("n"), F.lit(0).alias("most"), F.sum(width).alias("bytes"))
    else:
        by_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b"))
        counted = by_key.agg(F.sum("n").alias("n"), F.max(F.when(F.col("_key").isNotNull(), F.col("n"))).alias("most"),
                             F.sum("b").alias("bytes"))
    row = counted.first()
    out = (row["n"] or 0, row["most"] or 0, row["bytes"] or 0)
    with _LOCK:
        _CHECKS[memo] = out
    return out


def check_unique(df: DataFrame, key: str, name: str = "") -> None:
    """Fail when a key repeats, whatever the size of the table."""
    if table_size(df, key)[1] > 1:
        raise DuplicateKeyError(f"dimension {name or key}: key {key!r} has duplicates")


def small_dimension(df: DataFrame, key: str | None = None, max_rows: int = DEFAULT_MAX_ROWS, name: str = "") -> DataFrame:
    """Check that ``key`` is unique; mark ``df`` for broadcast within ``max_rows`` rows and ``BROADCAST_MAX_BYTES`` bytes."""
    if key is not None:
        check_unique(df, key, name)
    n, _, size = table_size(df, key)
    return F.broadcast(df) if n <= max_rows and size <= BROADCAST_MAX_BYTES else df


def merchant_level(df: DataFrame, merchants: DataFrame, name: str = "") -> DataFrame:
    """A table with one row per merchant, built from ``merchants`` by joins on checked keys.

    Checks the merchant ids; Spark chooses the join from the table's size.
    """
    check_unique(merchants.select("merchant_id"), "merchant_id", name or "merchants")
    return df
