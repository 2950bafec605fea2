"""Dated snapshot tables (replaces drop / rename of "this week" and "last week").

A snapshot table is a Parquet folder partitioned by ``snapshot_date``.
Writing replaces one date's folder, also when the new rows are none, and never
that of an earlier date than the latest: what was reported stays as it was.

A date is published in three steps: its rows are written beside the table
(folders that begin with ``_`` and name no partition are not read), the written files are checked,
and the folder is put in place by renaming.  A run that fails before the last
step leaves the old rows untouched; one that fails between the two renames of
a replacement is completed by the next reader or writer (``recover``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_COL = "snapshot_date"
WRITING, REPLACED = "_writing", "_replaced"


class SnapshotOrderError(ValueError):
    pass


class SnapshotCheckError(ValueError):
    pass


class _Folder:
    """The folder of a table on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._make = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._make(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        """Names of the folders in it."""
        root = self._make(self.path)
        if not self.fs.exists(root):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(root) if s.isDirectory())

    def has(self, name: str) -> bool:
        return self.fs.exists(self._make(f"{self.path}/{name}"))

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self._make(f"{self.path}/{old}"), self._make(f"{self.path}/{new}")):
            raise OSError(f"{self.path}: {old} could not be renamed to {new}")

    def delete(self, name: str) -> None:
        self.fs.delete(self._make(f"{self.path}/{name}"), True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish replacements that were broken off: the old rows of a date that is not in place come back."""
    folder = _Folder(spark, path)
    for name in folder.names():
        if name.startswith(f"{REPLACED}."):
            date = "=".join(name.split(".")[1:3])
            if folder.has(date):
                folder.delete(name)
            else:
                folder.rename(name, date)


def snapshot_dates(spark: SparkSession, path: str, col: str = SNAPSHOT_COL) -> list[dt.date]:
    """Dates stored in a snapshot table, oldest first (folder names only; empty snapshots count)."""
    recover(spark, path)
    names = _Folder(spark, path).names()
    return sorted(dt.date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith(f"{col}="))


def publish(spark: SparkSession, path: str, as_of: dt.date, write: Callable[[str], None], check: Callable[[str], None],
            col: str = SNAPSHOT_COL) -> None:
    """Put the ``as_of`` folder of a table in place: ``write(folder)`` beside it, ``check(folder)``, then rename.

    An earlier date than the latest is refused.  Whatever raises before the
    renaming leaves the table as it was.  One writer per table and date.
    """
    stored = snapshot_dates(spark, path, col)
    if stored and as_of < stored[-1]:
        raise SnapshotOrderError(f"{path} holds a snapshot of {stored[-1]}; that of {as_of} is not rewritten")
    folder, date, tag = _Folder(spark, path), f"{col}={as_of.isoformat()}", f"{col}.{as_of.isoformat()}.{uuid.uuid4().hex[:12]}"
    fresh, old = f"{WRITING}.{tag}", f"{REPLACED}.{tag}"
    for left in folder.names():  # of a run of this date that failed
        if left.startswith(f"{WRITING}.{col}.{as_of.isoformat()}."):
            folder.delete(left)
    write(f"{folder.path}/{fresh}")
    check(f"{folder.path}/{fresh}")
    if folder.has(date):
        folder.rename(date, old)
    folder.rename(fresh, date)
    if folder.has(old):
        folder.delete(old)


def write_snapshot(df: DataFrame, path: str, as_of: dt.date, col: str = SNAPSHOT_COL,
                   check: Callable[[DataFrame], None] | None = None) -> None:
    """Publish ``df`` as the ``as_of`` snapshot; other dates are untouched.

    The written files must have the columns of ``df`` and be readable to the
    last row; ``check`` may raise for what the written rows must also fulfil.
    """
    spark = df.sparkSession

    def checked(folder: str) -> None:
        back = spark.read.parquet(folder)
        if [(f.name, f.dataType) for f in back.schema] != [(f.name, f.dataType) for f in df.schema]:
            raise SnapshotCheckError(f"{folder}: written as {back.schema.simpleString()}, not {df.schema.simpleString()}")
        back.count()
        if check is not None:
            check(back)

    publish(spark, path, as_of, lambda folder: df.write.parquet(folder), checked, col)


def read_snapshot(spark: SparkSession, path: str, as_of: dt.date, weeks_back: int = 0,
                  col: str = SNAPSHOT_COL) -> DataFrame:
    """The snapshot dated ``as_of - 7 * weeks_back`` (partition-pruned read)."""
    recover(spark, path)
    target = as_of - dt.timedelta(days=7 * weeks_back)
    return spark.read.parquet(path).filter(F.col(col) == F.lit(target))


def read_all_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Every dated snapshot of a table."""
    recover(spark, path)
    return spark.read.parquet(path)
