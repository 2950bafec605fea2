"""Role as of a date: dated role snapshots folded into intervals, and an as-of join by owner and date.

The role table is kept as dated snapshots (the whole table per date; see
``sources.snapshots``).  ``fold_snapshots`` turns them into rows with the days
they were valid from and to: consecutive snapshots that say the same of an
owner become one row, and a snapshot without the owner ends it.  A fact then
meets the intervals of its owner alone: an equi-join on the owner, with the
dates as a further condition, so the work per fact is the number of changes of
one owner, not the number of snapshots or days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dims import small_dimension

HISTORY_MAX_ROWS = 1_000_000
OPEN_END = dt.date(9999, 12, 31)
DATES_MAX_ROWS = 100_000


def fold_snapshots(history: DataFrame, key: str, columns: tuple[str, ...], date_col: str = "snapshot_date",
                   dates: DataFrame | None = None) -> DataFrame:
    """key, ``columns``, valid_from and valid_to (NULL: until further notice) from dated snapshots.

    ``dates`` (a column named as ``date_col``) adds snapshots that hold no row at all.
    Two rows of a key on one date raise.  A NULL value is a value of its own.
    """
    days = history.select(date_col) if dates is None else history.select(date_col).unionByName(dates.select(date_col))
    # one row per snapshot date: a calendar-bounded window
    order = Window.orderBy(date_col)
    calendar = small_dimension(
        days.distinct().select(F.col(date_col).alias("_day"), F.row_number().over(order).alias("_no"), F.lead(date_col).over(order).alias("_next")),
        "_day", DATES_MAX_ROWS, "snapshot dates")
    rows = history.select(key, *columns, F.col(date_col).alias("_day")).join(calendar, "_day")
    same = Window.partitionBy(key).orderBy("_day")
    unbroken = F.lag("_no").over(same) == F.col("_no") - 1
    for c in columns:
        unbroken = unbroken & F.lag(c).over(same).eqNullSafe(F.col(c))
    twice = F.when(F.lag("_no").over(same) == F.col("_no"), F.raise_error(F.concat(F.lit(f"{key} stands twice in one snapshot: "), F.col(key).cast("string"))))
    marked = rows.select("*", F.coalesce(twice.cast("int"), F.when(unbroken, 0).otherwise(1)).alias("_new"))
    runs = marked.select("*", F.sum("_new").over(same.rowsBetween(Window.unboundedPreceding, 0)).alias("_run"))
    last = F.max(F.coalesce(F.col("_next"), F.lit(OPEN_END)))
    return runs.groupBy(key, "_run", *columns).agg(F.min("_day").alias("valid_from"), last.alias("_end")).select(
        key, *columns, "valid_from", F.when(F.col("_end") < F.lit(OPEN_END), F.date_sub("_end", 1)).alias("valid_to"))


def valid_on(day) -> Column:
    """Whether ``day`` lies in the interval of the row."""
    d = F.col(day) if isinstance(day, str) else day
    return (d >= F.col("valid_from")) & (F.col("valid_to").isNull() | (d <= F.col("valid_to")))


def join_as_of(facts: DataFrame, intervals: DataFrame, fact_key: str, date_col: str, key: str, columns: tuple[str, ...]) -> DataFrame:
    """``facts`` with ``columns``, valid_from and valid_to of the interval of their key that holds their date; NULLs where there is none.

    The intervals are broadcast when they pass the size check; otherwise the
    join shuffles by key and AQE splits a key that holds many facts.
    """
    right = small_dimension(intervals.select(F.col(key).alias("_key"), *columns, "valid_from", "valid_to"), None, HISTORY_MAX_ROWS, "role intervals")
    return facts.join(right, (F.col(fact_key) == F.col("_key")) & valid_on(date_col), "left").drop("_key")


def role_as_of(facts: DataFrame, history: DataFrame, owner_col: str, date_col: str,
               key: str = "sales_owner", columns: tuple[str, ...] = ("role", "team"), dates: DataFrame | None = None) -> DataFrame:
    """Add ``columns`` of the owner's row in the latest snapshot on or before each fact's date, and the days that row was valid.

    Facts dated before the first snapshot, or whose owner is absent from the
    snapshot that counts, get NULLs.
    """
    return join_as_of(facts, fold_snapshots(history, key, columns, dates=dates), owner_col, date_col, key, columns)
