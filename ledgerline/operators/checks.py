"""Data checks counted in the pass that writes a report, not by jobs of their own.

A report whose joins drop rows, or whose estimates may be missing, is given a
``Checks`` object.  It puts counters (observed metrics) on the rows as they
pass; after the report is written, ``table`` gives what they counted.  The
counters are exact unless Spark computes lost tasks of a stage again, which
count twice; the report itself is not concerned.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "subject string, check_name string, n bigint, amount decimal(18,4)"


class Checks:
    """Counters of one run, by subject."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def count(self, df: DataFrame, subject: str, **counters: Column) -> DataFrame:
        """``df`` with counters on its rows: ``rows`` and, for each of ``counters``, a number or an amount (a decimal).

        A subject is counted once per run; further frames of it pass as they are.
        """
        if subject in self._seen:
            return df
        self._seen[subject] = Observation(subject)
        return df.observe(self._seen[subject], F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counters.items()])

    def table(self, spark: SparkSession) -> DataFrame:
        """subject, check_name, n, amount: one row per counter.  Call it after the counted frames were written."""
        rows = []
        for subject, seen in self._seen.items():
            for name, value in seen.get.items():
                amount = isinstance(value, Decimal)
                rows.append((subject, name, None if amount else value, value if amount else None))
        return spark.createDataFrame(sorted(rows, key=lambda r: r[:2]), SCHEMA)


def matched(df: DataFrame, joins: list[tuple[str, DataFrame, str, str]], checks: Checks | None, subject: str) -> DataFrame:
    """Inner joins of ``df`` to dimensions (name, dimension, own key, its key), with the rows each of them drops counted.

    With ``checks`` the rows pass left joins, are counted (``without_<name>``
    per dimension, ``kept`` for all) and then filtered, in one pass; without, the
    joins are inner.
    """
    how = "left" if checks is not None else "inner"
    for _, dimension, own, key in joins:
        df = df.join(dimension, df[own] == dimension[key], how)
    if checks is None:
        return df
    found = [(name, F.col(key).isNotNull()) for name, _, _, key in joins]
    all_found = found[0][1]
    for _, hit in found[1:]:
        all_found = all_found & hit
    counters = {f"without_{name}": F.count(F.when(~hit, F.lit(1))) for name, hit in found}
    return checks.count(df, subject, **counters, kept=F.count(F.when(all_found, F.lit(1)))).filter(all_found)
