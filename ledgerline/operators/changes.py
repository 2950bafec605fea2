"""Change between two stored states of a table: rows added, gone and restated, and by how much.

Both states are stacked and grouped by key, so one shuffle compares them, and NULL
keys meet each other as any value does.  Attributes are text, which Spark sorts
to aggregate; the rows are dealt by key into partitions of a bounded number of rows
first, so no task sorts as much as a file scan of its own holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import partitions_for
from .dims import TASK_ROWS

ADDED, GONE, RESTATED = "added", "gone", "restated"


def changes(before: DataFrame, after: DataFrame, keys: list[str], measures: list[str], attributes: list[str] = ()) -> DataFrame:
    """One row per key that differs: keys, ``status``, ``changed``, and each measure before, after and its change.

    A key is ``added`` or ``gone`` when one state lacks it.  It is ``restated``
    when a measure or an attribute differs; ``changed`` names those, joined by
    commas, in the order given (empty otherwise).  Several rows of a key in one
    state count with their sum, and with their greatest attributes.  A NULL
    differs from every value but NULL; in ``*_change`` it counts as zero.
    """
    def side(df: DataFrame, is_after: bool) -> DataFrame:
        looks = [F.struct(*attributes).alias("_attributes")] if attributes else []
        return df.select(*keys, *measures, *looks, F.lit(is_after).alias("_after"))

    both = side(before, False).unionByName(side(after, True))
    both = both.repartition(partitions_for(both.sparkSession, both.count(), TASK_ROWS), *keys)
    now = F.col("_after")
    sums = [F.sum(F.when(cond, F.col(m))).alias(f"{m}_{name}") for m in measures for name, cond in (("before", ~now), ("after", now))]
    looks = [F.max(F.when(cond, F.col("_attributes"))).alias(f"_{name}") for name, cond in (("before", ~now), ("after", now))] if attributes else []
    grouped = both.groupBy(*keys).agg(F.max(F.when(~now, 1)).alias("_was"), F.max(F.when(now, 1)).alias("_is"), *sums, *looks)
    differs = {m: ~F.col(f"{m}_before").eqNullSafe(F.col(f"{m}_after")) for m in measures}
    differs |= {a: ~F.col(f"_before.{a}").eqNullSafe(F.col(f"_after.{a}")) for a in attributes}
    names = F.concat_ws(",", *[F.when(d, F.lit(n)) for n, d in differs.items()])
    status = F.when(F.col("_was").isNull(), ADDED).when(F.col("_is").isNull(), GONE).when(names != "", RESTATED)
    zero = {m: F.lit(0).cast(grouped.schema[f"{m}_after"].dataType) for m in measures}
    change = [(F.coalesce(F.col(f"{m}_after"), zero[m]) - F.coalesce(F.col(f"{m}_before"), zero[m])).alias(f"{m}_change") for m in measures]
    return grouped.select(
        *keys, status.alias("status"), F.when(status == RESTATED, names).otherwise("").alias("changed"),
        *[c for m, d in zip(measures, change) for c in (f"{m}_before", f"{m}_after", d)]).filter(F.col("status").isNotNull())
