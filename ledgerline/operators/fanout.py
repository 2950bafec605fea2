"""Sums that stay right when a join repeats rows.

The CRM reports sum opportunity amounts after joins that can repeat an
opportunity.  Instead of hashing ids into the summed value, the amount is
first reduced to one value per (group, opportunity) and then summed: two
ordinary aggregations, both combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_once(df: DataFrame, group_cols: list[str], key: str, value: str, out: str | None = None) -> DataFrame:
    """Sum of ``value`` counting each ``key`` once per group; NULL counts as 0.

    Raises if a key carries two different amounts.
    """
    out = out or f"{value}_once"
    per_key = df.groupBy(*group_cols, key).agg(amount_once_in_group(value).alias("_v"))
    return per_key.groupBy(*group_cols).agg(F.coalesce(F.sum("_v"), F.lit(0)).alias(out))


def amount_once_in_group(value: str):
    """Aggregate form for groups that already contain the key: its one amount, 0 if NULL; raises on two amounts."""
    wrong = F.raise_error(F.concat_ws(" ", F.lit(f"one key carries two amounts of {value}:"), F.min(value), F.max(value)))
    return F.when(F.min(value) < F.max(value), wrong).otherwise(F.coalesce(F.max(value), F.lit(0)))
