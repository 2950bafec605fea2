"""CRM rollups per (parent) merchant and per opportunity.

All are plain ``groupBy().agg`` with min / max / sum, which Spark combines
map-side, so a merchant that owns a third of all opportunities still sends at
most one partial row per task to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_contact(opps: DataFrame) -> DataFrame:
    """Earliest opportunity created date per parent merchant (keyed as ``sales_merchant_id``)."""
    return opps.groupBy(F.col("parent_merchant_id").alias("sales_merchant_id")).agg(
        F.min("opportunity_created_date").alias("first_opportunity_created_date")
    )


def special_dates(opps: DataFrame) -> DataFrame:
    """Latest expected end date and latest override activation date per parent merchant."""
    return (
        opps.filter(F.col("opportunity_expected_end_date").isNotNull()
                    | F.col("opportunity_override_activation_date").isNotNull())
        .groupBy(F.col("parent_merchant_id").alias("sales_merchant_id"))
        .agg(
            F.max("opportunity_expected_end_date").alias("backlog_end_date"),
            F.max("opportunity_override_activation_date").alias("adjusted_activation_date"),
        )
    )


def activation_override(act, override) -> Column:
    """Override date when present, else the funnel activation date."""
    a = F.col(act) if isinstance(act, str) else act
    o = F.col(override) if isinstance(override, str) else override
    return F.coalesce(o, a)


def opportunity_totals(opps: DataFrame) -> DataFrame:
    """Amount per opportunity id."""
    return opps.groupBy("opportunity").agg(F.sum("opportunity_amount").alias("opportunity_amount"))
