"""Report inputs from a user's own tables (Parquet facts and dimensions, CSV uploads).

``load_tables`` builds the inputs from the test folder; this module reads
them from where a team keeps them: the payment and margin facts, the
merchant dimension and the CRM table as Parquet, the hand-maintained lists
as CSV uploads.  Every table is read with its declared columns and types:
a missing column fails the read, and nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import MONTH_COL, Tables
from .uploads import read_upload

COLUMNS = {
    "payments": "capture_date date, sales_merchant_id bigint, npv_usd_fixed bigint",
    "margin": ("capture_date date, sales_merchant_id bigint, npv bigint, revenue_total bigint, costs_total bigint, "
               "revenue_fx bigint, revenue_disputes bigint, revenue_other_api bigint"),
    "merchants": ("merchant_id bigint, sales__name string, sales__industry string, sales__merchant_country string, "
                  "sales__owner string, sales__is_sold boolean, activation_date date, sfdc_opportunity string"),
    "opportunities": (
        "opportunity string, opportunity_name string, opportunity_owner string, opportunity_stage string, "
        "opportunity_probability int, opportunity_amount decimal(18,2), opportunity_type string, "
        "opportunity_industry string, opportunity_merchant_country string, opportunity_created_date date, "
        "opportunity_close_date date, opportunity_expected_go_live_date date, merchant_id bigint, "
        "parent_merchant_id bigint, opportunity_expected_end_date date, opportunity_override_activation_date date, "
        "opportunity_forecast_category string, opportunity_deal_amount decimal(18,2)"),
}
UPLOADS = ("country_codes", "team_role", "upsells", "backlog_curve", "pipeline_curve")


def _declared(df: DataFrame, spec: str) -> DataFrame:
    cols = [c.split(" ", 1) for c in spec.split(", ")]
    out = [F.col(name).cast(kind).alias(name) for name, kind in cols]
    if MONTH_COL in df.columns:  # keep a capture-month partition column for pruning
        out.append(F.col(MONTH_COL))
    return df.select(*out)


def tables_from_paths(spark: SparkSession, paths: dict[str, str]) -> Tables:
    """Report inputs from ``paths``: Parquet for ``payments``, ``margin``, ``merchants``, ``opportunities``;
    CSV uploads (header, declared schema) for ``country_codes``, ``team_role``, ``upsells``,
    ``backlog_curve``, ``pipeline_curve``.  ``payments`` may be omitted when ``margin`` holds the same
    rows (it is then read as margin's ``npv``)."""
    t = {name: _declared(spark.read.parquet(paths[name]), spec)
         for name, spec in COLUMNS.items() if name in paths}
    if "payments" not in t:
        t["payments"] = t["margin"].select(
            "capture_date", "sales_merchant_id", F.col("npv").alias("npv_usd_fixed"),
            *([MONTH_COL] if MONTH_COL in t["margin"].columns else []))
    for name in UPLOADS:
        t[name] = read_upload(spark, paths[name], name)
    return Tables(**t, source_dir=paths.get("source_dir", paths["margin"]), materialized=True)
