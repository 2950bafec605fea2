"""Enrichment joins and small report-shaping operators.

Segment attributes (region, country, sub-region, vertical, owner, role,
team, first contact) depend on the merchant only, so they are built once per
merchant in ``segment_dimension`` and joined to facts *after* those are
aggregated to weekly or monthly grain: the classifiers run once per merchant
and the wide string columns never ride through a shuffle of daily rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.segments import sub_region, vertical
from ..params import ReportParams
from .checks import Checks, matched
from .dims import merchant_level, small_dimension

COUNTRY_MAX_ROWS = 10_000
TEAM_MAX_ROWS = 100_000
OPEN_OR_SIGNED_STAGES = ("Negotiating", "Discovering Needs", "Validating Fit", "Proposing Solution", "Onboarding", "Live")


def countries_by(countries: DataFrame, on: str) -> DataFrame:
    """Country mapping keyed by 'name' (``sfdc_country_name``) or 'code' (``country_code``), size-checked."""
    key = {"name": "sfdc_country_name", "code": "country_code"}[on]
    return small_dimension(countries.select("country_code", "sfdc_country_name", "sales_region"), key,
                           COUNTRY_MAX_ROWS, f"countries by {on}")


def teams(team: DataFrame, exclude_roles=()) -> DataFrame:
    """Owner -> role / team, size- and key-checked; ``exclude_roles`` rows removed."""
    t = team.select("sales_owner", F.col("role").alias("sales_role"), F.col("team").alias("sales_location"))
    if exclude_roles:
        t = t.filter(~F.col("sales_role").isin(*exclude_roles))
    return small_dimension(t, "sales_owner", TEAM_MAX_ROWS, "team roles")


def enrich_country(df: DataFrame, countries: DataFrame, col: str, on: str = "code") -> DataFrame:
    """Inner join to the country mapping; unmatched rows drop."""
    cc = countries_by(countries, on)
    key = "sfdc_country_name" if on == "name" else "country_code"
    return df.join(cc, df[col] == cc[key])


def enrich_team(df: DataFrame, team: DataFrame, owner_col: str, exclude_roles=()) -> DataFrame:
    """Inner join to the team map; owners missing from the map drop."""
    t = teams(team, exclude_roles)
    return df.join(t, df[owner_col] == t["sales_owner"]).drop("sales_owner")


def enrich_merchant(df: DataFrame, merchants: DataFrame, col: str = "sales_merchant_id", how: str = "inner") -> DataFrame:
    """Join facts to the merchant dimension (Spark/AQE choose the strategy from sizes)."""
    m = merchants.withColumnRenamed("merchant_id", "_merchant_id")
    return df.join(m, df[col] == m["_merchant_id"], how).drop("_merchant_id")


def segment_dimension(merchants: DataFrame, countries: DataFrame, team: DataFrame,
                      first_contact: DataFrame | None = None, sub_variant: str = "A",
                      vertical_variant: str = "A", exclude_roles=(), checks: Checks | None = None) -> DataFrame:
    """One row per merchant that has a mapped country and owner, with its segment attributes.

    ``checks`` counts the merchants that have none.
    """
    m = merchants.select(
        F.col("merchant_id").alias("sales_merchant_id"), "sales__name", "sales__industry",
        "sales__merchant_country", "sales__owner", "activation_date")
    m = matched(m, [("country", countries_by(countries, "code"), "sales__merchant_country", "country_code"),
                    ("owner", teams(team, exclude_roles), "sales__owner", "sales_owner")], checks, "merchants").drop("sales_owner")
    if first_contact is not None:
        m = m.join(first_contact, "sales_merchant_id", "left")
    else:
        m = m.withColumn("first_opportunity_created_date", F.lit(None).cast("date"))
    seg = m.select(
        "sales_merchant_id",
        F.col("sales_region").alias("region"),
        F.col("sfdc_country_name").alias("country"),
        "country_code",
        sub_region("sales_role", "sales_region", "sfdc_country_name", "sales__industry", code="country_code",
                   location="sales_location", variant=sub_variant).alias("sub_region"),
        vertical("sales_region", "sfdc_country_name", "sales__industry", variant=vertical_variant).alias("vertical"),
        F.col("sales__owner").alias("owner"),
        "sales_role",
        "sales_location",
        F.col("sales__name").alias("merchant_name"),
        F.col("activation_date").alias("merchant_activation_date"),
        "first_opportunity_created_date",
    )
    return merchant_level(seg, merchants, "segment dimension")


def opportunity_merchant_key(opportunity) -> Column:
    """Deal id in the merchant id column: ``'OPTI__' || opportunity``."""
    c = F.col(opportunity) if isinstance(opportunity, str) else opportunity
    return F.concat(F.lit("OPTI__"), c)


def with_report_constants(df: DataFrame, **literals) -> DataFrame:
    """Add fixed columns that align report schemas (e.g. data_type, sales_channel='')."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in literals.items()])


def left_join_nullable(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on a key that is often NULL on the left.

    Rows with a NULL key can never match, yet a shuffled join would send all
    of them to the one partition NULL hashes to.  They bypass the join and
    are appended with NULL right-hand columns, so the join only sees rows
    that can match.
    """
    k = F.col(left_key)
    matched = left.filter(k.isNotNull()).join(right, left[left_key] == right[right_key], "left")
    nulls = left.filter(k.isNull()).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields])
    return matched.unionByName(nulls)


def eligible_pipeline(opps: DataFrame, merchants: DataFrame, p: ReportParams) -> DataFrame:
    """Open or signed deals not yet live at the cutoff, going live within [cutoff, horizon_end].

    The cutoff is ``p.pipeline_cutoff`` or, when unset, the report date.

    The activation test reads the nullable side of a left join, so it stays
    above the join.
    """
    m = merchants.select(F.col("merchant_id").alias("_mid"),
                         F.col("activation_date").alias("activation_date"))
    small = small_dimension(m, "_mid", name="merchants")
    # a broadcast join needs no way around NULL keys, and reads the deals once
    j = (left_join_nullable(opps, m, "merchant_id", "_mid") if small is m
         else opps.join(small, opps["merchant_id"] == small["_mid"], "left")).drop("_mid")
    act = F.col("activation_date")
    go_live = F.col("opportunity_expected_go_live_date")
    return j.filter(
        (act.isNull() | (act >= F.lit(p.cutoff)))
        & (go_live >= F.lit(p.cutoff))
        & (go_live <= F.lit(p.horizon_end))
        & F.col("opportunity_stage").isin(*OPEN_OR_SIGNED_STAGES)
    )


def allow_list(df: DataFrame, ids: DataFrame, col: str = "sales_merchant_id", ids_col: str | None = None) -> DataFrame:
    """Keep rows whose id is in the ``ids`` table (left-semi join; the list may be any size)."""
    ids_col = ids_col or col
    i = ids.select(F.col(ids_col).alias("_allowed")).distinct()
    return df.join(i, df[col] == i["_allowed"], "left_semi")


def recently_live(as_of: dt.date, days: int) -> Column:
    """Activation within the ``days`` before the report date."""
    act = F.col("activation_date")
    return (act >= F.lit(as_of - dt.timedelta(days=days))) & (act < F.lit(as_of))


def enrichment_audit(merchants: DataFrame, opportunities: DataFrame, countries: DataFrame, team: DataFrame) -> DataFrame:
    """Rows the reports' inner joins drop: one row per table (merchants, deals) with the rows that have
    no mapped country or owner.

    The source scripts warn that the team map must be kept up to date; this
    makes the loss visible before the reports run.  Left joins on the
    (size-checked) mappings, then one aggregate per table.
    """
    cc_code = countries_by(countries, "code").select(F.col("country_code").alias("_code"))
    cc_name = countries_by(countries, "name").select(F.col("sfdc_country_name").alias("_name"))
    owners = teams(team).select(F.col("sales_owner").alias("_owner"))

    def counts(df: DataFrame, country: str, owner: str, cc: DataFrame, cc_key: str, table: str) -> DataFrame:
        j = df.join(cc, df[country] == cc[cc_key], "left").join(owners, df[owner] == owners["_owner"], "left")
        no_c, no_o = F.col(cc_key).isNull(), F.col("_owner").isNull()
        return j.agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("rows"),
                     F.count(F.when(no_c, F.lit(1))).alias("without_country"),
                     F.count(F.when(no_o, F.lit(1))).alias("without_owner"),
                     F.count(F.when(~no_c & ~no_o, F.lit(1))).alias("kept"))

    return counts(merchants, "sales__merchant_country", "sales__owner", cc_code, "_code", "merchants").unionByName(
        counts(opportunities, "opportunity_merchant_country", "opportunity_owner", cc_name, "_name", "deals"))
