"""Staged report tables derived from the driver's TPC-H-style parquet tables.

The reports read a CRM table, a merchant dimension, daily payment and
margin facts and a few small uploaded lists.  The test data ships none of
them, so this module derives each one from ``lineitem``, ``orders``,
``customer``, ``supplier`` and ``nation`` with plain DataFrame expressions
(mapping in FIXTURES.md).  The DuckDB oracle stages the same tables with the
same expressions, so both engines see identical inputs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the test fixture.
# ---------------------------------------------------------------------------
# Industry list, index 0..23 (index 24 -> NULL); "Unlisted" reaches the default rule.
INDUSTRIES = (
    "Ticketing & Events", "Travel & Hosp", "Financial", "Healthcare", "Professional Services",
    "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content",
    "B2C (Software)", "B2B (Software)", "Real Estate", "On-Demand Services", "Fashion",
    "Food & Bev", "Manufacturing", "Other Retail", "Government", "EDU", "Non-Profit",
    "Utilities", "Other Public Sector", "Unlisted",
)
# Opportunity stage by o_orderkey % 9 (index 8 -> NULL) and its probability.
STAGES = (
    "Discovering Needs", "Validating Fit", "Proposing Solution", "Negotiating",
    "Onboarding", "Live", "Lost", "Duplicate",
)
STAGE_PROBABILITIES = (10, 25, 50, 75, 90, 100, 0, 0)
# Opportunity type by o_orderkey % 3 (index 2 -> NULL).
OPPORTUNITY_TYPES = ("Existing Customer", "New Business")
# Country table keyed by nation key: (nation_key, country_code, sfdc_country_name, sales_region).
COUNTRIES = (
    (0, "US", "United States", "US/CA"),
    (1, "CA", "Canada", "US/CA"),
    (2, "GB", "United Kingdom", "UK"),
    (3, "IE", "Ireland", "IE"),
    (4, "FR", "France", "Southern EU"),
    (5, "ES", "Spain", "Southern EU"),
    (6, "IT", "Italy", "SouthernEU"),
    (7, "DE", "Germany", "Northern EU"),
    (8, "AT", "AT", "NorthernEU"),
    (9, "CH", "Switzerland", "Northern EU"),
    (10, "BE", "Belgium", "Northern EU"),
    (11, "NL", "Netherlands", "Northern EU"),
    (12, "LU", "LU", "NorthernEU"),
    (13, "NO", "NO", "NorthernEU"),
    (14, "FI", "Finland", "Northern EU"),
    (15, "SE", "Sweden", "Northern EU"),
    (16, "DK", "Denmark", "Northern EU"),
    (17, "IS", "Iceland", "Northern EU"),
    (18, "AU", "Australia", "AU/NZ"),
    (19, "NZ", "New Zealand", "AU"),
    (20, "SG", "Singapore", "SG/HK"),
    (21, "HK", "Hong Kong", "SG"),
    (22, "MX", "CA", "New Markets"),
    (23, "BR", "Brazil", "New Markets"),
    (24, "PL", "US", "Unmapped"),
)
ACTIVATION_BASE = dt.date(1996, 1, 1)
END_DATE_BASE = dt.date(2000, 1, 2)
OVERRIDE_BASE = dt.date(1999, 3, 1)
UPSELL_SHARE_STEP = "0.0625"
# customers of every LATE_EVERY-th key went live, and made their deals, in the quarter before the report date
LATE_EVERY = 29
LATE_BASE = dt.date(1999, 10, 1)
# customers of every RECENT_EVERY-th key made their deals after the report date, before the pipeline report is run
RECENT_EVERY = 31
RECENT_BASE = dt.date(2000, 1, 2)
# every REPEATED_EVERY-th deal stands twice in the CRM table
REPEATED_EVERY = 40
# deals of every LARGE_EVERY-th key are a thousand times as large
LARGE_EVERY = 101
# dates of the uploaded role tables kept as history
ROLE_DATES = (dt.date(1995, 1, 1), dt.date(1996, 1, 7), dt.date(1996, 11, 3), dt.date(1997, 6, 1), dt.date(1998, 2, 1),
              dt.date(1998, 9, 6), dt.date(1999, 7, 4), dt.date(1999, 12, 26))
CURVE_DAYS = 366
CURVE_WEIGHT = float(CURVE_DAYS * (CURVE_DAYS + 1) // 2)  # sum of CURVE_DAYS - day over the days
# ---------------------------------------------------------------------------

RAW_TABLES = ("nation", "customer", "supplier", "orders", "lineitem")


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver-generated input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values, idx: Column) -> Column:
    """values[idx] with NULL beyond the end."""
    return F.get(F.array(*[F.lit(v) for v in values]), idx.cast("int"))


def _add_days(d: Column | dt.date, n: Column) -> Column:
    base = F.lit(d) if isinstance(d, dt.date) else d
    return F.date_add(base, n.cast("int"))


def _npv_cents(price: Column, discount: Column) -> Column:
    return F.round(price * (F.lit(1) - discount) * F.lit(100)).cast("bigint")


def _cents(x: Column) -> Column:
    return F.round(x * F.lit(100)).cast("bigint")


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country mapping: one row per nation of the given ``nation`` table."""
    mapping = spark.createDataFrame(
        list(COUNTRIES), "nation_key int, country_code string, sfdc_country_name string, sales_region string"
    )
    nation = read_raw(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation_key"))
    return nation.join(mapping, "nation_key")


def supplier_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of suppliers (owners are assigned by key modulo this)."""
    return read_raw(spark, sf_dir, "supplier").count()


def _with_merchant(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of order lines (``_orderkey`` first) with the customer of their order as merchant, second column.

    Lines come as the few integers and the date that are kept, so that is all a shuffle of them by order moves.
    """
    od = read_raw(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("sales_merchant_id"))
    _, date, *measures = lines.columns
    return lines.join(od, lines["_orderkey"] == od["o_orderkey"]).select(date, "sales_merchant_id", *measures)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily payment facts: one row per order line."""
    lines = read_raw(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("_orderkey"),
        F.col("l_shipdate").cast("date").alias("capture_date"),
        _npv_cents(F.col("l_extendedprice"), F.col("l_discount")).alias("npv_usd_fixed"),
    )
    return _with_merchant(lines, spark, sf_dir)


def margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily margin facts (cents)."""
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    lines = read_raw(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("_orderkey"),
        F.col("l_shipdate").cast("date").alias("capture_date"),
        _npv_cents(price, disc).alias("npv"),
        _cents(price).alias("revenue_total"),
        F.round(price * disc * F.lit(100)).cast("bigint").alias("costs_total"),
        F.round(price * F.col("l_tax") * F.lit(100)).cast("bigint").alias("revenue_fx"),
        F.when(F.col("l_returnflag") == "R", F.round(F.col("l_quantity") * F.lit(100)).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint")).alias("revenue_disputes"),
        F.when(F.col("l_linestatus") == "O", F.round(F.col("l_quantity") * F.lit(10)).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint")).alias("revenue_other_api"),
    )
    return _with_merchant(lines, spark, sf_dir)


def capture_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture date of every order line, for counts per day (one column is read)."""
    return read_raw(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("capture_date"))


def merchants(spark: SparkSession, sf_dir: str, nsup: int | None = None) -> DataFrame:
    """Merchant dimension: one row per customer."""
    nsup = nsup if nsup is not None else supplier_count(spark, sf_dir)
    cust = read_raw(spark, sf_dir, "customer")
    cc = country_codes(spark, sf_dir).select("nation_key", "country_code")
    sup = read_raw(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    first_order = (
        read_raw(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("min_orderkey"))
    )
    key = F.col("c_custkey")
    return (
        cust.join(cc, cust.c_nationkey == cc.nation_key, "left")
        .join(sup, sup.s_suppkey == key % F.lit(nsup), "left")
        .join(first_order, first_order.o_custkey == key, "left")
        .select(
            key.alias("merchant_id"),
            F.col("c_name").alias("sales__name"),
            _pick(INDUSTRIES, key % 25).alias("sales__industry"),
            F.col("country_code").alias("sales__merchant_country"),
            F.col("s_name").alias("sales__owner"),
            (F.col("c_acctbal") > 0).alias("sales__is_sold"),
            F.when(key % 11 == 0, F.lit(None).cast("date"))
            .when(key % LATE_EVERY == 0, _add_days(LATE_BASE, key % 90))
            .otherwise(_add_days(ACTIVATION_BASE, (key * 7919) % 1461)).alias("activation_date"),
            F.when(key % 13 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("min_orderkey").cast("string")).alias("sfdc_opportunity"),
        )
    )


def opportunities(spark: SparkSession, sf_dir: str, nsup: int | None = None) -> DataFrame:
    """CRM table: one row per order, some of them twice."""
    nsup = nsup if nsup is not None else supplier_count(spark, sf_dir)
    od = read_raw(spark, sf_dir, "orders").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("o_orderkey") % REPEATED_EVERY == 0, 2).otherwise(1))))
    cust = read_raw(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cc = country_codes(spark, sf_dir).select("nation_key", "sfdc_country_name")
    sup = read_raw(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    k = F.col("o_orderkey")
    created = (F.when(F.col("o_custkey") % LATE_EVERY == 0, _add_days(LATE_BASE, k % 80))
               .when(F.col("o_custkey") % RECENT_EVERY == 0, _add_days(RECENT_BASE, k % 45))
               .otherwise(F.col("o_orderdate").cast("date")))
    stage_idx = k % 9
    amount = (F.round(F.col("o_totalprice"), 2).cast("decimal(14,2)")
              * F.when(k % LARGE_EVERY == 0, 1000).otherwise(1).cast("decimal(4,0)")).cast("decimal(18,2)")
    return (
        od.join(cust, od.o_custkey == cust.c_custkey)
        .join(cc, cust.c_nationkey == cc.nation_key, "left")
        .join(sup, sup.s_suppkey == k % F.lit(nsup), "left")
        .select(
            k.cast("string").alias("opportunity"),
            F.concat(F.lit("Opp#"), k.cast("string")).alias("opportunity_name"),
            F.col("s_name").alias("opportunity_owner"),
            _pick(STAGES, stage_idx).alias("opportunity_stage"),
            F.when(k % 97 == 0, F.lit(None).cast("int"))
            .otherwise(_pick(STAGE_PROBABILITIES, stage_idx)).cast("int").alias("opportunity_probability"),
            F.when(k % 53 == 0, F.lit(None).cast("decimal(18,2)")).otherwise(amount).alias("opportunity_amount"),
            _pick(OPPORTUNITY_TYPES, k % 3).alias("opportunity_type"),
            _pick(INDUSTRIES, k % 25).alias("opportunity_industry"),
            F.col("sfdc_country_name").alias("opportunity_merchant_country"),
            created.alias("opportunity_created_date"),
            _add_days(created, k % 60).alias("opportunity_close_date"),
            _add_days(created, F.lit(30) + k % 120).alias("opportunity_expected_go_live_date"),
            F.when(k % 4 == 0, F.col("o_custkey")).alias("merchant_id"),
            F.col("o_custkey").alias("parent_merchant_id"),
            F.when(k % 200 == 0, _add_days(END_DATE_BASE, k % 365)).alias("opportunity_expected_end_date"),
            F.when(k % 250 == 0, _add_days(OVERRIDE_BASE, k % 300)).alias("opportunity_override_activation_date"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Commit"))
            .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Best Case"))
            .otherwise(F.lit("Pipeline")).alias("opportunity_forecast_category"),
            F.when(k % 53 == 0, F.lit(None).cast("decimal(18,2)")).otherwise(amount).alias("opportunity_deal_amount"),
        )
    )


def team_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner -> role and team; one supplier in ten is left out on purpose."""
    k = F.col("s_suppkey")
    return (
        read_raw(spark, sf_dir, "supplier")
        .filter(k % 10 != 9)
        .select(
            F.col("s_name").alias("sales_owner"),
            F.when(k % 5 == 0, F.lit("NBA")).when(k % 5 == 1, F.lit("AM")).otherwise(F.lit("AE")).alias("role"),
            F.when(k % 2 == 0, F.lit("Hub")).otherwise(F.lit("In-country")).alias("team"),
        )
    )


def team_role_on(spark: SparkSession, sf_dir: str, date: dt.date) -> DataFrame:
    """The role table as it was uploaded on one of ``ROLE_DATES``: owners join, leave, and change role and team between them."""
    n = ROLE_DATES.index(date)
    k = F.col("s_suppkey")
    step = k + F.floor((k % 4 + n) / F.lit(3))  # each owner changes at its own dates
    return (
        read_raw(spark, sf_dir, "supplier")
        .filter((k % 10 != 9) & ((k % 17 != 5) | (k % 5 < n)) & ((k % 13 != 7) | (F.lit(n) % 3 != 2)))
        .select(
            F.col("s_name").alias("sales_owner"),
            F.when(step % 5 == 0, F.lit("NBA")).when(step % 5 == 1, F.lit("AM")).otherwise(F.lit("AE")).alias("role"),
            F.when((k + (F.lit(n) / 4).cast("int")) % 2 == 0, F.lit("Hub")).otherwise(F.lit("In-country")).alias("team"),
        )
    )


def role_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordered list of role edits over the given suppliers: removals, additions, and both for some owners."""
    k = F.col("s_suppkey")
    sup = read_raw(spark, sf_dir, "supplier")
    parts = [(k % 6 == 0, 1, "remove", None, None), (k % 12 == 0, 2, "add", "NBA", "Hub"), (k % 9 == 0, 3, "add", "AM", "In-country"),
             (k % 18 == 0, 4, "add", "AE", "Hub"), (k % 10 == 9, 5, "add", "AE", "In-country"), (k % 14 == 9, 6, "remove", None, None)]
    out = None
    for which, step, action, role, team in parts:
        part = sup.filter(which).select((k * 10 + step).cast("bigint").alias("seq"), F.lit(action).alias("action"), F.col("s_name").alias("sales_owner"),
                                        F.lit(role).cast("string").alias("role"), F.lit(team).cast("string").alias("team"))
        out = part if out is None else out.unionByName(part)
    return out


def upsells(merchants_df: DataFrame) -> DataFrame:
    """Upsell list derived from the merchant dimension."""
    m = F.col("merchant_id")
    return merchants_df.filter((m % 10 == 3) & F.col("activation_date").isNotNull()).select(
        m.alias("sales_merchant_id"),
        F.date_add(F.col("activation_date"), 120).alias("effective_activation_date"),
        ((m % 7 + 1) * F.lit(UPSELL_SHARE_STEP).cast("decimal(5,4)")).cast("decimal(5,4)").alias("pct_share_of_npv"),
        F.when(m % 20 == 3, F.lit(1)).otherwise(F.lit(0)).alias("include"),
    )


def overlapping_upsells(upsells_df: DataFrame) -> DataFrame:
    """The upsell list with a second and a third included upsell for some merchants; their shares may pass one together."""
    m, begin = F.col("sales_merchant_id"), F.col("effective_activation_date")
    further = [(m % 3 != 0, 60, "0.5000"), (m % 9 == 1, 200, "0.6250"), (m % 7 == 5, 366, "0.2500")]
    out = upsells_df
    for which, days, share in further:
        out = out.unionByName(upsells_df.filter((F.col("include") == 1) & which).select(
            m, F.date_add(begin, days).alias("effective_activation_date"), F.lit(share).cast("decimal(5,4)").alias("pct_share_of_npv"), "include"))
    return out


def backlog_curve(spark: SparkSession) -> DataFrame:
    """Falling first-year curve: days 0..365, cumulative share includes its own day."""
    d = F.col("id").cast("int")
    return spark.range(CURVE_DAYS).select(
        d.alias("days_since_activation"),
        ((F.lit(CURVE_DAYS) - d).cast("double") / F.lit(CURVE_WEIGHT)).alias("first_year_sold_pct"),
        ((d + 1) * CURVE_DAYS - F.shiftright(d * (d + 1), 1)).cast("double").alias("_sum"),
    ).select("days_since_activation", "first_year_sold_pct",
             (F.col("_sum") / F.lit(CURVE_WEIGHT)).alias("first_year_sold_cumulative_pct")
    )


def pipeline_curve(spark: SparkSession) -> DataFrame:
    """Falling pipeline curve: days 0..364."""
    return spark.range(CURVE_DAYS - 1).select(
        F.col("id").cast("int").alias("day_count"),
        ((F.lit(CURVE_DAYS) - F.col("id")).cast("double") / F.lit(CURVE_WEIGHT)).alias("first_year_sold_pct"),
    )
