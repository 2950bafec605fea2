"""End-to-end report jobs (each returns a lazy DataFrame).

Inputs come as a ``Tables`` object (staged report tables) and a
``ReportParams``.  Every job follows the same shape: reduce the fact table
early on narrow keys (merchant, day / week / month), then join the
per-merchant segment dimension to the reduced rows, then project the report
columns.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions.measures import (
    MONEY,
    cents_to_dollars,
    days_since_close,
    live_or_not,
    money,
    weighted_amount,
)
from ..functions.segments import EXCLUDED_DEAL_STAGES, closed_flag, opportunity_status, sub_region, vertical
from ..operators.attribution import (
    UPSELL_MAX_ROWS,
    current_upsells,
    daily_range,
    daily_sums,
    merchant_attribution,
    processing_volume,
)
from ..operators.curves import backlog_spans, backlog_summary, cumulative_shares, curve_weeks, expand_backlog, expand_pipeline
from ..operators.checks import Checks, matched
from ..operators.dims import check_unique, merchant_level, small_dimension, table_size
from ..operators.enrich import (
    countries_by,
    eligible_pipeline,
    opportunity_merchant_key,
    segment_dimension,
    teams,
)
from ..operators.fanout import amount_once_in_group
from ..operators.rollups import first_contact, opportunity_totals, special_dates
from ..params import ReportParams
from ..sources.tables import Tables, capture_range, in_months, stage_table

SEGMENT_COLUMNS = (
    "data_type", "year", "quarter", "finance_week", "qtd", "this_week", "region", "country", "sales_channel",
    "sub_region", "vertical", "owner", "sales_role", "sales_location", "sales_merchant_id", "merchant_name",
    "sales_category", "sales_activation_date", "ninety_day_live", "first_year_sold", "npv_fixed_fx", "newNPV",
    "in_quarter_opportunity",
)


# --------------------------------------------------------------------------- CRM rollups, written once per dataset

def crm_special_dates(t: Tables) -> DataFrame:
    """Special dates (O-14) written once per dataset."""
    return t.derived("special_dates", lambda x: special_dates(x.opportunities))


def crm_first_contact(t: Tables) -> DataFrame:
    """First contact (O-13) written once per dataset."""
    return t.derived("first_contact", lambda x: first_contact(x.opportunities))


def crm_opportunity_totals(t: Tables) -> DataFrame:
    """Deal totals (O-26) written once per dataset."""
    return t.derived("opportunity_totals", lambda x: opportunity_totals(x.opportunities))


def report_segments(t: Tables, sub_variant: str, vertical_variant: str, with_first_contact: bool,
                    exclude_roles=(), checks: Checks | None = None) -> DataFrame:
    """Per-merchant segment attributes of one rule variant, written once per dataset and variant.

    Several reports join the same merchant-level dimension; it is built
    (merchants x countries x teams x first contact, classifiers applied) once
    and then read.
    """
    name = f"segments_{sub_variant}{vertical_variant}_{int(with_first_contact)}_{'-'.join(exclude_roles) or 'all'}"
    seg = t.derived(name, lambda x: segment_dimension(
        x.merchants, x.country_codes, x.team_role, crm_first_contact(x) if with_first_contact else None,
        sub_variant, vertical_variant, exclude_roles, checks))
    return merchant_level(seg, t.merchants, "segment dimension")


# --------------------------------------------------------------------------- daily fact sums, stored once per dataset

def daily_payments(t: Tables) -> DataFrame:
    """NPV cents per (merchant, capture day) over all captures, stored once per dataset.

    Every payments-based report starts from these sums (filtered to its own
    date range, whose months alone are read); a new run computes only the
    months whose payments changed.
    """
    return t.derived_by_month("daily_payments", lambda x, months: daily_sums(
        in_months(x.payments, months), [("npv_usd_fixed", "npv_cents")], by_merchant=False))


def daily_margin(t: Tables) -> DataFrame:
    """The six margin measures (cents) per (merchant, capture day), stored once per dataset."""
    return t.derived_by_month("daily_margin", lambda x, months: daily_sums(
        in_months(x.margin, months), [(c, c) for c, _ in MARGIN_MEASURES], by_merchant=False))


def prepare_shared(t: Tables, checks: Checks | None = None) -> None:
    """Write the tables several reports share - daily sums and CRM rollups - and run the
    dimension checks, with concurrent Spark jobs.  ``checks`` counts the merchants that a segment table drops.

    Optional: each table is otherwise written by the first report that needs it.
    """
    builders = (
        daily_payments, daily_margin, crm_special_dates, crm_first_contact, crm_opportunity_totals, curve_sums,
        # dimension checks (memoised) the reports run before broadcasting
        lambda x: check_unique(x.merchants.select("merchant_id"), "merchant_id", "merchants"),
        lambda x: countries_by(x.country_codes, "code"),
        lambda x: countries_by(x.country_codes, "name"),
        lambda x: teams(x.team_role),
        several_upsells,
        # merchant-level segment dimensions of the reports (variants with the default roles)
        lambda x: report_segments(x, "A", "A", True, checks=checks),
        lambda x: report_segments(x, "D", "A", True),
        lambda x: report_segments(x, "A", "A", False),
        lambda x: report_segments(x, "E", "E", False),
    )
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        list(pool.map(lambda build: build(t), builders))


def payments_daily(t: Tables, start=None, end=None, expanding: bool = False) -> DataFrame:
    """Daily NPV sums within [start, end), partitioned by merchant."""
    return daily_range(daily_payments(t), start, end, expanding=expanding)


# --------------------------------------------------------------------------- processing / backlog (J-3..J-5, J-9)

def report_processing_volume(t: Tables, p: ReportParams, start=None) -> DataFrame:
    """Both legs with override dates, captures in [start or history_start, as_of)."""
    start = start or p.history_start
    return processing_volume(t.payments, t.merchants, t.upsells, crm_special_dates(t), start, p.as_of,
                             daily=payments_daily(t, start, p.as_of), overlapping=several_upsells(t))


def several_upsells(t: Tables) -> bool:
    """Whether some merchant has more than one included upsell (the list is counted once)."""
    return table_size(current_upsells(t.upsells), "sales_merchant_id")[1] > 1


def _segment_select(df: DataFrame, data_type: str, qtd, this_week, npv) -> DataFrame:
    return df.select(
        F.lit(data_type).alias("data_type"),
        "year", "quarter", "finance_week",
        qtd.alias("qtd"), this_week.alias("this_week"),
        "region", "country", F.lit("").alias("sales_channel"), "sub_region", "vertical", "owner", "sales_role",
        "sales_location", F.col("sales_merchant_id").cast("string").alias("sales_merchant_id"), "merchant_name",
        "sales_category", "sales_activation_date", "ninety_day_live", "first_year_sold",
        npv.alias("npv_fixed_fx"), "newNPV", "in_quarter_opportunity",
    )


def backlog_capture_start(t: Tables, p: ReportParams, with_override: bool = True):
    """Earliest capture date that can feed the backlog estimate.

    A (merchant, category) row survives the backlog summary only if its age
    on the report date is a day of the curve, i.e. its reported activation
    lies in [as_of - last curve day, as_of - first curve day].  First-year
    revenue of such a row starts at the original activation (new business)
    or at the upsell date.  The minimum of those dates over the surviving
    rows bounds the captures needed; it is one small aggregate over
    merchant-level tables, and it lets the scan skip older capture months.
    """
    return t.memo(("backlog_capture_start", p.as_of, with_override),
                  lambda: _backlog_capture_start(t, p, with_override))


def _backlog_capture_start(t: Tables, p: ReportParams, with_override: bool):
    bounds = t.backlog_curve.agg(F.min("days_since_activation").alias("lo"),
                                 F.max("days_since_activation").alias("hi")).first()
    if bounds["lo"] is None:
        return p.as_of
    first_act = F.lit(p.as_of - dt.timedelta(days=int(bounds["hi"])))
    last_act = F.lit(p.as_of - dt.timedelta(days=int(bounds["lo"])))
    m = t.merchants.filter(F.col("sales__is_sold") == F.lit(True)).select(
        F.col("merchant_id").alias("sales_merchant_id"), F.col("activation_date").alias("orig"))
    if with_override:
        sd = crm_special_dates(t).select("sales_merchant_id", "adjusted_activation_date")
        m = m.join(sd, "sales_merchant_id", "left")
        reported = F.coalesce(F.col("adjusted_activation_date"), F.col("orig"))
    else:
        reported = F.col("orig")
    nb = m.filter(reported.between(first_act, last_act)).agg(F.min("orig").alias("d"))
    up = current_upsells(t.upsells).join(m.select("sales_merchant_id"), "sales_merchant_id").filter(
        F.col("effective_activation_date").between(first_act, last_act)).agg(
        F.min("effective_activation_date").alias("d"))
    found = [r["d"] for r in nb.unionByName(up).collect() if r["d"] is not None]
    return min(found) if found else p.as_of


def processing_report_from(pv: DataFrame, t: Tables, p: ReportParams) -> DataFrame:
    """J-3 body over a given processing volume."""
    d = F.col("capture_date")
    weekly = (
        pv.filter(d >= F.lit(p.report_start))
        .groupBy(
            "sales_merchant_id", "sales_category", "sales_activation_date", "orig_activation",
            *P.week_bucket_keys(d),
            P.ninety_day_live("sales_activation_date", d).alias("ninety_day_live"),
            P.first_year_sold("sales_activation_date", d).alias("first_year_sold"),
        )
        .agg(F.sum("first_year_sold_npv_usd_fx").alias("npv"))
        .select("*", *P.week_bucket_labels(p.as_of, p.this_week_lag_days),
                P.new_npv("orig_activation", p).alias("newNPV"))
    )
    seg = report_segments(t, "A", "A", True, p.exclude_roles)
    j = weekly.join(seg, "sales_merchant_id").withColumn(
        "in_quarter_opportunity",
        P.in_quarter("sales_activation_date", "first_opportunity_created_date", p.as_of, p.in_quarter_lag_days))
    return _segment_select(j, "weekly_processing", F.col("qtd"), F.col("this_week"),
                           money(F.coalesce(F.col("npv"), F.lit(0))))


def processing_report(t: Tables, p: ReportParams) -> DataFrame:
    """J-3: realised first-year NPV by segment and finance week.

    Only captures from ``report_start`` on reach the report, so the scan
    starts there: whole capture-month folders before it are skipped.
    """
    start = max(p.history_start, p.report_start)
    return processing_report_from(report_processing_volume(t, p, start), t, p)


def curve_sums(t: Tables) -> DataFrame:
    """Running sums of the backlog curve, written once per dataset."""
    return t.derived("backlog_curve_sums", lambda x: cumulative_shares(x.backlog_curve))


def _ending_summary(pv: DataFrame, t: Tables, p: ReportParams, checks: Checks | None = None) -> DataFrame:
    ends = crm_special_dates(t).select("sales_merchant_id", "backlog_end_date")
    summary = backlog_summary(pv, t.backlog_curve, p.as_of)
    if checks is not None:
        missing = F.col("first_year_est_npv").isNull()
        lost = F.coalesce(F.sum(F.when(missing, F.col("first_year_npv"))), F.lit(0)).cast(MONEY)
        summary = checks.count(summary, "backlog", no_estimate=F.count(F.when(missing, F.lit(1))), no_estimate_npv=lost)
    return summary.join(ends, "sales_merchant_id", "left")


def daily_backlog(pv: DataFrame, t: Tables, p: ReportParams) -> DataFrame:
    """Remaining first-year revenue per merchant, category and future day."""
    return expand_backlog(backlog_summary(pv, t.backlog_curve, p.as_of), t.backlog_curve)


def report_backlog_spans(pv: DataFrame, t: Tables, p: ReportParams, weeks: bool = False, first=None, checks: Checks | None = None) -> DataFrame:
    """Backlog per merchant, category and span of days, cut where an age flag, the new-NPV flag or the end date changes."""
    cuts = [F.date_add("sales_activation_date", 91), F.col("backlog_end_date"), F.lit(p.fy_end + dt.timedelta(days=1))]
    return backlog_spans(_ending_summary(pv, t, p, checks), curve_sums(t), cuts, weeks, first)


def span_flags(p: ReportParams) -> list:
    """The flags of a backlog span, from its first day."""
    act, day, end = "sales_activation_date", F.col("span_start"), F.col("backlog_end_date")
    return [P.ninety_day_live(act, day, end).alias("ninety_day_live"), P.first_year_sold(act, day, end).alias("first_year_sold"),
            P.new_npv("orig_activation", p, fcst=day).alias("newNPV")]


def backlog_report_from(pv: DataFrame, t: Tables, p: ReportParams, checks: Checks | None = None) -> DataFrame:
    """J-4 body over a given processing volume.  ``checks`` counts rows without an estimate.

    A merchant's weeks come from its estimate and running sums of the curve;
    no daily rows are made.
    """
    weekly = (
        report_backlog_spans(pv, t, p, weeks=True, first=p.report_start, checks=checks)
        .groupBy(
            # orig_activation is constant per merchant; keeping it in the key lets the
            # weekly sums reuse the partitioning of the backlog summary
            "sales_merchant_id", "sales_category", "sales_activation_date", "orig_activation",
            *P.week_bucket_keys(F.col("span_start")), *span_flags(p),
        )
        .agg(F.sum("backlog_amount").alias("amount"))
        .select("*", *P.week_bucket_labels())
    )
    seg = report_segments(t, "D", "A", True, p.exclude_roles)
    j = weekly.join(seg, "sales_merchant_id").withColumn(
        "in_quarter_opportunity",
        P.in_quarter("sales_activation_date", "first_opportunity_created_date", p.as_of, p.in_quarter_lag_days))
    return _segment_select(j, "weekly_backlog", F.lit(0), F.lit(0),
                           money(F.coalesce(F.col("amount"), F.lit(0))))


def backlog_processing_volume(t: Tables, p: ReportParams) -> DataFrame:
    """Processing volume restricted to the captures the backlog estimate can use."""
    return report_processing_volume(t, p, max(p.history_start, backlog_capture_start(t, p)))


def backlog_report(t: Tables, p: ReportParams) -> DataFrame:
    """J-4: remaining first-year revenue by segment and finance week."""
    return backlog_report_from(backlog_processing_volume(t, p), t, p)


def processing_and_backlog_report(t: Tables, p: ReportParams, materialize: str = "none", checks: Checks | None = None) -> DataFrame:
    """J-5: J-3 and J-4 in one table.

    The processing volume feeds both halves.  It is derived from the shared
    daily table (payments are not scanned again), about the same size as the
    volume itself, so by default each half derives it (``'none'``);
    ``'table'`` writes it once to the shared scratch folder and
    ``'checkpoint'`` uses ``DataFrame.checkpoint``, for inputs where the
    volume is expensive to recompute.  The two halves differ in
    ``data_type`` and are each grouped by every non-measure column, so a
    distinct union would remove nothing: plain ``unionByName``.
    """
    start = max(p.history_start, min(p.report_start, backlog_capture_start(t, p)))
    pv = report_processing_volume(t, p, start)
    if materialize == "table":
        pv = stage_table(pv, t, "processing_volume")
    elif materialize == "checkpoint":
        pv = pv.checkpoint(eager=True)
    return processing_report_from(pv, t, p).unionByName(backlog_report_from(pv, t, p, checks))


def backlog_daily(t: Tables, p: ReportParams, ids: DataFrame | None = None) -> DataFrame:
    """J-9: ungrouped daily backlog (no override dates, no upper capture bound).

    ``ids`` (a table of merchant ids) restricts the accounts with a semi-join.
    """
    start = max(p.history_start, backlog_capture_start(t, p, with_override=False))
    pv = processing_volume(t.payments, t.merchants, t.upsells, None, start, None, ids=ids,
                           daily=payments_daily(t, start, None, expanding=True), overlapping=several_upsells(t))
    summary = backlog_summary(pv, t.backlog_curve, p.as_of,
                              keys=("sales_merchant_id", "sales_category", "sales_activation_date"))
    daily = expand_backlog(summary, t.backlog_curve)
    return daily.select("fcst_date", "sales_merchant_id", "sales_category",
                        money("backlog_amount").alias("backlog_npv"))


# --------------------------------------------------------------------------- pipeline (J-2, J-10)

PIPE_KEYS = (
    "opportunity", "opportunity_name", "opportunity_created_date", "opportunity_close_date", "opportunity_owner",
    "opportunity_type", "opportunity_expected_go_live_date", "opportunity_status", "opportunity_industry",
    "opportunity_merchant_country", "live_or_not", "activation_date",
)


def pipeline_opportunities(t: Tables, p: ReportParams, keys=PIPE_KEYS, vertical_variant: str | None = None,
                           expanding: bool = False) -> DataFrame:
    """Eligible deals with their expected first-year amount (one row per deal and attribute set).

    ``expected_amount`` = amount counted once per deal x mean probability / 100
    (exact decimal); NULL probability leaves it NULL.
    """
    e = eligible_pipeline(t.opportunities, t.merchants, p).select(
        "*",
        opportunity_status("opportunity_stage").alias("opportunity_status"),
        live_or_not("activation_date", p.cutoff).alias("live_or_not"),
    )
    # Hash partitioning on the deal id also satisfies the deal aggregates, so no further
    # exchange follows.  Where a deal row becomes 365 daily rows (J-10), AQE would size the
    # partitions by their small input and leave the expansion to a few tasks.
    if expanding:
        e = e.repartition(int(e.sparkSession.conf.get("spark.sql.shuffle.partitions")), "opportunity")
    else:
        e = e.repartition("opportunity")
    if vertical_variant is not None:
        e = e.withColumn("vertical", vertical(None, "opportunity_merchant_country", "opportunity_industry",
                                              variant=vertical_variant))
    mes = (amount_once_in_group("opportunity_amount").cast("decimal(18,2)")
           * F.avg(F.col("opportunity_probability").cast("decimal(5,0)")) / F.lit(100).cast("decimal(3,0)"))
    return e.groupBy(*keys).agg(
        mes.cast(MONEY).alias("expected_amount"),
        F.coalesce(F.sum(days_since_close("opportunity_close_date", p.as_of)), F.lit(0)).alias("days_since_close_date"),
    )


def pipeline_report(t: Tables, p: ReportParams) -> DataFrame:
    """J-2: expected revenue of deals not yet live, spread on the pipeline curve, by segment and week.

    Deals are classified and summed on the report's columns first; each then
    meets the weeks of its go-live date, whose curve shares are summed
    beforehand.  No daily rows are made, and amounts are rounded once.
    """
    go_live = "opportunity_expected_go_live_date"
    cc = countries_by(t.country_codes, "name")
    tm = teams(t.team_role, p.exclude_roles)
    pipe = pipeline_opportunities(t, p)
    deals = (pipe.join(cc, pipe["opportunity_merchant_country"] == cc["sfdc_country_name"])
             .join(tm, pipe["opportunity_owner"] == tm["sales_owner"])
             .groupBy(
                 "opportunity", "opportunity_name", "opportunity_owner", "sales_role", "sales_location",
                 F.col("opportunity_status").alias("data_type"), F.col("sales_region").alias("region"),
                 F.col("sfdc_country_name").alias("country"), F.col(go_live).alias("start"),
                 sub_region("sales_role", "sales_region", "sfdc_country_name", "opportunity_industry", code="country_code",
                            location="sales_location", variant="C").alias("sub_region"),
                 vertical("sales_region", "sfdc_country_name", "opportunity_industry", variant="A").alias("vertical"),
                 P.new_npv(go_live, p, opp_type="opportunity_type").alias("newNPV"))
             .agg(money(F.sum("expected_amount")).alias("expected_amount"), F.min("opportunity_created_date").alias("first_created")))
    weeks = curve_weeks(t.pipeline_curve, p.cutoff, p.horizon_end)
    weekly = deals.join(weeks, "start").select("*", *P.week_bucket_labels(p.run_day, p.this_week_lag_days))
    return weekly.select(
        "data_type", "year", "quarter", "finance_week", F.lit(0).alias("qtd"), "this_week", "region", "country",
        F.lit("").alias("sales_channel"), "sub_region", "vertical",
        F.col("opportunity_owner").alias("owner"), "sales_role", "sales_location",
        opportunity_merchant_key("opportunity").alias("sales_merchant_id"),
        F.col("opportunity_name").alias("merchant_name"),
        F.lit("opportunity").alias("sales_category"),
        F.col("start").alias("sales_activation_date"),
        "ninety_day_live", "first_year_sold",
        money(F.coalesce(F.col("expected_amount") * F.col("share"), F.lit(0))).alias("npv_fixed_fx"), "newNPV",
        P.in_quarter("start", "first_created", p.run_day, p.in_quarter_lag_days).alias("in_quarter_opportunity"),
    )


DEPRECATED_PIPE_KEYS = (
    "opportunity", "opportunity_name", "opportunity_close_date", "opportunity_owner",
    "opportunity_expected_go_live_date", "opportunity_status", "vertical", "opportunity_merchant_country",
    "live_or_not", "activation_date",
)


def pipeline_daily(t: Tables, p: ReportParams) -> DataFrame:
    """J-10: ungrouped daily pipeline (older vertical rules)."""
    pipe = pipeline_opportunities(t, p, DEPRECATED_PIPE_KEYS, vertical_variant="F", expanding=True)
    daily = expand_pipeline(pipe, t.pipeline_curve)
    return daily.select(
        "fcst_date",
        opportunity_merchant_key("opportunity").alias("unified_merchant_id"),
        F.col("opportunity_owner").alias("owner"),
        F.col("opportunity_name").alias("merchant_name"),
        "opportunity_merchant_country", "vertical", "opportunity_status",
        money("pipeline_amount").alias("pipeline_npv"),
    )


# --------------------------------------------------------------------------- deal signed (J-1)

def deal_signed_report(t: Tables, p: ReportParams, checks: Checks | None = None) -> DataFrame:
    """J-1: one row per open or won deal with period labels, segment and this-week flags.

    ``checks`` counts the deals without a mapped country or owner.
    """
    o = t.opportunities.filter(~F.col("opportunity_stage").isin(*EXCLUDED_DEAL_STAGES))
    cc = countries_by(t.country_codes, "name")
    tm = teams(t.team_role, p.exclude_roles)
    j = matched(o, [("country", cc, "opportunity_merchant_country", "sfdc_country_name"), ("owner", tm, "opportunity_owner", "sales_owner")], checks, "deals")
    close, created, live = "opportunity_close_date", "opportunity_created_date", "opportunity_expected_go_live_date"
    return j.select(
        F.lit("deal_data").alias("data_type"),
        P.period_label(close, "quarter").alias("close_quarter"),
        P.finance_week(close).alias("close_finance_week"),
        closed_flag("opportunity_stage").alias("closed"),
        P.period_label(created, "quarter").alias("pipeline_created_quarter"),
        P.finance_week(created).alias("pipeline_created_finance_week"),
        P.period_label(live, "quarter").alias("expected_go_live_quarter"),
        P.finance_week(live).alias("expected_go_live_finance_week"),
        F.date_format(live, "yyyy-MM-dd").alias("opportunity_expected_go_live_date"),
        F.col("sales_region").alias("region"), F.col("sfdc_country_name").alias("country"),
        F.lit("").alias("sales_channel"),
        sub_region("sales_role", "sales_region", "sfdc_country_name", "opportunity_industry", code="country_code",
                   location="sales_location", variant="B").alias("sub_region"),
        F.col("opportunity_owner").alias("owner"), "sales_role", "sales_location",
        opportunity_merchant_key("opportunity").alias("sales_merchant_id"),
        F.col("opportunity_name").alias("merchant_name"),
        "opportunity_stage", "opportunity_probability", "opportunity_amount",
        weighted_amount("opportunity_probability", "opportunity_amount").alias("wgted_opportunity_amount"),
        P.cohort_flag(created, p.as_of).alias("created_this_week"),
        P.cohort_flag(close, p.as_of).alias("closed_this_week"),
        P.cohort_flag(live, p.as_of).alias("live_this_week"),
    )


# --------------------------------------------------------------------------- margin (J-6)

MARGIN_MEASURES = (
    ("npv", "npv_fixed_fx"),
    ("revenue_total", "revenue_fixed_fx"),
    ("costs_total", "costs_fixed_fx"),
    ("revenue_fx", "revenue_fx_fixed_fx"),
    ("revenue_disputes", "revenue_disputes_fixed_fx"),
    ("revenue_other_api", "revenue_other_api_fixed_fx"),
)


def margin_daily(t: Tables, p: ReportParams, start=None) -> DataFrame:
    """O-25: six first-year money measures per (capture day, merchant), in cents.

    Sold merchants, captures in [start or history_start, as_of); a measure
    counts only while the capture is 0..365 days after activation.  A broadcast
    of the merchants leaves the daily rows where they are; otherwise the join
    brings each merchant's together.
    """
    daily = capture_range(daily_margin(t), start or p.history_start, p.as_of)
    attr = merchant_attribution(t.merchants, None, None).select("sales_merchant_id", "orig_activation")
    j = daily.join(attr, "sales_merchant_id")
    fy = P.in_first_year("orig_activation", "capture_date")
    return j.select(
        "capture_date", "sales_merchant_id", F.col("orig_activation").alias("sales_activation_date"),
        *[F.when(fy, F.col(c)).otherwise(F.lit(0).cast("bigint")).alias(c) for c, _ in MARGIN_MEASURES],
    )


def margin_report(t: Tables, p: ReportParams) -> DataFrame:
    """J-6: first-year margin measures per merchant and month, with the deal amount attached.

    ``opportunity_amount_usd_fixed_fx`` keeps the report's sum over capture
    days (the deal amount once per day row); ``opportunity_amount_once``
    counts it once.  ``mtd`` keeps the report's quarter comparison;
    ``month_to_date`` compares months.
    """
    d = F.col("capture_date")
    act = "sales_activation_date"
    monthly = (
        margin_daily(t, p, start=p.report_start)
        .groupBy(
            "sales_merchant_id", act, *P.month_bucket_keys(d),
            P.ninety_day_live(act, d).alias("ninety_day_live"), P.first_year_sold(act, d).alias("first_year_sold"),
        )
        .agg(*[F.sum(c).alias(c) for c, _ in MARGIN_MEASURES], F.count(F.lit(1)).alias("n_days"))
        .select("*", *P.month_bucket_labels(p.as_of))
    )
    seg = report_segments(t, "A", "A", False, p.exclude_roles)
    # deal amount per merchant, built at dimension size and joined on the merchant id,
    # so the monthly rows (already partitioned by merchant) are not re-shuffled by deal id
    totals = crm_opportunity_totals(t)
    opp_of = t.merchants.select(F.col("merchant_id").alias("sales_merchant_id"), "sfdc_opportunity")
    deal = merchant_level(opp_of.join(totals, F.col("sfdc_opportunity") == totals["opportunity"])
                          .select("sales_merchant_id", "opportunity_amount"), t.merchants, "merchant deal amount")
    j = (monthly.join(seg.drop("first_opportunity_created_date"), "sales_merchant_id")
         .join(deal, "sales_merchant_id"))
    return j.select(
        F.lit("weekly_processing").alias("data_type"), "year", "quarter", "month", "mtd",
        F.lit(0).alias("this_month"),
        "region", "country", F.lit("").alias("sales_channel"), "sub_region", "vertical", "owner", "sales_role",
        "sales_location", F.col("sales_merchant_id").cast("string").alias("sales_merchant_id"), "merchant_name",
        F.lit("new biz").alias("sales_category"), act, "ninety_day_live", "first_year_sold",
        *[money(cents_to_dollars(F.coalesce(F.col(c), F.lit(0)))).alias(out) for c, out in MARGIN_MEASURES],
        money(F.col("opportunity_amount") * F.col("n_days")).alias("opportunity_amount_usd_fixed_fx"),
        money(F.col("opportunity_amount")).alias("opportunity_amount_once"),
        "month_to_date",
    )


# --------------------------------------------------------------------------- weekly snapshots (J-7, J-8)

SNAPSHOT_COLUMNS = (
    "data_type", "year", "quarter", "finance_week", "qtd", "region", "country", "sales_channel", "sub_region",
    "vertical", "owner", "sales_role", "sales_location", "sales_merchant_id", "merchant_name", "activation_date",
    "ninety_day_live", "first_year_sold", "npv_fixed_fx",
)


def weekly_snapshot(t: Tables, p: ReportParams, upsell: bool = False, team: DataFrame | None = None) -> DataFrame:
    """J-7 / J-8 body: weekly revenue per merchant and segment (captures in [history_start, as_of)).

    With ``upsell`` only merchants with an included upsell count; the
    activation date is the upsell date and the revenue is the upsell share.
    ``team`` takes the place of the current role table (that of an earlier week).
    """
    daily = payments_daily(t, p.history_start, p.as_of)
    m = t.merchants.filter(F.col("sales__is_sold") == F.lit(True)).select(
        F.col("merchant_id").alias("sales_merchant_id"), F.col("activation_date"))
    amount = cents_to_dollars(F.col("npv_cents"))
    if upsell:
        up = small_dimension(current_upsells(t.upsells), "sales_merchant_id", UPSELL_MAX_ROWS, "upsells")
        m = m.join(up, "sales_merchant_id").select(
            "sales_merchant_id", F.col("effective_activation_date").alias("activation_date"), "pct_share_of_npv")
        amount = amount * F.col("pct_share_of_npv")
    m = merchant_level(m, t.merchants, "snapshot merchants")
    d = F.col("capture_date")
    weekly = daily.join(m, "sales_merchant_id").groupBy(
        "sales_merchant_id", "activation_date", *P.week_bucket_keys(d),
        P.ninety_day_live("activation_date", d).alias("ninety_day_live"),
        P.first_year_sold("activation_date", d).alias("first_year_sold"),
    ).agg(F.sum(amount).alias("npv")).select("*", *P.week_bucket_labels(p.as_of))
    seg = (report_segments(t, "E", "E", False, p.exclude_roles) if team is None
           else segment_dimension(t.merchants, t.country_codes, team, None, "E", "E", p.exclude_roles))
    j = weekly.join(seg.drop("first_opportunity_created_date"), "sales_merchant_id")
    return j.select(
        F.lit("weekly_processing").alias("data_type"), "year", "quarter", "finance_week", "qtd",
        "region", "country", F.lit("").alias("sales_channel"), "sub_region", "vertical", "owner", "sales_role",
        "sales_location", F.col("sales_merchant_id").cast("string").alias("sales_merchant_id"), "merchant_name",
        "activation_date", "ninety_day_live", "first_year_sold",
        money(F.coalesce(F.col("npv"), F.lit(0))).alias("npv_fixed_fx"),
    )


def weekly_processing_snapshot(t: Tables, p: ReportParams) -> DataFrame:
    """J-7 body (not written)."""
    return weekly_snapshot(t, p, upsell=False)


def weekly_upsell_snapshot(t: Tables, p: ReportParams) -> DataFrame:
    """J-8 body (not written)."""
    return weekly_snapshot(t, p, upsell=True)


# --------------------------------------------------------------------------- team roles (O-30, O-31, J-12)

def owners_missing_role(t: Tables, like: str = "%AE%") -> DataFrame:
    """Distinct merchant owners whose role is not like ``like``, or who have no role at all."""
    tm = t.team_role.select("sales_owner", F.col("role").alias("sales_role"))
    m = t.merchants.select(F.col("sales__owner").alias("owner")).filter(F.col("owner").isNotNull())
    j = m.join(tm, m["owner"] == tm["sales_owner"], "left")
    return j.filter(F.col("sales_role").isNull() | ~F.col("sales_role").like(like)).select(
        "owner", "sales_role").distinct()


def upsert_roles(team: DataFrame, add: DataFrame | None = None, remove: DataFrame | None = None) -> DataFrame:
    """Role table with ``remove`` owners dropped and ``add`` rows inserted (replacing same owners)."""
    out = team.select("sales_owner", "role", "team")
    for drop in (remove, add):
        if drop is not None:
            keys = drop.select(F.col("sales_owner").alias("_owner")).distinct()
            out = out.join(keys, out["sales_owner"] == keys["_owner"], "left_anti")
    if add is not None:
        out = out.unionByName(add.select("sales_owner", "role", "team"))
    return out


def apply_role_edits(stored: DataFrame, edits: DataFrame) -> DataFrame:
    """The role table after an ordered list of edits (seq, action, sales_owner, role, team).

    ``add`` sets an owner's role and team, ``remove`` takes the owner out; of
    several edits of an owner the last one wins, so an addition after a removal
    stays, and the same list applied twice gives the same table.  Removing an
    owner who is not there changes nothing.  A repeated ``seq`` raises, as the
    order would not be known, and so does an unknown action.
    """
    check_unique(edits.select("seq"), "seq", "role edits")
    last = edits.groupBy("sales_owner").agg(F.max("seq").alias("seq")).select(F.col("sales_owner").alias("_owner"), F.col("seq").alias("_seq"))
    known = F.col("action").isin("add", "remove")
    action = F.when(known, F.col("action")).otherwise(F.raise_error(F.concat(F.lit("unknown action of a role edit: "), F.coalesce("action", F.lit("NULL")))))
    valid = edits.select("seq", action.alias("action"), "sales_owner", "role", "team")
    winning = valid.join(last, (F.col("sales_owner") == F.col("_owner")) & (F.col("seq") == F.col("_seq")))
    added = winning.filter(F.col("action") == "add").select("sales_owner", "role", "team")
    kept = stored.select("sales_owner", "role", "team").join(last, F.col("sales_owner") == F.col("_owner"), "left_anti")
    return kept.unionByName(added)


def team_role_fix(t: Tables, role: str = "AE", team: str = "In-country") -> DataFrame:
    """O-31: add every merchant or deal owner missing from the role table (``role`` / ``team``),
    and remove role rows whose owner owns no merchant and no deal."""
    owners = (t.merchants.select(F.col("sales__owner").alias("sales_owner"))
              .unionByName(t.opportunities.select(F.col("opportunity_owner").alias("sales_owner")))
              .filter(F.col("sales_owner").isNotNull()).distinct())
    known = t.team_role.select("sales_owner")
    missing = owners.join(known, "sales_owner", "left_anti").select(
        "sales_owner", F.lit(role).alias("role"), F.lit(team).alias("team"))
    stale = known.join(owners, "sales_owner", "left_anti")
    return upsert_roles(t.team_role, add=missing, remove=stale)
