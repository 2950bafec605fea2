"""Operator-level registered queries: one per inventory item, each over the whole staged tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions.measures import (
    cents_to_dollars,
    days_since_close,
    forecast_weighted_amount,
    live_or_not,
    money,
    to_units,
    units_to_money,
    upsell_snapshot_measure,
    weighted_amount,
)
from ..functions.segments import closed_flag, opportunity_status, sub_region, vertical
from ..operators import attribution as A
from ..operators import enrich as E
from ..operators import rollups as RU
from ..operators.curves import backlog_summary as _backlog_summary
from ..operators.curves import expand_pipeline
from ..operators.fanout import sum_once
from ..params import ReportParams
from ..sources import fixtures
from ..sources.tables import Tables
from . import reports as R
from .registry import register

# ----------------------------------------------------------------------------- periods (O-1..O-5)


def _capture_dates(t: Tables) -> DataFrame:
    return t.payments.select("capture_date").distinct()


@register("finance_week")
def finance_week(t: Tables, p: ReportParams) -> DataFrame:
    """O-1: finance-week label of every capture date."""
    return _capture_dates(t).select("capture_date", P.finance_week("capture_date").alias("finance_week"))


@register("period_labels")
def period_labels(t: Tables, p: ReportParams) -> DataFrame:
    """O-2: year, quarter and month labels of every capture date."""
    d = "capture_date"
    return _capture_dates(t).select(d, P.period_label(d, "year").alias("year"),
                                    P.period_label(d, "quarter").alias("quarter"),
                                    P.period_label(d, "month").alias("month"))


@register("qtd_flag")
def qtd_flag(t: Tables, p: ReportParams) -> DataFrame:
    """O-3a: quarter-to-date flag of every capture date."""
    return _capture_dates(t).select("capture_date", P.qtd_flag("capture_date", p.as_of).alias("qtd"))


@register("this_week_flag")
def this_week_flag(t: Tables, p: ReportParams) -> DataFrame:
    """O-3b: this-week flag (finance week of the report date minus the lag) of every capture date."""
    return _capture_dates(t).select(
        "capture_date", P.this_week_flag("capture_date", p.as_of, p.this_week_lag_days).alias("this_week"))


@register("mtd_flag")
def mtd_flag(t: Tables, p: ReportParams) -> DataFrame:
    """O-3c: the margin report's mtd (quarter test), this_month (0) and a true month flag per capture date."""
    mtd, this_month, true_mtd = P.month_flags(F.col("capture_date"), p.as_of)
    return _capture_dates(t).select("capture_date", mtd.alias("mtd"), this_month.alias("this_month"),
                                    true_mtd.alias("month_to_date"))


@register("activation_age")
def activation_age(t: Tables, p: ReportParams) -> DataFrame:
    """O-4: days from activation to the report date, per merchant."""
    return t.merchants.select("merchant_id", "activation_date",
                              P.days_since("activation_date", p.as_of).alias("activation_age"))


def _merchant_days(t: Tables, p: ReportParams) -> DataFrame:
    daily = R.payments_daily(t)
    m = t.merchants.select(F.col("merchant_id").alias("sales_merchant_id"), "activation_date")
    return daily.join(m, "sales_merchant_id")


@register("ninety_day_live")
def ninety_day_live(t: Tables, p: ReportParams) -> DataFrame:
    """O-5a: capture days per merchant inside and outside the first 91 days."""
    return _merchant_days(t, p).groupBy(
        "sales_merchant_id", P.ninety_day_live("activation_date", "capture_date").alias("ninety_day_live")
    ).agg(F.count(F.lit(1)).alias("n_days"))


@register("first_year_sold")
def first_year_sold(t: Tables, p: ReportParams) -> DataFrame:
    """O-5b: capture days per merchant inside and outside the first year (366 days)."""
    return _merchant_days(t, p).groupBy(
        "sales_merchant_id", P.first_year_sold("activation_date", "capture_date").alias("first_year_sold")
    ).agg(F.count(F.lit(1)).alias("n_days"))


@register("age_flags_with_end_date")
def age_flags_with_end_date(t: Tables, p: ReportParams) -> DataFrame:
    """O-5c: backlog days per merchant, category and age flags, which an end date switches off."""
    spans = R.report_backlog_spans(R.backlog_processing_volume(t, p), t, p)
    return spans.groupBy("sales_merchant_id", "sales_category", *R.span_flags(p)[:2]).agg(F.sum("n_days").alias("n_days"))


# ----------------------------------------------------------------------------- segments (O-6..O-10)


def _merchant_segments(t: Tables) -> DataFrame:
    m = t.merchants.select("merchant_id", "sales__industry", "sales__merchant_country", "sales__owner")
    m = E.enrich_country(m, t.country_codes, "sales__merchant_country", "code")
    return E.enrich_team(m, t.team_role, "sales__owner")


def _deal_segments(t: Tables) -> DataFrame:
    o = t.opportunities.select("opportunity", "opportunity_industry", "opportunity_merchant_country",
                               "opportunity_owner")
    o = E.enrich_country(o, t.country_codes, "opportunity_merchant_country", "name")
    return E.enrich_team(o, t.team_role, "opportunity_owner")


def _merchant_sub_region(variant: str):
    def q(t: Tables, p: ReportParams) -> DataFrame:
        return _merchant_segments(t).select(
            "merchant_id",
            sub_region("sales_role", "sales_region", "sfdc_country_name", "sales__industry", code="country_code",
                       location="sales_location", variant=variant).alias("sub_region"))
    return q


def _deal_sub_region(variant: str):
    def q(t: Tables, p: ReportParams) -> DataFrame:
        return _deal_segments(t).select(
            "opportunity",
            sub_region("sales_role", "sales_region", "sfdc_country_name", "opportunity_industry",
                       code="country_code", location="sales_location", variant=variant).alias("sub_region"))
    return q


register("sub_region")(_merchant_sub_region("A"))
register("sub_region_b")(_deal_sub_region("B"))
register("sub_region_c")(_deal_sub_region("C"))
register("sub_region_d")(_merchant_sub_region("D"))
register("sub_region_e")(_merchant_sub_region("E"))


def _merchant_vertical(variant: str):
    def q(t: Tables, p: ReportParams) -> DataFrame:
        return _merchant_segments(t).select(
            "merchant_id",
            vertical("sales_region", "sfdc_country_name", "sales__industry", variant=variant).alias("vertical"))
    return q


register("vertical")(_merchant_vertical("A"))
register("vertical_e")(_merchant_vertical("E"))


@register("vertical_f")
def vertical_f(t: Tables, p: ReportParams) -> DataFrame:
    """O-7 variant F: older vertical rules on deals (country name, industry)."""
    return t.opportunities.select(
        "opportunity",
        vertical(None, "opportunity_merchant_country", "opportunity_industry", variant="F").alias("vertical"))


@register("opportunity_status")
def q_opportunity_status(t: Tables, p: ReportParams) -> DataFrame:
    """O-8: pipeline / signed_not_live / lost per deal."""
    return t.opportunities.select("opportunity", "opportunity_stage",
                                  opportunity_status("opportunity_stage").alias("opportunity_status"))


@register("closed_flag")
def q_closed_flag(t: Tables, p: ReportParams) -> DataFrame:
    """O-9: closed flag per deal."""
    return t.opportunities.select("opportunity", closed_flag("opportunity_stage").alias("closed"))


@register("weighted_amount")
def q_weighted_amount(t: Tables, p: ReportParams) -> DataFrame:
    """O-10: probability-weighted amount per deal."""
    return t.opportunities.select(
        "opportunity", weighted_amount("opportunity_probability", "opportunity_amount").alias("wgted_opportunity_amount"))


# ----------------------------------------------------------------------------- measures and rollups (O-11..O-15)


@register("fanout_safe_sum")
def fanout_safe_sum(t: Tables, p: ReportParams) -> DataFrame:
    """Deal amounts per owner after a join that repeats each deal once per order line."""
    lines = t.raw("lineitem").select(F.col("l_orderkey").cast("string").alias("opportunity"), "l_linenumber")
    fanned = t.opportunities.select("opportunity", "opportunity_owner", "opportunity_amount").join(lines, "opportunity")
    out = sum_once(fanned, ["opportunity_owner"], "opportunity", "opportunity_amount", "opportunity_amount_once")
    return out.select("opportunity_owner", F.col("opportunity_amount_once").cast("decimal(18,2)"))


@register("expected_amount")
def expected_amount(t: Tables, p: ReportParams) -> DataFrame:
    """O-12: expected first-year amount of each eligible deal."""
    return R.pipeline_opportunities(t, p).select("opportunity", "expected_amount")


@register("first_contact")
def q_first_contact(t: Tables, p: ReportParams) -> DataFrame:
    """O-13: earliest deal created date per parent merchant."""
    return R.crm_first_contact(t)


@register("special_dates")
def q_special_dates(t: Tables, p: ReportParams) -> DataFrame:
    """O-14: latest end date and override activation date per parent merchant."""
    return R.crm_special_dates(t)


@register("activation_override")
def q_activation_override(t: Tables, p: ReportParams) -> DataFrame:
    """O-15: reported activation (override when present) per merchant."""
    sd = R.crm_special_dates(t).select(F.col("sales_merchant_id").alias("merchant_id"),
                                                  "adjusted_activation_date")
    return t.merchants.select("merchant_id", "activation_date").join(sd, "merchant_id", "left").select(
        "merchant_id", "activation_date", "adjusted_activation_date",
        RU.activation_override("activation_date", "adjusted_activation_date").alias("sales_activation_date"))


# ----------------------------------------------------------------------------- attribution and curves (O-16..O-21)


def _pv_money(pv: DataFrame) -> DataFrame:
    return pv.select(*[c for c in A.PV_COLUMNS[:-2]],
                     money("first_year_sold_npv_usd_fx").alias("first_year_sold_npv_usd_fx"),
                     money("total_npv").alias("total_npv"))


@register("new_business_leg")
def new_business_leg(t: Tables, p: ReportParams) -> DataFrame:
    """O-16: daily first-year NPV of the new-business leg."""
    return _pv_money(A.new_business_leg(t.payments, t.merchants, t.upsells, R.crm_special_dates(t),
                                        p.history_start, p.as_of))


@register("upsell_leg")
def upsell_leg(t: Tables, p: ReportParams) -> DataFrame:
    """O-17: daily first-year NPV of the upsell leg."""
    return _pv_money(A.upsell_leg(t.payments, t.merchants, t.upsells, p.history_start, p.as_of))


@register("processing_volume")
def q_processing_volume(t: Tables, p: ReportParams) -> DataFrame:
    """O-18: both legs stacked (the reports' processing volume)."""
    return _pv_money(R.report_processing_volume(t, p))


@register("overlapping_upsells")
def overlapping_upsells(t: Tables, p: ReportParams) -> DataFrame:
    """O-16, O-17 where merchants have up to three included upsells at a time: both legs, shares never above one together."""
    ups = fixtures.overlapping_upsells(t.upsells)
    return _pv_money(A.processing_volume(t.payments, t.merchants, ups, R.crm_special_dates(t), p.history_start, p.as_of,
                                         daily=R.payments_daily(t, p.history_start, p.as_of), overlapping=True))


@register("backlog_summary")
def q_backlog_summary(t: Tables, p: ReportParams) -> DataFrame:
    """O-19: first-year actuals to date and full-year estimate per merchant and category."""
    s = _backlog_summary(R.backlog_processing_volume(t, p), t.backlog_curve, p.as_of)
    return s.select("sales_merchant_id", "sales_category", "sales_activation_date", "orig_activation",
                    "days_since_activation", money("first_year_npv").alias("first_year_npv"),
                    units_to_money(to_units("first_year_est_npv")).alias("first_year_est_npv"))


@register("backlog_curve_expand")
def backlog_curve_expand(t: Tables, p: ReportParams) -> DataFrame:
    """O-20: remaining first-year revenue per merchant, category and future day."""
    d = R.daily_backlog(R.backlog_processing_volume(t, p), t, p)
    return d.select("fcst_date", "sales_merchant_id", "sales_category", "sales_activation_date", "orig_activation",
                    money("backlog_amount").alias("backlog_npv"))


@register("pipeline_curve_expand")
def pipeline_curve_expand(t: Tables, p: ReportParams) -> DataFrame:
    """O-21: pipeline curve expansion, summed per forecast day."""
    d = expand_pipeline(R.pipeline_opportunities(t, p, expanding=True), t.pipeline_curve)
    return d.groupBy("fcst_date").agg(F.count(F.lit(1)).alias("n_rows"),
                                      money(F.coalesce(F.sum("pipeline_amount"), F.lit(0))).alias("pipeline_npv"))


# ----------------------------------------------------------------------------- report flags (O-22..O-24)


@register("new_npv_processing")
def new_npv_processing(t: Tables, p: ReportParams) -> DataFrame:
    """O-22a: new-NPV flag of the processing rows."""
    pv = R.report_processing_volume(t, p)
    return pv.select("sales_merchant_id", "sales_category", "orig_activation").distinct().withColumn(
        "newNPV", P.new_npv("orig_activation", p))


@register("new_npv_backlog")
def new_npv_backlog(t: Tables, p: ReportParams) -> DataFrame:
    """O-22b: backlog days per merchant and new-NPV flag value."""
    spans = R.report_backlog_spans(R.backlog_processing_volume(t, p), t, p)
    return spans.groupBy("sales_merchant_id", "sales_category", R.span_flags(p)[2]).agg(F.sum("n_days").alias("n_days"))


@register("new_npv_pipeline")
def new_npv_pipeline(t: Tables, p: ReportParams) -> DataFrame:
    """O-22c: new-NPV flag of each eligible deal."""
    pipe = R.pipeline_opportunities(t, p)
    return pipe.select("opportunity", P.new_npv("opportunity_expected_go_live_date", p,
                                                opp_type="opportunity_type").alias("newNPV"))


@register("in_quarter_opportunity")
def in_quarter_opportunity(t: Tables, p: ReportParams) -> DataFrame:
    """O-23: in-quarter flag per merchant (activation and first deal in the lagged quarter)."""
    act = q_activation_override(t, p).select("merchant_id", "sales_activation_date")
    fc = R.crm_first_contact(t).withColumnRenamed("sales_merchant_id", "merchant_id")
    j = act.join(fc, "merchant_id", "left")
    return j.select("merchant_id", "sales_activation_date", "first_opportunity_created_date",
                    P.in_quarter("sales_activation_date", "first_opportunity_created_date", p.as_of,
                                 p.in_quarter_lag_days).alias("in_quarter_opportunity"))


@register("this_week_cohort_flags")
def this_week_cohort_flags(t: Tables, p: ReportParams) -> DataFrame:
    """O-24: created / closed / live-this-week flags per deal."""
    return t.opportunities.select(
        "opportunity",
        P.cohort_flag("opportunity_created_date", p.as_of).alias("created_this_week"),
        P.cohort_flag("opportunity_close_date", p.as_of).alias("closed_this_week"),
        P.cohort_flag("opportunity_expected_go_live_date", p.as_of).alias("live_this_week"))


# ----------------------------------------------------------------------------- margin (O-25, O-26)


@register("margin_measures")
def margin_measures(t: Tables, p: ReportParams) -> DataFrame:
    """O-25: six first-year margin measures per merchant and capture day."""
    d = R.margin_daily(t, p)
    return d.select("capture_date", "sales_merchant_id", "sales_activation_date",
                    *[money(cents_to_dollars(c)).alias(out) for c, out in R.MARGIN_MEASURES])


@register("opportunity_amount_attach")
def opportunity_amount_attach(t: Tables, p: ReportParams) -> DataFrame:
    """O-26: deal amount attached to each merchant through its opportunity id."""
    totals = R.crm_opportunity_totals(t)
    m = t.merchants.select("merchant_id", "sfdc_opportunity")
    return m.join(totals, m["sfdc_opportunity"] == totals["opportunity"]).select(
        "merchant_id", "sfdc_opportunity", money("opportunity_amount").alias("opportunity_amount"))


# ----------------------------------------------------------------------------- enrichment and shaping (O-28..O-36)


@register("enrich_country_by_name")
def enrich_country_by_name(t: Tables, p: ReportParams) -> DataFrame:
    """O-28a: deals joined to the country map by country name."""
    o = t.opportunities.select("opportunity", "opportunity_merchant_country")
    return E.enrich_country(o, t.country_codes, "opportunity_merchant_country", "name").select(
        "opportunity", "country_code", "sales_region")


@register("enrich_country_by_code")
def enrich_country_by_code(t: Tables, p: ReportParams) -> DataFrame:
    """O-28b: merchants joined to the country map by country code."""
    m = t.merchants.select("merchant_id", "sales__merchant_country")
    return E.enrich_country(m, t.country_codes, "sales__merchant_country", "code").select(
        "merchant_id", "sfdc_country_name", "sales_region")


@register("enrich_team")
def q_enrich_team(t: Tables, p: ReportParams) -> DataFrame:
    """O-28c: merchants joined to the team map by owner."""
    m = t.merchants.select("merchant_id", F.col("sales__owner").alias("owner"))
    return E.enrich_team(m, t.team_role, "owner").select("merchant_id", "owner", "sales_role", "sales_location")


@register("enrich_merchant")
def q_enrich_merchant(t: Tables, p: ReportParams) -> DataFrame:
    """O-28d: daily payment sums joined to the merchant dimension, per merchant."""
    daily = R.payments_daily(t)
    j = E.enrich_merchant(daily, t.merchants.select("merchant_id", "activation_date"))
    return j.groupBy("sales_merchant_id", "activation_date").agg(
        F.count(F.lit(1)).alias("n_days"), money(cents_to_dollars(F.sum("npv_cents"))).alias("npv"))


@register("account_allow_list")
def account_allow_list(t: Tables, p: ReportParams) -> DataFrame:
    """Daily backlog of the accounts listed in the upsell table (the list is a table, any size)."""
    return R.backlog_daily(t, p, ids=t.upsells.select("sales_merchant_id"))


@register("opportunity_merchant_key")
def q_opportunity_merchant_key(t: Tables, p: ReportParams) -> DataFrame:
    """O-32: deal id in the merchant id column."""
    return t.opportunities.select("opportunity", E.opportunity_merchant_key("opportunity").alias("sales_merchant_id"))


@register("report_constants")
def report_constants(t: Tables, p: ReportParams) -> DataFrame:
    """O-33: the fixed columns that align report schemas."""
    return E.with_report_constants(t.country_codes.select("country_code"), data_type="weekly_backlog",
                                   sales_channel="", sales_category="opportunity", qtd=0, this_week=0)


@register("upsell_snapshot_measure")
def q_upsell_snapshot_measure(t: Tables, p: ReportParams) -> DataFrame:
    """O-34: upsell share of NPV per merchant and finance week."""
    up = A.current_upsells(t.upsells).select("sales_merchant_id", "pct_share_of_npv")
    pay = R.payments_daily(t, p.history_start, None).join(up, "sales_merchant_id")
    return pay.groupBy("sales_merchant_id", P.finance_week("capture_date").alias("finance_week")).agg(
        money(F.sum(upsell_snapshot_measure("npv_cents", "pct_share_of_npv"))).alias("npv_fixed_fx"))


@register("pipeline_eligibility")
def pipeline_eligibility(t: Tables, p: ReportParams) -> DataFrame:
    """O-35: deals eligible for the pipeline forecast."""
    return E.eligible_pipeline(t.opportunities, t.merchants, p).select(
        "opportunity", "opportunity_stage", "opportunity_expected_go_live_date", "activation_date")


def _opps_with_activation(t: Tables) -> DataFrame:
    m = t.merchants.select(F.col("merchant_id").alias("_mid"), F.col("activation_date"))
    return E.left_join_nullable(t.opportunities, m, "merchant_id", "_mid")


@register("live_or_not")
def q_live_or_not(t: Tables, p: ReportParams) -> DataFrame:
    """O-36: live-before-cutoff flag for every deal (no eligibility filter)."""
    return _opps_with_activation(t).select("opportunity", live_or_not("activation_date", p.as_of).alias("live_or_not"))


@register("days_since_close")
def q_days_since_close(t: Tables, p: ReportParams) -> DataFrame:
    """O-36: days from close to the report date for every deal."""
    return t.opportunities.select("opportunity",
                                  days_since_close("opportunity_close_date", p.as_of).alias("days_since_close_date"))


# ----------------------------------------------------------------------------- requested features (R-*)


@register("week_over_week")
def week_over_week(t: Tables, p: ReportParams) -> DataFrame:
    """Week-on-week change of realised first-year NPV per region and sub-region.

    The report is read once, from a week earlier than it is shown, and summed
    per week; each sum then counts for its own week and, as the week before,
    for the next one.  So a week with no revenue after a week with revenue
    shows the drop, and the first week has a true week before it.
    """
    first = P.finance_week_start(F.lit(p.report_start))
    rep = R.processing_report(t, p.with_(report_start=p.report_start - dt.timedelta(days=7 + p.report_start.isoweekday() % 7)))
    wk = rep.groupBy("region", "sub_region", F.to_date("finance_week").alias("week")).agg(F.sum("npv_fixed_fx").alias("npv"))
    none = F.lit(0).cast(wk.schema["npv"].dataType)
    both = F.explode(F.array(F.struct(F.col("week"), F.col("npv").alias("cur"), none.alias("before")),
                             F.struct(F.date_add("week", 7).alias("week"), none.alias("cur"), F.col("npv").alias("before"))))
    j = (wk.select("region", "sub_region", both.alias("x")).groupBy("region", "sub_region", F.col("x.week").alias("week"))
         .agg(F.sum("x.cur").alias("cur"), F.sum("x.before").alias("before"))
         .filter((F.col("week") >= first) & (F.col("week") <= P.finance_week_start(F.lit(p.as_of)))))
    return j.select("region", "sub_region", F.date_format("week", "yyyy-MM-dd").alias("finance_week"),
                    money("cur").alias("npv_fixed_fx"), money("before").alias("prev_week_npv_fixed_fx"),
                    money(F.col("cur") - F.col("before")).alias("wow_change"))


@register("recently_live")
def recently_live(t: Tables, p: ReportParams, days: int = 28) -> DataFrame:
    """Merchants that went live in the ``days`` before the report date, with segment and deal amount."""
    m = t.merchants.filter(E.recently_live(p.as_of, days))
    seg = E.segment_dimension(m, t.country_codes, t.team_role, None, "A", "A", p.exclude_roles)
    totals = R.crm_opportunity_totals(t)
    opp = m.select(F.col("merchant_id").alias("sales_merchant_id"), "sfdc_opportunity")
    j = E.left_join_nullable(seg.join(opp, "sales_merchant_id"), totals, "sfdc_opportunity", "opportunity")
    return j.select("sales_merchant_id", F.col("merchant_activation_date").alias("activation_date"), "region",
                    "sub_region", "owner", "sales_role", money("opportunity_amount").alias("opportunity_amount"))


@register("role_as_of")
def role_as_of(t: Tables, p: ReportParams) -> DataFrame:
    """Deal-signed report without AM-owned deals (until a role history exists)."""
    return R.deal_signed_report(t, p.with_(exclude_roles=("AM",)))


@register("forecast_weighting")
def forecast_weighting(t: Tables, p: ReportParams) -> DataFrame:
    """R-9: requested forecast weighting, summed per category, stage and close quarter."""
    o = t.opportunities.filter(~F.col("opportunity_stage").isin("Lost", "Duplicate"))
    w = forecast_weighted_amount("opportunity_amount", "opportunity_probability", "opportunity_forecast_category",
                                 "opportunity_deal_amount")
    return o.groupBy("opportunity_forecast_category", "opportunity_stage",
                     P.period_label("opportunity_close_date", "quarter").alias("close_quarter")).agg(
        F.count(F.lit(1)).alias("n_deals"), money(F.sum(w)).alias("weighted_opportunity_amount"))


@register("weighted_age_fys")
def weighted_age_fys(t: Tables, p: ReportParams) -> DataFrame:
    """Revenue-weighted mean age (days since activation) of first-year revenue, per category and quarter."""
    pv = R.report_processing_volume(t, p, start=max(p.history_start, p.report_start))
    d, act = F.col("capture_date"), F.col("sales_activation_date")
    age = P.days_since(act, d)
    rows = pv.filter((d >= F.lit(p.report_start)) & age.between(0, 365))
    g = rows.groupBy("sales_category", P.period_label(d, "quarter").alias("quarter")).agg(
        F.sum(F.col("first_year_sold_npv_usd_fx") * age).cast("decimal(38,4)").alias("w"),
        F.sum("first_year_sold_npv_usd_fx").cast("decimal(38,4)").alias("n"))
    ratio = F.try_divide(F.col("w").cast("double"), F.col("n").cast("double"))
    return g.select("sales_category", "quarter", money("n").alias("first_year_npv"),
                    units_to_money(to_units(ratio)).alias("weighted_age_days"))


@register("ninety_day_forecast_by_team")
def ninety_day_forecast_by_team(t: Tables, p: ReportParams) -> DataFrame:
    """90-day forecast (pipeline + backlog rows inside the first 90 days) per team role and location."""
    rows = R.pipeline_report(t, p).unionByName(R.backlog_report(t, p))
    return rows.filter(F.col("ninety_day_live") == 1).groupBy("data_type", "sales_role", "sales_location").agg(
        money(F.sum("npv_fixed_fx")).alias("npv_fixed_fx"))



@register("expected_end_date")
def expected_end_date(t: Tables, p: ReportParams) -> DataFrame:
    """Merchants with an expected end date: backlog revenue on or after that date (flags stop counting it)."""
    spans = R.report_backlog_spans(R.backlog_processing_volume(t, p), t, p).filter(F.col("backlog_end_date").isNotNull())
    after = F.col("span_start") >= F.col("backlog_end_date")
    return spans.groupBy("sales_merchant_id", "backlog_end_date").agg(
        money(F.coalesce(F.sum(F.when(after, F.col("backlog_amount"))), F.lit(0))).alias("backlog_after_end"),
        money(F.coalesce(F.sum("backlog_amount"), F.lit(0))).alias("backlog_total"))
