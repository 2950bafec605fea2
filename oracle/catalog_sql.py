"""Oracle SQL for the operator-level registered queries."""

from __future__ import annotations

import datetime as dt

from ledgerline.params import DEFAULT_PARAMS as P

from ledgerline.sources.fixtures import ROLE_DATES

from .queries import (
    MARGIN,
    PIPELINE_TABLES,
    REPORT_TABLES,
    ROLE_FIX,
    SQL,
    backlog_daily_sql,
    backlog_select,
    deal_signed_sql,
    margin_days_sql,
    pipeline_select,
    processing_select,
    report_ctes,
    weekly_snapshot_sql,
)
from .sqlparts import (
    DEAL_TOTALS,
    FIRST_CONTACT,
    SPECIAL_DATES,
    D,
    age,
    age_flag,
    backlog_ctes,
    deal_ctes,
    eligible_sql,
    flag,
    fweek,
    in_quarter,
    money,
    month,
    qtd,
    quarter,
    revenue_ctes,
    segment_fields,
    status_sql,
    sub_region_sql,
    this_week,
    units,
    units_money,
    vertical_sql,
    week_start,
    year,
)
from .staging import with_tables

C: dict[str, str] = {}

_DATES = "SELECT DISTINCT capture_date FROM payments"
_dt = with_tables(["payments"], [("dates", _DATES)])

C["finance_week"] = _dt + f"SELECT capture_date, {fweek('capture_date')} AS finance_week FROM dates"
C["period_labels"] = _dt + (f"SELECT capture_date, {year('capture_date')} AS year, {quarter('capture_date')} AS quarter, "
                            f"{month('capture_date')} AS month FROM dates")
C["qtd_flag"] = _dt + f"SELECT capture_date, {qtd('capture_date')} AS qtd FROM dates"
C["this_week_flag"] = _dt + f"SELECT capture_date, {this_week('capture_date')} AS this_week FROM dates"
C["mtd_flag"] = _dt + (f"SELECT capture_date, {qtd('capture_date')} AS mtd, 0 AS this_month, "
                       f"CASE WHEN date_trunc('month', capture_date) = date_trunc('month', {D(P.as_of)}) THEN 1 ELSE 0 END"
                       f" AS month_to_date FROM dates")
C["activation_age"] = with_tables(["merchants"]) + (
    f"SELECT merchant_id, activation_date, {age('activation_date', D(P.as_of))} AS activation_age FROM merchants")

_MDAYS = with_tables(["payments", "merchants"], [("md", f"""
SELECT DISTINCT p.sales_merchant_id, p.capture_date, m.activation_date
FROM payments p JOIN merchants m ON p.sales_merchant_id = m.merchant_id""")])
C["ninety_day_live"] = _MDAYS + (f"SELECT sales_merchant_id, {age_flag('activation_date', 'capture_date', 90)} AS ninety_day_live, "
                                 f"count(*) AS n_days FROM md GROUP BY ALL")
C["first_year_sold"] = _MDAYS + (f"SELECT sales_merchant_id, {age_flag('activation_date', 'capture_date', 365)} AS first_year_sold, "
                                 f"count(*) AS n_days FROM md GROUP BY ALL")
C["age_flags_with_end_date"] = with_tables(REPORT_TABLES, backlog_ctes()) + f"""
SELECT b.merchant AS sales_merchant_id, b.leg AS sales_category,
  {age_flag('b.starts', 'b.day', 90, 'o.backlog_end_date')} AS ninety_day_live,
  {age_flag('b.starts', 'b.day', 365, 'o.backlog_end_date')} AS first_year_sold, count(*) AS n_days
FROM backlog_days b LEFT JOIN overrides o ON o.sales_merchant_id = b.merchant
GROUP BY ALL"""

# ----------------------------------------------------------------------------- segments
_MSEG = """FROM merchants m, country_codes land, team_role seat
WHERE land.country_code = m.sales__merchant_country AND seat.sales_owner = m.sales__owner"""
_DSEG = """FROM opportunities o, country_codes land, team_role seat
WHERE land.sfdc_country_name = o.opportunity_merchant_country AND seat.sales_owner = o.opportunity_owner"""

for _k, _v in (("sub_region", "A"), ("sub_region_d", "D"), ("sub_region_e", "E")):
    C[_k] = with_tables(["merchants", "country_codes", "team_role"]) + (
        f"SELECT m.merchant_id, {sub_region_sql(_v, **segment_fields('m.sales__industry'))} AS sub_region\n{_MSEG}")
for _k, _v in (("sub_region_b", "B"), ("sub_region_c", "C")):
    C[_k] = with_tables(["opportunities", "country_codes", "team_role"]) + (
        f"SELECT o.opportunity, {sub_region_sql(_v, **segment_fields('o.opportunity_industry'))} AS sub_region\n{_DSEG}")
for _k, _v in (("vertical", "A"), ("vertical_e", "E")):
    C[_k] = with_tables(["merchants", "country_codes", "team_role"]) + (
        f"SELECT m.merchant_id, {vertical_sql(_v, region='land.sales_region', country='land.sfdc_country_name', industry='m.sales__industry')}"
        f" AS vertical\n{_MSEG}")
C["vertical_f"] = with_tables(["opportunities"]) + (
    f"SELECT opportunity, {vertical_sql('F', country='opportunity_merchant_country', industry='opportunity_industry')}"
    f" AS vertical FROM opportunities")
C["opportunity_status"] = with_tables(["opportunities"]) + (
    f"SELECT opportunity, opportunity_stage, {status_sql('opportunity_stage')} AS opportunity_status FROM opportunities")
C["closed_flag"] = with_tables(["opportunities"]) + (
    "SELECT opportunity, CASE WHEN opportunity_stage IN ('Live', 'Onboarding') THEN 1 ELSE 0 END AS closed FROM opportunities")
C["weighted_amount"] = with_tables(["opportunities"]) + (
    f"SELECT opportunity, {money('opportunity_probability * opportunity_amount * 0.01')} AS wgted_opportunity_amount "
    f"FROM opportunities")

# ----------------------------------------------------------------------------- measures and rollups
C["fanout_safe_sum"] = with_tables(["opportunities"]) + """
SELECT opportunity_owner, CAST(COALESCE(sum(COALESCE(opportunity_amount, 0)), 0) AS DECIMAL(18,2)) AS opportunity_amount_once
FROM (SELECT DISTINCT opportunity, opportunity_owner, opportunity_amount FROM opportunities)
WHERE opportunity IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem)
GROUP BY opportunity_owner"""
C["expected_amount"] = with_tables(["opportunities", "merchants"], deal_ctes(days=False)) + (
    "SELECT deal AS opportunity, expected_amount FROM deals")
C["first_contact"] = with_tables(["opportunities"]) + FIRST_CONTACT
C["special_dates"] = with_tables(["opportunities"]) + SPECIAL_DATES
C["activation_override"] = with_tables(["merchants", "opportunities"], [("special_dates", SPECIAL_DATES)]) + """
SELECT m.merchant_id, m.activation_date, sd.adjusted_activation_date,
  coalesce(sd.adjusted_activation_date, m.activation_date) AS sales_activation_date
FROM merchants m LEFT JOIN special_dates sd ON sd.sales_merchant_id = m.merchant_id"""

# ----------------------------------------------------------------------------- attribution and curves
_REVENUE = ("SELECT 'weekly_processing' AS data_type, day AS capture_date, merchant AS sales_merchant_id, leg AS sales_category, "
            f"starts AS sales_activation_date, went_live AS orig_activation, {money('first_year')} AS first_year_sold_npv_usd_fx, "
            f"{money('total')} AS total_npv FROM revenue")
_PVT = ["payments", "merchants", "opportunities", "upsells"]
C["new_business_leg"] = with_tables(_PVT, revenue_ctes()) + _REVENUE + " WHERE leg = 'new biz'"
C["upsell_leg"] = with_tables(_PVT, revenue_ctes()) + _REVENUE + " WHERE leg = 'upsell'"
C["processing_volume"] = with_tables(_PVT, revenue_ctes()) + _REVENUE
# several upsells: on each day the active ones take their shares in order, each at most what is left of one
C["overlapping_upsells"] = with_tables(_PVT, [
    ("overrides", SPECIAL_DATES),
    ("ups", """
SELECT sales_merchant_id AS merchant, effective_activation_date AS begins, pct_share_of_npv AS share FROM upsells WHERE include = 1
UNION ALL SELECT sales_merchant_id, effective_activation_date + 60, 0.5 FROM upsells WHERE include = 1 AND sales_merchant_id % 3 <> 0
UNION ALL SELECT sales_merchant_id, effective_activation_date + 200, 0.625 FROM upsells WHERE include = 1 AND sales_merchant_id % 9 = 1
UNION ALL SELECT sales_merchant_id, effective_activation_date + 366, 0.25 FROM upsells WHERE include = 1 AND sales_merchant_id % 7 = 5"""),
    ("days", f"""
SELECT p.capture_date AS day, p.sales_merchant_id AS merchant, who.activation_date AS went_live,
  coalesce(o.adjusted_activation_date, who.activation_date) AS reported, sum(p.npv_usd_fixed) * 0.01 AS dollars
FROM payments p JOIN merchants who ON who.merchant_id = p.sales_merchant_id AND who.sales__is_sold
LEFT JOIN overrides o ON o.sales_merchant_id = who.merchant_id
WHERE p.capture_date >= {D(P.history_start)} AND p.capture_date < {D(P.as_of)} GROUP BY ALL"""),
    ("active", """
SELECT d.*, u.begins, CASE WHEN d.day - u.begins BETWEEN 0 AND 365 THEN u.share ELSE 0 END AS wanted,
  coalesce(sum(CASE WHEN d.day - u.begins BETWEEN 0 AND 365 THEN u.share ELSE 0 END)
    OVER (PARTITION BY d.merchant, d.day ORDER BY u.begins, u.share ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
FROM days d JOIN ups u ON u.merchant = d.merchant"""),
    ("given", "SELECT *, greatest(0, least(wanted, 1 - earlier)) AS share FROM active"),
    ("legs", """
SELECT day, merchant, 'upsell' AS leg, begins AS starts, went_live, dollars, sum(share) AS factor FROM given GROUP BY ALL
UNION ALL
SELECT d.day, d.merchant, 'new biz', d.reported, d.went_live, d.dollars,
  CASE WHEN coalesce(d.day - d.went_live BETWEEN 0 AND 365, false) THEN
    CASE WHEN count(g.begins) FILTER (g.begins <= d.day) = 0 THEN 1
         WHEN count(g.begins) FILTER (d.day - g.begins BETWEEN 0 AND 365) > 0 THEN 1 - sum(g.share) ELSE 0 END
  ELSE 0 END
FROM days d LEFT JOIN given g ON g.merchant = d.merchant AND g.day = d.day
GROUP BY d.day, d.merchant, d.reported, d.went_live, d.dollars"""),
]) + f"""
SELECT 'weekly_processing' AS data_type, day AS capture_date, merchant AS sales_merchant_id, leg AS sales_category, starts AS sales_activation_date,
  went_live AS orig_activation, {money('factor * dollars')} AS first_year_sold_npv_usd_fx, {money('dollars')} AS total_npv
FROM legs"""
C["backlog_summary"] = with_tables(_PVT + ["backlog_curve"], backlog_ctes()) + f"""
SELECT merchant AS sales_merchant_id, leg AS sales_category, starts AS sales_activation_date, went_live AS orig_activation,
  days AS days_since_activation, actual AS first_year_npv, {units_money(units('estimate'))} AS first_year_est_npv
FROM estimates"""
C["backlog_curve_expand"] = with_tables(_PVT + ["backlog_curve"], backlog_ctes()) + f"""
SELECT day AS fcst_date, merchant AS sales_merchant_id, leg AS sales_category, starts AS sales_activation_date,
  went_live AS orig_activation, {money('amount')} AS backlog_npv
FROM backlog_days"""
C["pipeline_curve_expand"] = with_tables(PIPELINE_TABLES, deal_ctes()) + f"""
SELECT day AS fcst_date, count(*) AS n_rows, {money('coalesce(sum(amount), 0)')} AS pipeline_npv
FROM deal_days GROUP BY day"""

# ----------------------------------------------------------------------------- report flags
C["new_npv_processing"] = with_tables(_PVT, revenue_ctes()) + f"""
SELECT DISTINCT merchant AS sales_merchant_id, leg AS sales_category, went_live AS orig_activation,
  {flag(f'went_live >= {D(P.fy_start)}')} AS newNPV
FROM revenue"""
C["new_npv_backlog"] = with_tables(_PVT + ["backlog_curve"], backlog_ctes()) + f"""
SELECT merchant AS sales_merchant_id, leg AS sales_category,
  {flag(f'went_live >= {D(P.fy_start)} AND day <= {D(P.fy_end)}')} AS newNPV, count(*) AS n_days
FROM backlog_days GROUP BY ALL"""
C["new_npv_pipeline"] = with_tables(["opportunities", "merchants"], deal_ctes(days=False)) + f"""
SELECT deal AS opportunity, {flag(f"goes_live >= {D(P.fy_start)} AND kind <> 'Existing Customer'")} AS newNPV
FROM deals"""
C["in_quarter_opportunity"] = with_tables(["merchants", "opportunities"], [("special_dates", SPECIAL_DATES),
                                                                           ("first_contact", FIRST_CONTACT)]) + f"""
SELECT m.merchant_id, coalesce(sd.adjusted_activation_date, m.activation_date) AS sales_activation_date,
  fc.first_opportunity_created_date,
  {in_quarter('coalesce(sd.adjusted_activation_date, m.activation_date)', 'fc.first_opportunity_created_date')}
    AS in_quarter_opportunity
FROM merchants m
LEFT JOIN special_dates sd ON sd.sales_merchant_id = m.merchant_id
LEFT JOIN first_contact fc ON fc.sales_merchant_id = m.merchant_id"""


def _cohort(x: str) -> str:
    return f"(CASE WHEN {week_start(x)} = {week_start(D(P.as_of))} THEN 1 ELSE 0 END)"


C["this_week_cohort_flags"] = with_tables(["opportunities"]) + f"""
SELECT opportunity, {_cohort('opportunity_created_date')} AS created_this_week,
  {_cohort('opportunity_close_date')} AS closed_this_week,
  {_cohort('opportunity_expected_go_live_date')} AS live_this_week
FROM opportunities"""

# ----------------------------------------------------------------------------- margin
C["margin_measures"] = with_tables(["margin", "merchants"], [("margin_days", margin_days_sql())]) + (
    "SELECT day AS capture_date, merchant AS sales_merchant_id, starts AS sales_activation_date, "
    f"{', '.join(out for _, out in MARGIN)} FROM margin_days")
C["opportunity_amount_attach"] = with_tables(["merchants", "opportunities"], [("deal_totals", DEAL_TOTALS)]) + f"""
SELECT m.merchant_id, m.sfdc_opportunity, {money('t.opportunity_amount')} AS opportunity_amount
FROM merchants m JOIN deal_totals t ON t.opportunity = m.sfdc_opportunity"""

# ----------------------------------------------------------------------------- enrichment and shaping
C["enrich_country_by_name"] = with_tables(["opportunities", "country_codes"]) + """
SELECT o.opportunity, land.country_code, land.sales_region
FROM opportunities o JOIN country_codes land ON o.opportunity_merchant_country = land.sfdc_country_name"""
C["enrich_country_by_code"] = with_tables(["merchants", "country_codes"]) + """
SELECT m.merchant_id, land.sfdc_country_name, land.sales_region
FROM merchants m JOIN country_codes land ON m.sales__merchant_country = land.country_code"""
C["enrich_team"] = with_tables(["merchants", "team_role"]) + """
SELECT m.merchant_id, m.sales__owner AS owner, seat.role AS sales_role, seat.team AS sales_location
FROM merchants m JOIN team_role seat ON seat.sales_owner = m.sales__owner"""
C["enrich_merchant"] = with_tables(["payments", "merchants"]) + f"""
SELECT p.sales_merchant_id, m.activation_date, count(DISTINCT p.capture_date) AS n_days,
  {money('sum(p.npv_usd_fixed * 0.01)')} AS npv
FROM payments p JOIN merchants m ON p.sales_merchant_id = m.merchant_id
GROUP BY 1, 2"""
C["account_allow_list"] = backlog_daily_sql(only="SELECT sales_merchant_id FROM upsells")
C["opportunity_merchant_key"] = with_tables(["opportunities"]) + (
    "SELECT opportunity, 'OPTI__' || opportunity AS sales_merchant_id FROM opportunities")
C["report_constants"] = with_tables(["country_codes"]) + (
    "SELECT country_code, 'weekly_backlog' AS data_type, '' AS sales_channel, 'opportunity' AS sales_category, "
    "0 AS qtd, 0 AS this_week FROM country_codes")
C["upsell_snapshot_measure"] = with_tables(["payments", "upsells"]) + f"""
SELECT extra.sales_merchant_id, {fweek('pay.capture_date')} AS finance_week,
  {money('sum(pay.npv_usd_fixed * 0.01 * extra.pct_share_of_npv)')} AS npv_fixed_fx
FROM upsells extra JOIN payments pay ON pay.sales_merchant_id = extra.sales_merchant_id
WHERE extra.include = 1 AND pay.capture_date >= {D(P.history_start)}
GROUP BY ALL"""
C["pipeline_eligibility"] = with_tables(["opportunities", "merchants"], [("eligible", eligible_sql())]) + (
    "SELECT opportunity, opportunity_stage, opportunity_expected_go_live_date, activation_date FROM eligible")
C["live_or_not"] = with_tables(["opportunities", "merchants"]) + f"""
SELECT s.opportunity, CASE WHEN m.activation_date < {D(P.as_of)} THEN 1 ELSE 0 END AS live_or_not
FROM opportunities s LEFT JOIN merchants m ON s.merchant_id = m.merchant_id"""
C["days_since_close"] = with_tables(["opportunities"]) + (
    f"SELECT opportunity, {age('opportunity_close_date', D(P.as_of))} AS days_since_close_date FROM opportunities")

# ----------------------------------------------------------------------------- requests
C["week_over_week"] = with_tables(REPORT_TABLES, revenue_ctes() + [
    ("first_seen", FIRST_CONTACT), ("report", processing_select(P.with_(report_start=dt.date(1998, 12, 20)))),
    ("sums", "SELECT region, sub_region, CAST(finance_week AS DATE) AS week, sum(npv_fixed_fx) AS npv FROM report GROUP BY ALL"),
    ("entries", "SELECT region, sub_region, week, npv AS cur, 0 AS prev FROM sums "
                "UNION ALL SELECT region, sub_region, week + 7, 0, npv FROM sums")]) + f"""
SELECT region, sub_region, strftime(week, '%Y-%m-%d') AS finance_week, {money('sum(cur)')} AS npv_fixed_fx,
  {money('sum(prev)')} AS prev_week_npv_fixed_fx, {money('sum(cur) - sum(prev)')} AS wow_change
FROM entries WHERE week BETWEEN {week_start(D(P.report_start))} AND {week_start(D(P.as_of))}
GROUP BY region, sub_region, week"""
C["recently_live"] = with_tables(["merchants", "opportunities", "country_codes", "team_role"], [("deal_totals", DEAL_TOTALS)]) + f"""
SELECT m.merchant_id AS sales_merchant_id, m.activation_date, land.sales_region AS region,
  {sub_region_sql('A', **segment_fields('m.sales__industry'))} AS sub_region, m.sales__owner AS owner, seat.role AS sales_role,
  {money('(SELECT t.opportunity_amount FROM deal_totals t WHERE t.opportunity = m.sfdc_opportunity)')} AS opportunity_amount
{_MSEG}
  AND {D(P.as_of)} - m.activation_date BETWEEN 1 AND 28"""
C["role_as_of"] = deal_signed_sql(where="\n  AND seat.role <> 'AM'")
C["forecast_weighting"] = with_tables(["opportunities"]) + f"""
SELECT opportunity_forecast_category, opportunity_stage, {quarter('opportunity_close_date')} AS close_quarter,
  count(*) AS n_deals,
  {money('''sum(CASE WHEN opportunity_amount >= 1e8 AND opportunity_forecast_category = 'Commit'
                    THEN opportunity_deal_amount * 0.9
                    ELSE opportunity_probability * opportunity_amount * 0.01 END)''')} AS weighted_opportunity_amount
FROM opportunities WHERE opportunity_stage NOT IN ('Lost', 'Duplicate')
GROUP BY 1, 2, 3"""
C["weighted_age_fys"] = with_tables(_PVT, revenue_ctes()) + f"""
SELECT leg AS sales_category, {quarter('day')} AS quarter, {money('sum(first_year)')} AS first_year_npv,
  {units_money(units("CAST(CAST(sum(first_year * (day - starts)) AS DECIMAL(38,4)) AS DOUBLE) / "
                     "NULLIF(CAST(CAST(sum(first_year) AS DECIMAL(38,4)) AS DOUBLE), 0)"))} AS weighted_age_days
FROM revenue
WHERE day >= {D(P.report_start)} AND day - starts BETWEEN 0 AND 365
GROUP BY ALL"""

SQL.update(C)

SQL["ninety_day_forecast_by_team"] = with_tables(REPORT_TABLES + ["pipeline_curve"], report_ctes() + deal_ctes()) + f"""
SELECT data_type, sales_role, sales_location, {money('sum(npv_fixed_fx)')} AS npv_fixed_fx
FROM ({pipeline_select()}
UNION ALL
{backlog_select()}
) r
WHERE ninety_day_live = 1
GROUP BY ALL"""

SQL["expected_end_date"] = with_tables(REPORT_TABLES, backlog_ctes()) + f"""
SELECT b.merchant AS sales_merchant_id, o.backlog_end_date,
  {money('coalesce(sum(b.amount) FILTER (b.day >= o.backlog_end_date), 0)')} AS backlog_after_end,
  {money('coalesce(sum(b.amount), 0)')} AS backlog_total
FROM backlog_days b JOIN overrides o ON o.sales_merchant_id = b.merchant AND o.backlog_end_date IS NOT NULL
GROUP BY ALL"""

# R-6: one table per date, looked up by the latest date that is not later
def uploaded_roles(n: int) -> str:
    return f"""
SELECT s_name AS sales_owner,
  CASE (s_suppkey + (s_suppkey % 4 + {n}) // 3) % 5 WHEN 0 THEN 'NBA' WHEN 1 THEN 'AM' ELSE 'AE' END AS role,
  CASE WHEN (s_suppkey + {n} // 4) % 2 = 0 THEN 'Hub' ELSE 'In-country' END AS team, {D(ROLE_DATES[n])} AS snapshot_date
FROM supplier WHERE s_suppkey % 10 <> 9 AND NOT (s_suppkey % 17 = 5 AND s_suppkey % 5 >= {n}) AND NOT (s_suppkey % 13 = 7 AND {n} % 3 = 2)"""


_UPLOADED = "\nUNION ALL\n".join(uploaded_roles(n) for n in range(len(ROLE_DATES)))
ROLE_TABLES = with_tables(["merchants", "opportunities", "team_role"], [
    ("history", f"{_UPLOADED}\nUNION ALL\nSELECT sales_owner, role, team, {D(P.as_of)} FROM ({ROLE_FIX}\n) fixed"),
    ("dates", "SELECT DISTINCT snapshot_date FROM history"),
    # every owner on every date, with what the table of that date says, and on how many dates it changed up to then
    ("told", """
SELECT o.sales_owner, d.snapshot_date, h.sales_owner IS NOT NULL AS listed, h.role, h.team
FROM (SELECT DISTINCT sales_owner FROM history) o CROSS JOIN dates d
LEFT JOIN history h ON h.sales_owner = o.sales_owner AND h.snapshot_date = d.snapshot_date"""),
    ("counted", """
SELECT *, sum(CAST((listed, role, team) IS DISTINCT FROM before AS INTEGER)) OVER (PARTITION BY sales_owner ORDER BY snapshot_date) AS part
FROM (SELECT *, lag((listed, role, team)) OVER (PARTITION BY sales_owner ORDER BY snapshot_date) AS before FROM told)"""),
    ("spans", """
SELECT sales_owner, any_value(role) AS role, any_value(team) AS team, min(snapshot_date) AS valid_from,
  CAST((SELECT min(snapshot_date) FROM dates WHERE snapshot_date > max(c.snapshot_date)) - 1 AS DATE) AS valid_to
FROM counted c WHERE listed GROUP BY sales_owner, part"""),
])
SQL["role_intervals"] = ROLE_TABLES + "SELECT * FROM spans"
SQL["deal_roles_as_of_close"] = ROLE_TABLES + """
SELECT o.opportunity, o.opportunity_owner, o.opportunity_close_date, h.role, h.team, p.valid_from, p.valid_to
FROM opportunities o
LEFT JOIN LATERAL (SELECT max(snapshot_date) AS day FROM dates WHERE snapshot_date <= o.opportunity_close_date) s ON true
LEFT JOIN history h ON h.sales_owner = o.opportunity_owner AND h.snapshot_date = s.day
LEFT JOIN spans p ON p.sales_owner = h.sales_owner AND s.day BETWEEN p.valid_from AND coalesce(p.valid_to, s.day)"""

# R-2 between two stored snapshots: every row of either side beside its like of the other
_THEN = P.shifted(-10).as_of
_NAMES = ["npv_fixed_fx", "region", "country", "sub_region", "vertical", "owner", "sales_role", "sales_location", "merchant_name"]
_CHANGED = ", ".join(f"CASE WHEN old.{c} IS DISTINCT FROM new.{c} THEN '{c}' END" for c in _NAMES)
_KEYS = ["sales_merchant_id", "year", "quarter", "finance_week", "activation_date", "ninety_day_live", "first_year_sold"]
SQL["snapshot_changes"] = with_tables(["payments", "merchants", "country_codes", "team_role"], [
    ("roles_then", uploaded_roles(max(n for n, d in enumerate(ROLE_DATES) if d <= _THEN))),
    ("old", weekly_snapshot_sql(as_of=_THEN).replace("team_role seat", "roles_then seat")),
    ("new", weekly_snapshot_sql()),
    ("paired", f"""
SELECT {", ".join(f"coalesce(new.{k}, old.{k}) AS {k}" for k in _KEYS)},
  CASE WHEN old.snapshot_date IS NULL THEN 'added' WHEN new.snapshot_date IS NULL THEN 'gone' ELSE 'restated' END AS status,
  concat_ws(',', {_CHANGED}) AS changed, old.npv_fixed_fx AS npv_fixed_fx_before, new.npv_fixed_fx AS npv_fixed_fx_after
FROM old FULL JOIN new ON {" AND ".join(f"old.{k} IS NOT DISTINCT FROM new.{k}" for k in _KEYS)}"""),
]) + """
SELECT * REPLACE (CASE WHEN status = 'restated' THEN changed ELSE '' END AS changed, CAST(npv_fixed_fx_before AS DECIMAL(28,4)) AS npv_fixed_fx_before,
                  CAST(npv_fixed_fx_after AS DECIMAL(28,4)) AS npv_fixed_fx_after),
  CAST(coalesce(npv_fixed_fx_after, 0) - coalesce(npv_fixed_fx_before, 0) AS DECIMAL(29,4)) AS npv_fixed_fx_change
FROM paired WHERE status <> 'restated' OR changed <> ''"""

# uploads: the lists as they are staged, and the one bad line at the end of each file
SQL["report_from_uploads"] = SQL["processing_and_backlog_report"]
_BAD = [("country_codes", "99,,Nowhere,New Markets", "country_code is empty"), ("team_role", "Supplier#0,AE", "not 3 fields"),
        ("upsells", "3,1999-13-01,0.2500,1", "effective_activation_date: ''1999-13-01'' is no date"),
        ("backlog_curve", "366,-0.5,1.0", "first_year_sold_pct: -0.5 is not within 0 and 1"),
        ("pipeline_curve", "0,0.5", "day_count: 0 stands in line 2 already")]
SQL["rejected_uploads"] = with_tables([n for n, _, _ in _BAD]) + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS list, {D(P.shifted(-1).as_of)} AS upload_date, CAST((SELECT count(*) FROM {n}) + 2 AS INTEGER) AS line, '{r}' AS record, '{why}' AS reason"
    for n, r, why in _BAD)

# role edits: the last of each owner over the upload of the week before
SQL["edited_roles"] = with_tables([], [
    ("before", uploaded_roles(len(ROLE_DATES) - 1)),
    ("edits", """
SELECT s_suppkey * 10 + e.step AS seq, e.action, s_name AS owner, e.role, e.team
FROM supplier JOIN (VALUES (6, 0, 1, 'remove', NULL, NULL), (12, 0, 2, 'add', 'NBA', 'Hub'), (9, 0, 3, 'add', 'AM', 'In-country'),
  (18, 0, 4, 'add', 'AE', 'Hub'), (10, 9, 5, 'add', 'AE', 'In-country'), (14, 9, 6, 'remove', NULL, NULL)) e(m, rest, step, action, role, team)
  ON s_suppkey % e.m = e.rest"""),
    ("latest", "SELECT owner, arg_max(action, seq) AS action, max_by({'r': role, 't': team}, seq) AS said FROM edits GROUP BY owner"),
]) + f"""
SELECT coalesce(l.owner, b.sales_owner) AS sales_owner, CASE WHEN l.owner IS NULL THEN b.role ELSE l.said.r END AS role,
  CASE WHEN l.owner IS NULL THEN b.team ELSE l.said.t END AS team, {D(P.as_of)} AS snapshot_date
FROM before b FULL JOIN latest l ON l.owner = b.sales_owner WHERE coalesce(l.action, 'add') = 'add'"""

# data checks
_LOST = "count(*) FILTER (land.country_code IS NULL) AS a, count(*) FILTER (seat.sales_owner IS NULL) AS b, " \
        "count(*) FILTER (land.country_code IS NOT NULL AND seat.sales_owner IS NOT NULL) AS c"
SQL["data_checks"] = with_tables(REPORT_TABLES, report_ctes() + [
    ("m", f"""SELECT count(*) AS n, {_LOST} FROM merchants who LEFT JOIN country_codes land ON land.country_code = who.sales__merchant_country
LEFT JOIN team_role seat ON seat.sales_owner = who.sales__owner"""),
    ("d", f"""SELECT count(*) AS n, {_LOST} FROM opportunities o LEFT JOIN country_codes land ON land.sfdc_country_name = o.opportunity_merchant_country
LEFT JOIN team_role seat ON seat.sales_owner = o.opportunity_owner WHERE o.opportunity_stage NOT IN ('Lost', 'Duplicate')"""),
    ("e", "SELECT count(*) AS n, count(*) FILTER (estimate IS NULL) AS a, coalesce(sum(actual) FILTER (estimate IS NULL), 0) AS x FROM estimates"),
]) + "\nUNION ALL\n".join(
    f"SELECT '{subject}' AS subject, '{name}' AS check_name, CAST({n} AS BIGINT) AS n, {money(x)} AS amount FROM {cte}"
    for subject, cte, counters in (("merchants", "m", (("rows", "n"), ("without_country", "a"), ("without_owner", "b"), ("kept", "c"))),
                                   ("deals", "d", (("rows", "n"), ("without_country", "a"), ("without_owner", "b"), ("kept", "c"))),
                                   ("backlog", "e", (("rows", "n"), ("no_estimate", "a"), ("no_estimate_npv", "x"))))
    for name, n, x in [(name, "NULL" if c == "x" else c, c if c == "x" else "NULL") for name, c in counters])
