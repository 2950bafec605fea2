"""DuckDB staging of the report tables (same expressions as ledgerline.sources.fixtures).

Each staged table is a CTE written ``AS MATERIALIZED``; ``with_tables``
prepends the CTEs a query needs, in dependency order.
"""

from __future__ import annotations

from ledgerline.sources.fixtures import (
    COUNTRIES,
    INDUSTRIES,
    OPPORTUNITY_TYPES,
    STAGE_PROBABILITIES,
    STAGES,
)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pick(values, idx_sql: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(v) if isinstance(v, str) else v}" for i, v in enumerate(values))
    return f"(CASE {idx_sql} {whens} END)"


_COUNTRY_ROWS = ", ".join(f"({n}, {q(c)}, {q(name)}, {q(r)})" for n, c, name, r in COUNTRIES)

CREATED = ("(CASE WHEN o.o_custkey % 29 = 0 THEN DATE '1999-10-01' + CAST(o.o_orderkey % 80 AS INTEGER) "
           "WHEN o.o_custkey % 31 = 0 THEN DATE '2000-01-02' + CAST(o.o_orderkey % 45 AS INTEGER) ELSE CAST(o.o_orderdate AS DATE) END)")
AMOUNT = "CAST(round(o.o_totalprice, 2) AS DECIMAL(14,2)) * CASE WHEN o.o_orderkey % 101 = 0 THEN 1000 ELSE 1 END"

STAGING = {
    "country_codes": f"""
SELECT m.nation_key, m.country_code, m.sfdc_country_name, m.sales_region
FROM nation n
JOIN (VALUES {_COUNTRY_ROWS}) AS m(nation_key, country_code, sfdc_country_name, sales_region)
  ON n.n_nationkey = m.nation_key""",
    "payments": """
SELECT CAST(l.l_shipdate AS DATE) AS capture_date,
       o.o_custkey AS sales_merchant_id,
       CAST(round(l.l_extendedprice * (1 - l.l_discount) * 100) AS BIGINT) AS npv_usd_fixed
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "margin": """
SELECT CAST(l.l_shipdate AS DATE) AS capture_date,
       o.o_custkey AS sales_merchant_id,
       CAST(round(l.l_extendedprice * (1 - l.l_discount) * 100) AS BIGINT) AS npv,
       CAST(round(l.l_extendedprice * 100) AS BIGINT) AS revenue_total,
       CAST(round(l.l_extendedprice * l.l_discount * 100) AS BIGINT) AS costs_total,
       CAST(round(l.l_extendedprice * l.l_tax * 100) AS BIGINT) AS revenue_fx,
       CASE WHEN l.l_returnflag = 'R' THEN CAST(round(l.l_quantity * 100) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS revenue_disputes,
       CASE WHEN l.l_linestatus = 'O' THEN CAST(round(l.l_quantity * 10) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS revenue_other_api
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "merchants": f"""
SELECT c.c_custkey AS merchant_id,
       c.c_name AS sales__name,
       {pick(INDUSTRIES, 'c.c_custkey % 25')} AS sales__industry,
       cc.country_code AS sales__merchant_country,
       s.s_name AS sales__owner,
       c.c_acctbal > 0 AS sales__is_sold,
       CASE WHEN c.c_custkey % 11 = 0 THEN NULL
            WHEN c.c_custkey % 29 = 0 THEN DATE '1999-10-01' + CAST(c.c_custkey % 90 AS INTEGER)
            ELSE DATE '1996-01-01' + CAST((c.c_custkey * 7919) % 1461 AS INTEGER) END AS activation_date,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE CAST(fo.min_orderkey AS VARCHAR) END AS sfdc_opportunity
FROM customer c
LEFT JOIN country_codes cc ON c.c_nationkey = cc.nation_key
LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey % (SELECT count(*) FROM supplier)
LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS min_orderkey FROM orders GROUP BY o_custkey) fo
  ON fo.o_custkey = c.c_custkey""",
    "opportunities": f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS opportunity,
       'Opp#' || CAST(o.o_orderkey AS VARCHAR) AS opportunity_name,
       s.s_name AS opportunity_owner,
       {pick(STAGES, 'o.o_orderkey % 9')} AS opportunity_stage,
       CAST(CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE {pick(STAGE_PROBABILITIES, 'o.o_orderkey % 9')} END AS INTEGER)
         AS opportunity_probability,
       CASE WHEN o.o_orderkey % 53 = 0 THEN NULL ELSE CAST({AMOUNT} AS DECIMAL(18,2)) END AS opportunity_amount,
       {pick(OPPORTUNITY_TYPES, 'o.o_orderkey % 3')} AS opportunity_type,
       {pick(INDUSTRIES, 'o.o_orderkey % 25')} AS opportunity_industry,
       cc.sfdc_country_name AS opportunity_merchant_country,
       {CREATED} AS opportunity_created_date,
       {CREATED} + CAST(o.o_orderkey % 60 AS INTEGER) AS opportunity_close_date,
       {CREATED} + CAST(30 + o.o_orderkey % 120 AS INTEGER) AS opportunity_expected_go_live_date,
       CASE WHEN o.o_orderkey % 4 = 0 THEN o.o_custkey END AS merchant_id,
       o.o_custkey AS parent_merchant_id,
       CASE WHEN o.o_orderkey % 200 = 0 THEN DATE '2000-01-02' + CAST(o.o_orderkey % 365 AS INTEGER) END
         AS opportunity_expected_end_date,
       CASE WHEN o.o_orderkey % 250 = 0 THEN DATE '1999-03-01' + CAST(o.o_orderkey % 300 AS INTEGER) END
         AS opportunity_override_activation_date,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Commit' WHEN '2-HIGH' THEN 'Best Case' ELSE 'Pipeline' END
         AS opportunity_forecast_category,
       CASE WHEN o.o_orderkey % 53 = 0 THEN NULL ELSE CAST({AMOUNT} AS DECIMAL(18,2)) END AS opportunity_deal_amount
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 40 = 0) o
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN country_codes cc ON c.c_nationkey = cc.nation_key
LEFT JOIN supplier s ON s.s_suppkey = o.o_orderkey % (SELECT count(*) FROM supplier)""",
    "team_role": """
SELECT s_name AS sales_owner,
       CASE WHEN s_suppkey % 5 = 0 THEN 'NBA' WHEN s_suppkey % 5 = 1 THEN 'AM' ELSE 'AE' END AS role,
       CASE WHEN s_suppkey % 2 = 0 THEN 'Hub' ELSE 'In-country' END AS team
FROM supplier WHERE s_suppkey % 10 <> 9""",
    "upsells": """
SELECT merchant_id AS sales_merchant_id,
       activation_date + 120 AS effective_activation_date,
       CAST((merchant_id % 7 + 1) * 0.0625 AS DECIMAL(5,4)) AS pct_share_of_npv,
       CASE WHEN merchant_id % 20 = 3 THEN 1 ELSE 0 END AS include
FROM merchants WHERE merchant_id % 10 = 3 AND activation_date IS NOT NULL""",
    "backlog_curve": """
SELECT CAST(d AS INTEGER) AS days_since_activation,
       CAST(366 - d AS DOUBLE) / 67161 AS first_year_sold_pct,
       CAST((d + 1) * 366 - d * (d + 1) // 2 AS DOUBLE) / 67161 AS first_year_sold_cumulative_pct
FROM range(366) AS t(d)""",
    "pipeline_curve": """
SELECT CAST(d AS INTEGER) AS day_count, CAST(366 - d AS DOUBLE) / 67161 AS first_year_sold_pct
FROM range(365) AS t(d)""",
}

DEPENDS = {"merchants": ["country_codes"], "opportunities": ["country_codes"], "upsells": ["merchants"]}
ORDER = ["country_codes", "payments", "margin", "merchants", "opportunities", "team_role", "upsells",
         "backlog_curve", "pipeline_curve"]


def _closure(names) -> list[str]:
    need = set()

    def add(n):
        if n in need:
            return
        for d in DEPENDS.get(n, []):
            add(d)
        need.add(n)

    for n in names:
        add(n)
    return [n for n in ORDER if n in need]


def with_tables(tables, ctes: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause for the staged ``tables`` plus extra (name, sql) CTEs."""
    parts = [f"{n} AS MATERIALIZED ({STAGING[n]}\n)" for n in _closure(tables)]
    for name, sql in ctes or []:
        parts.append(f"{name} AS MATERIALIZED ({sql}\n)")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


def staged_table_sql(name: str) -> str:
    return with_tables([name]) + f"SELECT * FROM {name}"
