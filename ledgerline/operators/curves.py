"""Annualising and spreading revenue over day-offset curves.

A curve is a small table keyed by day offset.  Expansion generates the
needed offsets per row with ``explode(sequence(lo, hi))`` and finds the
curve share with an equi-join, so the plan is a hash join (broadcast when
the curve passes the size check) instead of a nested-loop range join.  The
number of generated rows per input row is bounded by the curve length
(366), not by the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions.measures import curve_share, to_units, units_to_money
from .dims import DEFAULT_MAX_ROWS, small_dimension

CURVE_MAX_ROWS = 10_000


def backlog_summary(pv: DataFrame, curve: DataFrame, as_of: dt.date,
                    keys=("sales_merchant_id", "sales_category", "sales_activation_date", "orig_activation")) -> DataFrame:
    """Actual first-year NPV to date and full-year estimate per merchant and category.

    estimate = actual / cumulative curve share at the age on the report
    date (NULL when that share is 0); only positive actuals are kept; ages
    missing from the curve drop out.
    """
    c = small_dimension(curve.select("days_since_activation", "first_year_sold_cumulative_pct"),
                        "days_since_activation", CURVE_MAX_ROWS, "backlog_curve")
    summary = (
        pv.groupBy(*keys)
        .agg(F.sum("first_year_sold_npv_usd_fx").cast("decimal(18,4)").alias("first_year_npv"))
        .withColumn("days_since_activation", F.datediff(F.lit(as_of), F.col("sales_activation_date")))
        .filter(F.col("first_year_npv") > 0)
    )
    return summary.join(c, "days_since_activation").select(
        *keys, "days_since_activation", "first_year_npv",
        F.try_divide(F.col("first_year_npv").cast("double"), F.col("first_year_sold_cumulative_pct"))
        .alias("first_year_est_npv"),
    )


def expand_backlog(summary: DataFrame, curve: DataFrame, last_day: int = 365) -> DataFrame:
    """One row per remaining day from the current age to ``last_day``.

    ``backlog_amount`` is the day's exact amount, to be summed before it is rounded.
    """
    c = small_dimension(curve.select(F.col("days_since_activation").alias("day"), "first_year_sold_pct"),
                        None, CURVE_MAX_ROWS, "backlog_curve")
    age = F.col("days_since_activation")
    rows = summary.filter(age.between(0, last_day)).withColumn("day", F.explode(F.sequence(age, F.lit(last_day))))
    return rows.join(c, "day").select(
        *[x for x in summary.columns if x not in ("first_year_npv",)],
        F.date_add(F.col("sales_activation_date"), F.col("day")).alias("fcst_date"),
        (units_to_money(to_units("first_year_est_npv")) * curve_share("first_year_sold_pct")).alias("backlog_amount"),
    )


def cumulative_shares(curve: DataFrame, last_day: int = 365) -> DataFrame:
    """Running sums of a curve: one row per day from -1 to ``last_day`` with the shares and the curve days up to it.

    What a span of days earns is then the difference of two rows.  Shares are
    exact decimals, so a difference of sums equals the sum over the span.  Each
    curve day is counted for every later day, a table bounded by the curve.
    """
    day = F.col("days_since_activation")
    own = curve.filter(day.between(0, last_day)).select(day.alias("own"), curve_share("first_year_sold_pct").alias("share"))
    start = curve.sparkSession.range(1).select(F.lit(-1).alias("day"), F.lit(0).cast("decimal(14,12)").alias("share"), F.lit(0).alias("n"))
    until = own.select(F.explode(F.sequence("own", F.lit(last_day))).alias("day"), "share", F.lit(1).alias("n"))
    # days that the curve lacks still stand in the table, with the sums so far
    every = curve.sparkSession.range(last_day + 1).select(F.col("id").cast("int").alias("day"), F.lit(0).cast("decimal(14,12)").alias("share"), F.lit(0).alias("n"))
    sums = start.unionByName(every).unionByName(until).groupBy("day").agg(
        F.sum("share").cast("decimal(16,12)").alias("share_until"), F.sum("n").cast("int").alias("days_until"))
    return sums


def backlog_spans(summary: DataFrame, sums: DataFrame, cuts: list[Column], weeks: bool = False, first: dt.date | None = None,
                  last_day: int = 365) -> DataFrame:
    """Remaining first-year revenue per merchant, category and span of days, without a row per day.

    A row's days from its current age to ``last_day`` (from ``first`` on, if
    given) are cut at each date of ``cuts`` (columns over ``summary``; NULLs cut
    nothing) and, with ``weeks``, at finance weeks and quarters.  Flags that
    change on those dates only are constant in a span.  Columns: those of the
    summary, ``span_start``, ``span_end``, ``n_days`` and the exact
    ``backlog_amount``: the estimate times the difference of two running sums
    (``cumulative_shares``).  Spans without a day of the curve drop out.
    """
    s = small_dimension(sums, "day", CURVE_MAX_ROWS, "curve sums")
    age, act = F.col("days_since_activation"), F.col("sales_activation_date")
    begin = F.date_add(act, age) if first is None else F.greatest(F.date_add(act, age), F.lit(first))
    rows = summary.filter(age.between(0, last_day)).select(
        "*", *[c.alias(f"_cut{i}") for i, c in enumerate(cuts)], begin.alias("_from"), F.date_add(act, last_day).alias("_to"))
    rows = rows.filter(F.col("_from") <= F.col("_to"))
    points = [F.col(f"_cut{i}") for i in range(len(cuts))]
    if weeks:
        week = F.explode(F.sequence(P.finance_week_start("_from"), F.col("_to"), F.expr("INTERVAL 7 DAYS")))
        rows = rows.withColumn("_week", week).select(
            *[c for c in rows.columns if c not in ("_from", "_to")], F.greatest("_from", "_week").alias("_from"),
            F.least(F.col("_to"), F.date_add("_week", 6)).alias("_to"))
        points.append(F.trunc("_to", "quarter"))  # a week meets one quarter start at most
    # the starts of the spans: the first day, and each cut behind it that no earlier one of the list names
    starts = [F.col("_from")]
    for i, c in enumerate(points):
        inside = (c > F.col("_from")) & (c <= F.col("_to"))
        for other in points[:i]:
            inside = inside & ~F.coalesce(c == other, F.lit(False))
        starts.append(F.when(inside, c))
    spans = rows.select("*", F.array(*starts).alias("_starts")).select("*", F.explode("_starts").alias("span_start")).filter(F.col("span_start").isNotNull())
    after = [F.when(c > F.col("span_start"), F.date_sub(c, 1)) for c in points]
    spans = spans.select(*summary.columns, "span_start", F.least(F.col("_to"), *after).alias("span_end") if after else F.col("_to").alias("span_end"))
    lo = s.select(F.col("day").alias("_lo"), F.col("share_until").alias("_share_lo"), F.col("days_until").alias("_days_lo"))
    hi = s.select(F.col("day").alias("_hi"), F.col("share_until").alias("_share_hi"), F.col("days_until").alias("_days_hi"))
    joined = (spans.join(lo, F.datediff("span_start", "sales_activation_date") - 1 == F.col("_lo"))
              .join(hi, F.datediff("span_end", "sales_activation_date") == F.col("_hi")))
    share = (F.col("_share_hi") - F.col("_share_lo")).cast("decimal(16,12)")
    return joined.select(
        *[c for c in summary.columns if c != "first_year_npv"], "span_start", "span_end",
        (F.col("_days_hi") - F.col("_days_lo")).alias("n_days"),
        (units_to_money(to_units("first_year_est_npv")) * share).alias("backlog_amount"),
    ).filter(F.col("n_days") > 0)


def expand_pipeline(pipe: DataFrame, curve: DataFrame, first: int = 0, last: int = 364,
                    start_col: str = "opportunity_expected_go_live_date", amount_col: str = "expected_amount") -> DataFrame:
    """One row per curve day ``first..last`` after the expected go-live date.

    ``pipeline_amount`` is the exact amount x daily share, to be summed before it is rounded.
    """
    c = curve.select("day_count", "first_year_sold_pct").filter(F.col("day_count").between(first, last))
    c = small_dimension(c, None, CURVE_MAX_ROWS, "pipeline_curve")
    rows = pipe.withColumn("day_count", F.explode(F.sequence(F.lit(first), F.lit(last))))
    return rows.join(c, "day_count").select(
        *pipe.columns,
        F.date_add(F.col(start_col), F.col("day_count")).alias("fcst_date"),
        (F.col(amount_col) * curve_share("first_year_sold_pct")).alias("pipeline_amount"),
    )


def curve_weeks(curve: DataFrame, first_start: dt.date, last_start: dt.date, first: int = 0, last: int = 364) -> DataFrame:
    """Curve shares summed per start date, week and flag value: what a deal of a given start earns in each week.

    One row per (start, week, quarter, ninety_day_live, first_year_sold) with
    the exact ``share``; its size depends on the dates and the curve alone.
    """
    c = curve.filter(F.col("day_count").between(first, last))
    c = small_dimension(c.select("day_count", curve_share("first_year_sold_pct").alias("share")), "day_count", CURVE_MAX_ROWS, "pipeline_curve")
    starts = curve.sparkSession.range((last_start - first_start).days + 1).select(
        F.date_add(F.lit(first_start), F.col("id").cast("int")).alias("start"))
    days = starts.withColumn("day_count", F.explode(F.sequence(F.lit(first), F.lit(last)))).join(c, "day_count")
    d = F.date_add("start", F.col("day_count"))
    weeks = days.groupBy("start", *P.week_bucket_keys(d), P.ninety_day_live("start", d).alias("ninety_day_live"),
                         P.first_year_sold("start", d).alias("first_year_sold")).agg(F.sum("share").cast("decimal(16,12)").alias("share"))
    return small_dimension(weeks, None, DEFAULT_MAX_ROWS, "curve weeks")


def backlog_checks(summary: DataFrame) -> DataFrame:
    """One row of data checks on a backlog summary.

    ``rows``: (merchant, category) rows annualised; ``no_estimate``: rows
    whose cumulative curve share on the report date is 0, so the estimate is
    NULL and their backlog is missing from the reports; ``no_estimate_npv``:
    the actual first-year NPV of those rows.
    """
    missing = F.col("first_year_est_npv").isNull()
    return summary.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(missing, F.lit(1))).alias("no_estimate"),
        F.coalesce(F.sum(F.when(missing, F.col("first_year_npv"))), F.lit(0)).cast("decimal(18,4)").alias("no_estimate_npv"),
    )
