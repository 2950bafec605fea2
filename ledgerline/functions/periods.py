"""Period labels and date flags (Column -> Column, all JVM-side built-ins).

Finance weeks start on Sunday and are labelled by that Sunday.  Ages are
whole calendar days (``datediff`` on DATE values).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import ReportParams

_FORMATS = {"year": "yyyy", "quarter": "yyyy-MM", "month": "yyyy-MM", "day": "yyyy-MM-dd"}


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, (dt.date, dt.datetime)):
        return F.lit(c)
    return F.col(c)


def finance_week_start(d) -> Column:
    """Sunday on or before ``d`` (DATE)."""
    return F.date_sub(F.next_day(_col(d), "Sun"), 7)


def finance_week(d) -> Column:
    """Finance week label ``yyyy-MM-dd`` of the Sunday starting the week of ``d``."""
    return F.date_format(finance_week_start(d), "yyyy-MM-dd")


def period_start(d, unit: str) -> Column:
    """First day of the year / quarter / month of ``d`` (DATE)."""
    return F.trunc(_col(d), unit)


def period_label(d, unit: str) -> Column:
    """``yyyy`` for a year; ``yyyy-MM`` of the first month for a quarter or a month."""
    if unit == "week":
        return finance_week(d)
    return F.date_format(period_start(d, unit), _FORMATS[unit])


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def qtd_flag(d, as_of: dt.date) -> Column:
    """1 when ``d`` falls in the quarter of the report date."""
    return _flag(period_start(d, "quarter") == period_start(as_of, "quarter"))


def this_week_flag(d, as_of: dt.date, lag_days: int = 3) -> Column:
    """1 when ``d`` is in the finance week of ``as_of - lag_days``."""
    return _flag(finance_week_start(d) == finance_week_start(F.lit(as_of - dt.timedelta(days=lag_days))))


def month_flags(d, as_of: dt.date) -> tuple[Column, Column, Column]:
    """(mtd, this_month, true_mtd).

    ``mtd`` keeps the report's behaviour of comparing quarters, ``this_month``
    is the constant 0 it emits, ``true_mtd`` compares months.
    """
    mtd = _flag(period_start(d, "quarter") == period_start(as_of, "quarter"))
    true_mtd = _flag(period_start(d, "month") == period_start(as_of, "month"))
    return mtd, F.lit(0), true_mtd


def days_since(act, d) -> Column:
    """Whole days from ``act`` to ``d`` (negative when ``d`` is earlier)."""
    return F.datediff(_col(d), _col(act))


def _age_flag(act, d, last_day: int, end=None) -> Column:
    age = days_since(act, d)
    inside = (age >= 0) & (age <= last_day)
    if end is None:
        return _flag(inside)
    ended = _col(end).isNotNull() & (F.datediff(_col(d), _col(end)) >= 0)
    return F.when(ended, F.lit(0)).when(inside, F.lit(1)).otherwise(F.lit(0))


def ninety_day_live(act, d, end=None) -> Column:
    """1 when ``d`` is 0..90 days after activation (and before the end date, if given)."""
    return _age_flag(act, d, 90, end)


def first_year_sold(act, d, end=None) -> Column:
    """1 when ``d`` is 0..365 days after activation (366 days; before the end date, if given)."""
    return _age_flag(act, d, 365, end)


def in_first_year(act, d) -> Column:
    """Boolean form of the first-year test, for conditional sums."""
    age = days_since(act, d)
    return (age >= 0) & (age < 366)


def new_npv(act, p: ReportParams, fcst=None, opp_type=None) -> Column:
    """New-NPV flag.

    processing: original activation on or after the fiscal-year start;
    backlog: and the forecast day on or before the fiscal-year end;
    pipeline (``opp_type`` given): go-live on or after the fiscal-year start
    and type other than 'Existing Customer' (a NULL type gives 0).
    """
    cond = _col(act) >= F.lit(p.fy_start)
    if fcst is not None:
        cond = cond & (_col(fcst) <= F.lit(p.fy_end))
    if opp_type is not None:
        cond = cond & (_col(opp_type) != F.lit("Existing Customer"))
    return _flag(cond)


def in_quarter(act, first_created, as_of: dt.date, lag_days: int = 5) -> Column:
    """1 when activation and first opportunity both fall in the quarter of ``as_of - lag_days``."""
    q = period_start(F.lit(as_of - dt.timedelta(days=lag_days)), "quarter")
    return _flag((period_start(act, "quarter") == q) & (period_start(first_created, "quarter") == q))


def cohort_flag(d, as_of: dt.date) -> Column:
    """1 when ``d`` is in the finance week of the report date."""
    return _flag(finance_week_start(d) == finance_week_start(F.lit(as_of)))


# Grouping on period *dates* and formatting labels afterwards keeps string
# formatting off the per-row path: labels are computed once per group.
WEEK_KEY = "_week_start"
QUARTER_KEY = "_quarter_start"
MONTH_KEY = "_month_start"


def week_bucket_keys(d) -> list[Column]:
    """Group keys that split rows exactly as (year, quarter, finance_week) labels do."""
    return [finance_week_start(d).alias(WEEK_KEY), period_start(d, "quarter").alias(QUARTER_KEY)]


def week_bucket_labels(as_of: dt.date | None = None, lag_days: int = 3) -> list[Column]:
    """year / quarter / finance_week labels (and qtd / this_week when ``as_of`` is given) from the bucket keys."""
    w, q = F.col(WEEK_KEY), F.col(QUARTER_KEY)
    out = [F.date_format(q, "yyyy").alias("year"), F.date_format(q, "yyyy-MM").alias("quarter"),
           F.date_format(w, "yyyy-MM-dd").alias("finance_week")]
    if as_of is not None:
        out += [_flag(q == period_start(F.lit(as_of), "quarter")).alias("qtd"),
                _flag(w == finance_week_start(F.lit(as_of - dt.timedelta(days=lag_days)))).alias("this_week")]
    return out


def month_bucket_keys(d) -> list[Column]:
    """Group keys that split rows exactly as (year, quarter, month) labels do."""
    return [period_start(d, "month").alias(MONTH_KEY), period_start(d, "quarter").alias(QUARTER_KEY)]


def month_bucket_labels(as_of: dt.date) -> list[Column]:
    """year / quarter / month labels, ``mtd`` (quarter test), ``month_to_date`` (month test)."""
    m, q = F.col(MONTH_KEY), F.col(QUARTER_KEY)
    return [F.date_format(q, "yyyy").alias("year"), F.date_format(q, "yyyy-MM").alias("quarter"),
            F.date_format(m, "yyyy-MM").alias("month"),
            _flag(q == period_start(F.lit(as_of), "quarter")).alias("mtd"),
            _flag(m == period_start(F.lit(as_of), "month")).alias("month_to_date")]
