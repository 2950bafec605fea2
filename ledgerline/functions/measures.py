"""Money measures and exact fixed-point helpers.

Money enters in integer cents and leaves as ``DECIMAL(18,4)`` dollars.
Sums stay in exact integer / decimal arithmetic.  Where a DOUBLE curve share
multiplies an amount, the share is taken as a decimal of twelve places and
the exact products are summed; only the total is rounded, so it never depends
on partition order or executor count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
UNITS_PER_DOLLAR = 10_000  # fixed-point unit: 1e-4 dollar


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents_to_dollars(cents) -> Column:
    """Exact decimal dollars from integer cents (the reports' ``x / 100``)."""
    return _col(cents).cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")


def money(c) -> Column:
    """Final money type of every report column."""
    return _col(c).cast(MONEY)


def to_units(amount) -> Column:
    """Round a DOUBLE dollar amount to integer 1e-4 units (half away from zero)."""
    return F.round(_col(amount) * F.lit(float(UNITS_PER_DOLLAR))).cast("bigint")


def curve_share(share) -> Column:
    """A DOUBLE curve share as an exact decimal, so that sums of amount x share do not depend on their order."""
    return _col(share).cast("decimal(14,12)")


def units_to_money(units) -> Column:
    """Integer 1e-4 units back to ``DECIMAL(18,4)`` dollars."""
    return (_col(units).cast("decimal(20,0)") / F.lit(UNITS_PER_DOLLAR).cast("decimal(6,0)")).cast(MONEY)


def weighted_amount(prob, amount) -> Column:
    """``probability * amount / 100`` in exact decimals."""
    return (_col(prob).cast("decimal(5,0)") * _col(amount).cast("decimal(18,2)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def forecast_weighted_amount(amount, prob, category, deal_amount, threshold: float = 1e8, commit_share: str = "0.9") -> Column:
    """Requested forecast weighting.

    Commit deals of at least ``threshold`` count at ``commit_share`` of the deal
    amount; every other deal at amount x probability / 100.
    """
    big_commit = (_col(amount) >= F.lit(threshold)) & (_col(category) == F.lit("Commit"))
    return F.when(big_commit, (_col(deal_amount) * F.lit(commit_share).cast("decimal(2,1)")).cast(MONEY)).otherwise(
        weighted_amount(prob, amount)
    )


def upsell_snapshot_measure(npv_cents, share) -> Column:
    """Upsell share of one payment row, in dollars (summed by the caller)."""
    return cents_to_dollars(npv_cents) * _col(share)


def live_or_not(act, cutoff: dt.date) -> Column:
    """1 when the merchant went live before the cutoff."""
    return F.when(_col(act) < F.lit(cutoff), F.lit(1)).otherwise(F.lit(0))


def days_since_close(close, as_of: dt.date) -> Column:
    """Days from the close date to the report date."""
    return F.datediff(F.lit(as_of), _col(close))
