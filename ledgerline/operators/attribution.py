"""First-year revenue attribution: new-business leg and upsell leg.

Plan shape (the part that meets the big fact table):

1. payments are filtered on capture date (pushed to the scan, month folders
   pruned) and summed per (merchant, day) - a map-side combined aggregate
   whose shuffle key includes the day, so one merchant holding a third of all
   rows is spread over as many tasks as it has days;
2. every per-merchant input (sold flag, activation, override date, upsell)
   is joined into one merchant-level table first - dimension-sized joins;
3. the daily sums meet that table in one join and both legs come out of a
   single pass (``explode`` of a two-element array), no second scan.

Every CASE of the attribution rule depends only on (merchant, day), so
summing a rule over payment rows equals applying it to the daily sum; all
money is exact decimal.
"""

from __future__ import annotations
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import cents_to_dollars
from ..sources.tables import capture_range, partitions_for
from .dims import TASK_ROWS, merchant_level, small_dimension, table_size
from .enrich import allow_list

UPSELL_MAX_ROWS = 1_000_000
FIRST_YEAR_DAYS = 366
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"
PV_COLUMNS = ("data_type", "capture_date", "sales_merchant_id", "sales_category", "sales_activation_date",
              "orig_activation", "first_year_sold_npv_usd_fx", "total_npv")


def daily_npv(payments: DataFrame, start=None, end=None, start_inclusive: bool = True,
              value: str = "npv_usd_fixed", by_merchant: bool = True) -> DataFrame:
    """NPV cents per (merchant, capture day) within [start, end).

    The raw rows are combined map-side and shuffled on (merchant, day), so a
    merchant with a third of all payments is spread over its days.  With
    ``by_merchant`` the daily sums are then re-partitioned by merchant alone:
    safe from skew because a merchant now holds at most one row per calendar
    day, and every later step (attribution joins, weekly and monthly sums,
    the per-merchant segment join) is keyed by merchant, so they all reuse
    this partitioning instead of shuffling again.
    """
    return daily_sums(payments, [(value, "npv_cents")], start, end, start_inclusive, by_merchant)


def daily_sums(facts: DataFrame, measures, start=None, end=None, start_inclusive: bool = True,
               by_merchant: bool = True) -> DataFrame:
    """Sums of ``measures`` [(column, alias)] per (merchant, capture day); see ``daily_npv``."""
    daily = (
        capture_range(facts, start, end, start_inclusive)
        .groupBy("sales_merchant_id", "capture_date")
        .agg(*[F.sum(c).alias(a) for c, a in measures])
    )
    return partition_by_merchant(daily, expanding=True) if by_merchant else daily


def partition_by_merchant(daily: DataFrame, expanding: bool = False) -> DataFrame:
    """Hash-partition (merchant, day) rows by merchant.

    The rows are counted, and so many partitions made that none has more than
    some ``TASK_ROWS``: AQE sizes partitions by compressed bytes, of which a task's
    aggregates take many times as much memory.  Where each row later becomes
    a row per day (``expanding``), the session's shuffle parallelism is kept.
    """
    if expanding:
        parts = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    else:
        parts = partitions_for(daily.sparkSession, table_size(daily)[0], TASK_ROWS)
    return daily.repartition(parts, "sales_merchant_id")


def daily_range(daily_table: DataFrame, start=None, end=None, start_inclusive: bool = True, expanding: bool = False) -> DataFrame:
    """Rows of a stored (merchant, day) table within [start, end), partitioned by merchant."""
    return partition_by_merchant(capture_range(daily_table, start, end, start_inclusive), expanding)


def current_upsells(upsells: DataFrame) -> DataFrame:
    """Upsells flagged for inclusion."""
    return upsells.filter(F.col("include") == 1).select(
        "sales_merchant_id", "effective_activation_date", "pct_share_of_npv")


def merchant_attribution(merchants: DataFrame, upsells: DataFrame | None, special: DataFrame | None,
                         allow_upsell_fanout: bool = False) -> DataFrame:
    """Sold merchants with funnel activation, optional override date and included upsell.

    One row per merchant: a merchant with two included upsells raises
    ``DuplicateKeyError`` (it would count its new-business revenue twice),
    unless ``allow_upsell_fanout`` keeps that arithmetic on purpose.  The
    table is broadcast when it passes the size check.
    """
    m = merchants.filter(F.col("sales__is_sold") == F.lit(True)).select(
        F.col("merchant_id").alias("sales_merchant_id"), F.col("activation_date").alias("orig_activation"))
    if special is not None:
        m = m.join(special.select("sales_merchant_id", "adjusted_activation_date"), "sales_merchant_id", "left")
    else:
        m = m.withColumn("adjusted_activation_date", F.lit(None).cast("date"))
    if upsells is not None:
        up = small_dimension(current_upsells(upsells), None if allow_upsell_fanout else "sales_merchant_id",
                             UPSELL_MAX_ROWS, "upsells")
        m = m.join(up, "sales_merchant_id", "left")
        if allow_upsell_fanout:
            return m
    else:
        m = (m.withColumn("effective_activation_date", F.lit(None).cast("date"))
             .withColumn("pct_share_of_npv", F.lit(None).cast("decimal(5,4)")))
    return merchant_level(m, merchants, "merchant attribution")


def leg_terms(merchants: DataFrame, upsells: DataFrame, special: DataFrame | None) -> DataFrame:
    """Each sold merchant's time cut into intervals with one factor per leg, for any number of upsells.

    Columns: sales_merchant_id, sales_category, sales_activation_date,
    orig_activation, ``since`` (inclusive), ``until`` (exclusive), ``factor``.
    The intervals of a leg cover all days, so a payment meets one row of each leg.

    A sweep over the days on which something begins or ends: an upsell runs
    for 366 days from its date, the first year for 366 days from activation.
    Where upsells overlap they take their shares in the order of their dates
    (equal dates: of their shares), each at most what the earlier ones leave of
    one, and new business has the rest; so shares never add to more than one.
    New business counts nothing after its upsells have ended, as with one upsell.
    Upsells of one date are one leg.
    """
    share_type = "decimal(5,4)"
    one, zero = F.lit(1).cast(share_type), F.lit(0).cast(share_type)
    sold = merchants.filter(F.col("sales__is_sold") == F.lit(True)).select(
        F.col("merchant_id").alias("sales_merchant_id"), F.col("activation_date").alias("orig_activation"))
    if special is not None:
        dates = special.select("sales_merchant_id", "adjusted_activation_date")
        sold = sold.join(dates, "sales_merchant_id", "left")
    else:
        sold = sold.withColumn("adjusted_activation_date", F.lit(None).cast("date"))
    sold = merchant_level(sold.select("sales_merchant_id", "orig_activation", F.coalesce("adjusted_activation_date", "orig_activation").alias("reported")),
                          merchants, "merchants of the legs")
    ups = current_upsells(upsells).filter(F.col("effective_activation_date").isNotNull()).select(
        "sales_merchant_id", F.col("effective_activation_date").alias("begins"), F.col("pct_share_of_npv").alias("share"))
    ups = ups.join(sold.select("sales_merchant_id"), "sales_merchant_id")
    events = (ups.select("sales_merchant_id", F.explode(F.array("begins", F.date_add("begins", FIRST_YEAR_DAYS))).alias("since"))
              .unionByName(sold.select("sales_merchant_id", F.explode(F.array(
                  F.lit(FIRST_DAY).cast("date"), "orig_activation", F.date_add("orig_activation", FIRST_YEAR_DAYS))).alias("since")))
              .filter(F.col("since").isNotNull()).distinct())
    follow = Window.partitionBy("sales_merchant_id").orderBy("since")
    spans = events.select("*", F.coalesce(F.lead("since").over(follow), F.lit(LAST_DAY).cast("date")).alias("until"))

    def runs(start):
        return (F.col("since") >= F.col(start)) & (F.col("since") < F.date_add(start, FIRST_YEAR_DAYS))

    earlier = Window.partitionBy("sales_merchant_id", "since").orderBy("begins", "share").rowsBetween(Window.unboundedPreceding, -1)
    at_work = spans.join(ups, "sales_merchant_id").select("*", F.when(runs("begins"), F.col("share")).otherwise(zero).alias("wanted"))
    left = F.greatest(one - F.coalesce(F.sum("wanted").over(earlier), F.lit(0)), F.lit(0))
    shares = (at_work.select("*", F.least(F.col("wanted"), left).cast(share_type).alias("given"))
              .groupBy("sales_merchant_id", "since", "until", "begins").agg(F.sum("given").cast(share_type).alias("factor")))
    upsell = shares.join(sold, "sales_merchant_id").select(
        "sales_merchant_id", F.lit("upsell").alias("sales_category"), F.col("begins").alias("sales_activation_date"), "orig_activation", "since", "until", "factor")
    taken = shares.groupBy("sales_merchant_id", "since").agg(
        F.sum("factor").cast(share_type).alias("taken"), F.max(F.when(runs("begins"), 1)).alias("runs"), F.max(F.when(F.col("begins") <= F.col("since"), 1)).alias("begun"))
    rest = F.when(F.col("begun").isNull(), one).when(F.col("runs").isNotNull(), one - F.col("taken")).otherwise(zero)
    new = spans.join(sold, "sales_merchant_id").join(taken, ["sales_merchant_id", "since"], "left").select(
        "sales_merchant_id", F.lit("new biz").alias("sales_category"), F.col("reported").alias("sales_activation_date"), "orig_activation", "since", "until",
        F.when(runs("orig_activation"), rest).otherwise(zero).cast(share_type).alias("factor"))
    return new.unionByName(upsell)


def _legs_by_terms(daily: DataFrame, terms: DataFrame) -> DataFrame:
    """Daily sums times the factors of the intervals their days lie in: an equi-join on the merchant with the dates beside it."""
    d = F.col("capture_date")
    size = small_dimension(terms, None, UPSELL_MAX_ROWS, "leg terms")
    j = daily.join(size, "sales_merchant_id").filter((d >= F.col("since")) & (d < F.col("until")))
    dollars = cents_to_dollars(F.col("npv_cents"))
    return j.select("capture_date", "sales_merchant_id", "orig_activation", dollars.alias("total"),
                    F.struct("sales_category", "sales_activation_date", (F.col("factor") * dollars).alias("fys")).alias("leg"))


def _legs(daily: DataFrame, attr: DataFrame) -> DataFrame:
    j = daily.join(attr, "sales_merchant_id")
    d = F.col("capture_date")
    a = F.datediff(d, F.col("orig_activation"))
    u = F.datediff(d, F.col("effective_activation_date"))
    in_fy = (a >= 0) & (a < 366)
    up_on = (u >= 0) & (u < 366)
    share = F.col("pct_share_of_npv")
    one = F.lit(1).cast("decimal(5,4)")
    zero = F.lit(0).cast("decimal(5,4)")
    nb_factor = (
        F.when(in_fy & F.col("effective_activation_date").isNull(), one)
        .when(in_fy & (u < 0), one)
        .when(in_fy & up_on, one - share)
        .otherwise(zero)
    )
    up_factor = F.when(up_on, share).otherwise(zero)
    dollars = cents_to_dollars(F.col("npv_cents"))
    new_biz = F.struct(
        F.lit("new biz").alias("sales_category"),
        F.coalesce(F.col("adjusted_activation_date"), F.col("orig_activation")).alias("sales_activation_date"),
        (nb_factor * dollars).alias("fys"),
    )
    upsell = F.when(
        F.col("effective_activation_date").isNotNull(),
        F.struct(
            F.lit("upsell").alias("sales_category"),
            F.col("effective_activation_date").alias("sales_activation_date"),
            (up_factor * dollars).alias("fys"),
        ),
    )
    # the upsell element is NULL for merchants without an upsell; a plain explode plus a NULL
    # filter stays inside whole-stage codegen (array_compact would add a lambda that does not)
    return j.select(
        "capture_date", "sales_merchant_id", "orig_activation", dollars.alias("total"),
        F.explode(F.array(new_biz, upsell)).alias("leg"),
    ).filter(F.col("leg").isNotNull())


def processing_volume(payments: DataFrame, merchants: DataFrame, upsells: DataFrame | None,
                      special: DataFrame | None, start, end=None, start_inclusive: bool = True,
                      categories: tuple[str, ...] = ("new biz", "upsell"),
                      allow_upsell_fanout: bool = False, ids: DataFrame | None = None,
                      daily: DataFrame | None = None, overlapping: bool = False) -> DataFrame:
    """Daily first-year NPV per merchant and category (both legs stacked).

    One row per (capture day, merchant, category, activation, original
    activation).  ``categories`` selects a single leg.  ``ids`` (a table with
    ``sales_merchant_id``) restricts the merchants; it is applied to the
    daily sums, which are already partitioned by merchant, never to raw
    payments.  ``daily`` passes (merchant, day) sums computed elsewhere (for
    example a stored daily table, see ``daily_range``) in place of ``payments``;
    it must have one row per merchant and day.  ``overlapping`` allows several
    included upsells of one merchant (``leg_terms``).
    """
    if daily is None:
        daily = daily_npv(payments, start, end, start_inclusive)
    if ids is not None:
        daily = allow_list(daily, ids, "sales_merchant_id")
    if overlapping:
        legs = _legs_by_terms(daily, leg_terms(merchants, upsells, special))
    else:
        legs = _legs(daily, merchant_attribution(merchants, upsells, special, allow_upsell_fanout))
    if tuple(categories) != ("new biz", "upsell"):
        legs = legs.filter(F.col("leg.sales_category").isin(*categories))
    keys = ("capture_date", "sales_merchant_id", F.col("leg.sales_category").alias("sales_category"),
            F.col("leg.sales_activation_date").alias("sales_activation_date"), "orig_activation")
    if allow_upsell_fanout:
        rows = legs.groupBy(*keys).agg(F.sum("leg.fys").alias("first_year_sold_npv_usd_fx"), F.sum("total").alias("total_npv"))
    else:  # a merchant has one row a day and one upsell of a date at most: every leg is one row already
        rows = legs.select(*keys, F.col("leg.fys").alias("first_year_sold_npv_usd_fx"), F.col("total").alias("total_npv"))
    return rows.select(F.lit("weekly_processing").alias("data_type"), *PV_COLUMNS[1:])


def new_business_leg(payments, merchants, upsells, special, start, end=None, start_inclusive=True) -> DataFrame:
    """New-business leg only (O-16)."""
    return processing_volume(payments, merchants, upsells, special, start, end, start_inclusive, ("new biz",))


def upsell_leg(payments, merchants, upsells, start, end=None, start_inclusive=True) -> DataFrame:
    """Upsell leg only (O-17)."""
    return processing_volume(payments, merchants, upsells, None, start, end, start_inclusive, ("upsell",))
