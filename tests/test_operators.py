import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.attribution import processing_volume
from ledgerline.operators.curves import backlog_summary, expand_backlog
from ledgerline.operators.dims import DuplicateKeyError, small_dimension
from ledgerline.operators.fanout import sum_once
from ledgerline.operators.rollups import special_dates

D = dt.date
MERCHANTS = ("merchant_id long, sales__is_sold boolean, activation_date date, sales__name string, "
             "sales__industry string, sales__merchant_country string, sales__owner string, sfdc_opportunity string")
UPSELLS = "sales_merchant_id long, effective_activation_date date, pct_share_of_npv decimal(5,4), include int"
PAYMENTS = "capture_date date, sales_merchant_id long, npv_usd_fixed long"


def _merchants(spark, act=D(2017, 1, 1)):
    return spark.createDataFrame([(1, True, act, "m1", "B2B", "GB", "o1", None),
                                  (2, False, act, "m2", "B2B", "GB", "o1", None)], MERCHANTS)


def _pv(spark, payments, upsells, **kw):
    pv = processing_volume(spark.createDataFrame(payments, PAYMENTS), _merchants(spark),
                           spark.createDataFrame(upsells, UPSELLS), None, D(2016, 1, 1), D(2019, 1, 1), **kw)
    return {(r.capture_date, r.sales_category): (r.first_year_sold_npv_usd_fx, r.total_npv) for r in pv.collect()}


def test_attribution_branches(spark):
    act = D(2017, 1, 1)
    eff = D(2017, 5, 1)  # upsell starts at a = 120
    days = {-1: None, 0: None, 120: None, 365: None, 366: None, 485: None, 486: None}
    pay = [(act + dt.timedelta(days=a), 1, 10000) for a in days] + [(act, 2, 999)]  # merchant 2 not sold
    got = _pv(spark, pay, [(1, eff, Decimal("0.30"), 1)])
    nb = {a: got[(act + dt.timedelta(days=a), "new biz")][0] for a in days}
    up = {a: got[(act + dt.timedelta(days=a), "upsell")][0] for a in days}
    assert nb == {-1: 0, 0: 100, 120: 70, 365: 70, 366: 0, 485: 0, 486: 0}
    assert up == {-1: 0, 0: 0, 120: 30, 365: 30, 366: 30, 485: 30, 486: 0}
    # on overlap days the two legs add up to the payment
    for a in (120, 365):
        assert nb[a] + up[a] == got[(act + dt.timedelta(days=a), "new biz")][1]
    assert len({k for k in got if k[1] == "new biz"}) == len(days)


def test_excluded_upsell_is_ignored(spark):
    act = D(2017, 1, 1)
    got = _pv(spark, [(act + dt.timedelta(days=200), 1, 10000)], [(1, D(2017, 5, 1), Decimal("0.30"), 0)])
    assert got == {(act + dt.timedelta(days=200), "new biz"): (100, 100)}


def test_two_upsells_on_one_merchant(spark):
    act = D(2017, 1, 1)
    ups = [(1, D(2017, 5, 1), Decimal("0.30"), 1), (1, D(2017, 6, 1), Decimal("0.30"), 1)]
    pay = [(act + dt.timedelta(days=10), 1, 10000)]
    with pytest.raises(DuplicateKeyError):
        _pv(spark, pay, ups)
    # the source reports' arithmetic: new-business revenue counted once per upsell row
    got = _pv(spark, pay, ups, allow_upsell_fanout=True)
    assert got[(act + dt.timedelta(days=10), "new biz")][0] == 200


def test_overlapping_upsells_share_one_payment(spark):
    """Up to three upsells at a time: in order of their dates each takes what is left of one; a single one is as without a sweep."""
    act, day = D(2017, 1, 1), dt.timedelta(days=1)
    one = [(1, D(2017, 5, 1), Decimal("0.30"), 1), (1, D(2017, 7, 1), Decimal("0.90"), 0)]
    days = [act + k * day for k in (-1, 0, 119, 120, 121, 180, 300, 365, 366, 400, 485, 486, 600, 900)]
    pay = [(d, 1, 10000) for d in days] + [(act, 2, 999)]
    assert _pv(spark, pay, one, overlapping=True) == _pv(spark, pay, one)
    assert _pv(spark, pay, [], overlapping=True) == _pv(spark, pay, [])
    starts = [act + 120 * day, act + 180 * day, act + 300 * day]
    shares = [Decimal("0.30"), Decimal("0.50"), Decimal("0.6250")]
    ups = [(1, b, s, 1) for b, s in zip(starts, shares)] + [(1, starts[1], Decimal("0.10"), 1)]
    pv = processing_volume(spark.createDataFrame(pay, PAYMENTS), _merchants(spark), spark.createDataFrame(ups, UPSELLS), None, D(2016, 1, 1), D(2020, 1, 1), overlapping=True)
    got = {(r.capture_date, r.sales_category, r.sales_activation_date): r.first_year_sold_npv_usd_fx for r in pv.collect()}
    want = {}
    for d in days:
        left, begun, runs = Decimal(1), False, False
        given = {b: Decimal(0) for b in starts}
        for b, s in sorted([(b, s) for _, b, s, _ in ups]):
            begun |= b <= d
            if 0 <= (d - b).days < 366:
                runs = True
                given[b] += min(s, left)
                left -= min(s, left)
        in_year = 0 <= (d - act).days < 366
        want[d, "new biz", act] = 100 * (left if runs else Decimal(0) if begun else Decimal(1)) if in_year else 0
        want |= {(d, "upsell", b): 100 * g for b, g in given.items()}
        assert sum(given.values()) <= 1
    assert got == want
    assert any(sum(g for (x, c, _), g in got.items() if x == d) == 100 and got[d, "new biz", act] == 0 for d in days)  # all of it taken by upsells


def test_override_date_changes_reported_activation_only(spark):
    opps = spark.createDataFrame(
        [(1, None, D(2017, 3, 1)), (1, D(2018, 1, 1), None)],
        "parent_merchant_id long, opportunity_expected_end_date date, opportunity_override_activation_date date")
    sd = special_dates(opps)
    assert sd.collect()[0].asDict() == {"sales_merchant_id": 1, "backlog_end_date": D(2018, 1, 1),
                                        "adjusted_activation_date": D(2017, 3, 1)}
    act = D(2017, 1, 1)
    pv = processing_volume(spark.createDataFrame([(act, 1, 10000)], PAYMENTS), _merchants(spark),
                           None, sd, D(2016, 1, 1), D(2019, 1, 1)).collect()
    assert [(r.sales_activation_date, r.orig_activation, r.first_year_sold_npv_usd_fx) for r in pv] == [
        (D(2017, 3, 1), act, 100)]


def _curve(spark, cum0=1 / 366):
    rows = [(d, 1 / 366, (cum0 if d == 0 else (d + 1) / 366)) for d in range(366)]
    return spark.createDataFrame(rows, "days_since_activation int, first_year_sold_pct double, "
                                       "first_year_sold_cumulative_pct double")


def _summary_input(spark, act):
    return spark.createDataFrame([(1, "new biz", act, act, Decimal("366.00"))],
                                 "sales_merchant_id long, sales_category string, sales_activation_date date, "
                                 "orig_activation date, first_year_sold_npv_usd_fx decimal(18,4)")


def test_backlog_estimate_and_expansion(spark):
    as_of = D(2017, 6, 11)
    act = as_of - dt.timedelta(days=99)
    s = backlog_summary(_summary_input(spark, act), _curve(spark), as_of)
    row = s.first()
    assert row.days_since_activation == 99
    assert abs(row.first_year_est_npv - 366 / (100 / 366)) < 1e-9
    e = expand_backlog(s, _curve(spark))
    assert e.count() == 365 - 99 + 1
    first = e.orderBy("fcst_date").first()
    assert first.fcst_date == as_of
    total = float(e.agg(F.sum("backlog_amount")).first()[0])
    assert abs(total - row.first_year_est_npv * (365 - 99 + 1) / 366) < 0.05


def test_curve_weeks_equal_daily_expansion(spark):
    from ledgerline.functions import periods as P
    from ledgerline.operators.curves import curve_weeks, expand_pipeline

    curve = spark.createDataFrame([(d, (366 - d) / 67161) for d in range(366)], "day_count int, first_year_sold_pct double")
    starts = [D(2000, 1, 2), D(2000, 2, 29), D(2000, 3, 1)]
    deals = spark.createDataFrame([(s, Decimal("1000.0001")) for s in starts],
                                  "opportunity_expected_go_live_date date, expected_amount decimal(18,4)")
    d, start = F.col("fcst_date"), F.col("opportunity_expected_go_live_date")
    daily = expand_pipeline(deals, curve).groupBy(
        start.alias("start"), *P.week_bucket_keys(d), P.ninety_day_live(start, d).alias("ninety_day_live"),
        P.first_year_sold(start, d).alias("first_year_sold")).agg(F.sum("pipeline_amount").cast("decimal(18,8)").alias("amount"))
    weeks = curve_weeks(curve, starts[0], starts[-1]).where(F.col("start").isin(*starts))
    weekly = weeks.select(*daily.columns[:-1], (F.lit(Decimal("1000.0001")) * F.col("share")).cast("decimal(18,8)").alias("amount"))
    assert sorted(map(tuple, weekly.collect())) == sorted(map(tuple, daily.collect()))


def test_zero_cumulative_share_gives_null_estimate(spark):
    from ledgerline.operators.curves import backlog_checks

    as_of = D(2017, 6, 11)
    s = backlog_summary(_summary_input(spark, as_of), _curve(spark, cum0=0.0), as_of)
    assert s.first().first_year_est_npv is None
    c = backlog_checks(s).first()
    assert (c.rows, c.no_estimate, c.no_estimate_npv) == (1, 1, Decimal("366.0000"))


def test_ages_outside_the_curve_drop(spark):
    as_of = D(2017, 6, 11)
    old = backlog_summary(_summary_input(spark, as_of - dt.timedelta(days=400)), _curve(spark), as_of)
    future = backlog_summary(_summary_input(spark, as_of + dt.timedelta(days=3)), _curve(spark), as_of)
    assert old.count() == 0 and future.count() == 0


def test_sum_once_counts_each_deal_once(spark):
    rows = [("g1", "a", Decimal("100.25")), ("g1", "a", Decimal("100.25")), ("g1", "b", Decimal("100.25")),
            ("g2", "c", Decimal("7.50")), ("g2", "d", None)]
    df = spark.createDataFrame(rows, "g string, opp string, amount decimal(18,2)")
    got = {r.g: r.amount_once for r in sum_once(df, ["g"], "opp", "amount").collect()}
    assert got == {"g1": Decimal("200.50"), "g2": Decimal("7.50")}


def test_small_dimension_checks_key_and_bound(spark):
    team = spark.createDataFrame([("a", "AE"), ("a", "NBA"), ("b", "AM")], "sales_owner string, role string")
    with pytest.raises(DuplicateKeyError):
        small_dimension(team, "sales_owner", 10, "team")
    for bound in (1, 3, 1_000_000):  # the key is checked whatever the bound
        with pytest.raises(DuplicateKeyError):
            small_dimension(team.selectExpr("*", f"{bound} as b"), "sales_owner", bound, "team")
    nulls = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert small_dimension(nulls, "k", 1) is nulls  # NULL keys never join
    big = spark.range(50)
    assert small_dimension(big, "id", 10) is big  # over the bound: returned unhinted
    assert "ResolvedHint (strategy=broadcast)" in small_dimension(big, "id", 50)._jdf.queryExecution().analyzed().toString()


def test_wide_dimension_is_not_broadcast(spark, monkeypatch):
    from ledgerline.operators import dims

    monkeypatch.setattr(dims, "BROADCAST_MAX_BYTES", 10_000)
    wide = spark.range(20).selectExpr("id", "repeat('x', 1000) as s")
    assert dims.small_dimension(wide, "id", 100) is wide


def test_sum_once_refuses_two_amounts(spark):
    df = spark.createDataFrame([("g", "a", Decimal("1.00")), ("g", "a", Decimal("5.00"))], "g string, opp string, amount decimal(18,2)")
    with pytest.raises(Exception, match="one key carries two amounts of amount: 1.00 5.00"):
        sum_once(df, ["g"], "opp", "amount").collect()


def test_upload_share_keeps_four_decimals_and_refuses_more(spark, tmp_path):
    from ledgerline.sources.uploads import read_upload

    head = "sales_merchant_id,effective_activation_date,pct_share_of_npv,include\n"
    (tmp_path / "good.csv").write_text(head + "1,2017-05-01,0.125,1\n2,2017-05-01,0.3333,1\n3,2017-05-01,\\N,1\n")
    got = {r.sales_merchant_id: r.pct_share_of_npv for r in read_upload(spark, str(tmp_path / "good.csv"), "upsells").collect()}
    assert got == {1: Decimal("0.1250"), 2: Decimal("0.3333"), 3: None}
    (tmp_path / "bad.csv").write_text(head + "1,2017-05-01,0.33333,1\n")
    with pytest.raises(Exception, match="does not hold 0.33333"):
        read_upload(spark, str(tmp_path / "bad.csv"), "upsells").collect()


def test_scratch_folder_is_temporary_only_on_a_local_master():
    from types import SimpleNamespace

    from ledgerline.session import scratch_dir

    none = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(master="spark://host:7077", applicationId="x", getCheckpointDir=lambda: None, getConf=lambda: none)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(SimpleNamespace(sparkContext=context, conf=none))


def test_role_as_of_latest_snapshot(spark):
    from ledgerline.operators.asof import role_as_of

    hist = spark.createDataFrame(
        [("ann", "AE", "Hub", D(2017, 1, 1)), ("bob", "AM", "Hub", D(2017, 1, 1)),
         ("ann", "NBA", "Hub", D(2017, 2, 1)), ("bob", "AE", "Hub", D(2017, 2, 1))],
        "sales_owner string, role string, team string, snapshot_date date")
    facts = spark.createDataFrame(
        [(1, "ann", D(2016, 12, 31)), (2, "ann", D(2017, 1, 31)), (3, "ann", D(2017, 2, 1)),
         (4, "bob", D(2017, 3, 15)), (5, "cy", D(2017, 3, 15))],
        "id int, owner string, d date")
    got = {r.id: r.role for r in role_as_of(facts, hist, "owner", "d").collect()}
    assert got == {1: None, 2: "AE", 3: "NBA", 4: "AE", 5: None}


def test_snapshots_fold_into_intervals(spark):
    """Equal snapshots are one interval, a snapshot without the owner ends it, and NULL is a value like others."""
    from ledgerline.operators.asof import fold_snapshots, role_as_of

    days = [D(2017, 1, 1), D(2017, 2, 1), D(2017, 3, 1), D(2017, 4, 1), D(2017, 5, 1)]
    said = {"ann": ["AE", "AE", "AM", "AM", "AE"], "bob": ["AE", "-", "AE", "AE", "-"], "cy": [None, None, "AE", None, None], "di": ["-", "-", "-", "-", "NBA"]}
    rows = [(o, r, "Hub", d) for o, roles in said.items() for r, d in zip(roles, days) if r != "-"]
    hist = spark.createDataFrame(rows, "sales_owner string, role string, team string, snapshot_date date")
    got = {tuple(r) for r in fold_snapshots(hist, "sales_owner", ("role",)).collect()}
    last = dt.timedelta(days=1)
    assert got == {("ann", "AE", days[0], days[2] - last), ("ann", "AM", days[2], days[4] - last), ("ann", "AE", days[4], None),
                   ("bob", "AE", days[0], days[1] - last), ("bob", "AE", days[2], days[4] - last), ("cy", None, days[0], days[2] - last),
                   ("cy", "AE", days[2], days[3] - last), ("cy", None, days[3], None), ("di", "NBA", days[4], None)}
    # an empty snapshot ends what was valid before
    later = spark.createDataFrame([(D(2017, 6, 1),)], "snapshot_date date")
    ended = {r.sales_owner: r.valid_to for r in fold_snapshots(hist, "sales_owner", ("role",), dates=later).filter("valid_from = '2017-05-01'").collect()}
    assert ended == {"ann": D(2017, 5, 31), "di": D(2017, 5, 31)}
    # every owner on every day: as the latest table on or before it says
    every = [(o, days[0] + dt.timedelta(days=k)) for o in [*said, "nobody", None] for k in range(-3, 160)]
    facts = spark.createDataFrame(every, "o string, d date")
    found = {(r.o, r.d): (r.role, r.valid_from is not None) for r in role_as_of(facts, hist, "o", "d").collect()}
    for o, d in every:
        at = [k for k, x in enumerate(days) if x <= d]
        say = said[o][at[-1]] if o in said and at else "-"
        assert found[o, d] == ((None, False) if say == "-" else (say, True)), (o, d)
    assert fold_snapshots(hist.limit(0), "sales_owner", ("role",)).count() == 0
    with pytest.raises(Exception, match="twice"):
        fold_snapshots(hist.union(hist), "sales_owner", ("role",)).collect()


def test_changes_between_two_states(spark):
    from ledgerline.operators.changes import changes

    kind = "k string, w int, npv decimal(10,2), owner string, note string"
    before = spark.createDataFrame([("a", 1, Decimal(5), "x", "p"), ("b", 1, Decimal(7), "x", "p"), (None, 1, Decimal(1), "x", None),
                                    ("c", None, None, "x", "p"), ("d", 1, Decimal(2), None, "p"), ("same", 1, None, None, None)], kind)
    after = spark.createDataFrame([("a", 1, Decimal(6), "y", "p"), (None, 1, Decimal(1), "x", None), ("c", None, Decimal(3), "x", "p"),
                                   ("d", 1, Decimal(2), "z", "q"), ("e", 2, Decimal(9), "x", "p"), ("e", 2, Decimal(1), "x", "p"), ("same", 1, None, None, None)], kind)
    got = {(r.k, r.w): (r.status, r.changed, r.npv_before, r.npv_after, r.npv_change) for r in changes(before, after, ["k", "w"], ["npv"], ["owner", "note"]).collect()}
    assert got == {("a", 1): ("restated", "npv,owner", 5, 6, 1), ("b", 1): ("gone", "", 7, None, -7), ("c", None): ("restated", "npv", None, 3, 3),
                   ("d", 1): ("restated", "owner,note", 2, 2, 0), ("e", 2): ("added", "", None, 10, 10)}
    assert changes(before, before, ["k", "w"], ["npv"], ["owner", "note"]).count() == 0
    assert {r.status for r in changes(before.limit(0), after, ["k", "w"], ["npv"]).collect()} == {"added"}


def test_hot_merchant_is_bounded_by_calendar_days(spark):
    """One merchant with a third of all payments: after the daily sums no partition holds more than its days."""
    from ledgerline.operators.attribution import daily_npv

    base = D(2017, 1, 1)
    hot = [(base + dt.timedelta(days=i % 200), 1, 100) for i in range(30_000)]          # 30k rows, 200 days
    rest = [(base + dt.timedelta(days=i % 300), 2 + i % 1_000, 100) for i in range(60_000)]
    pay = spark.createDataFrame(hot + rest, PAYMENTS).repartition(8)
    daily = daily_npv(pay, base, None)
    sizes = [r["count"] for r in daily.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 200 + len({(i % 300, i % 1_000) for i in range(60_000)})
    hot_rows = daily.filter("sales_merchant_id = 1")
    assert hot_rows.count() == 200 and hot_rows.agg(F.sum("npv_cents")).first()[0] == 30_000 * 100
    # the hot merchant's whole history is 200 rows: no partition is anywhere near a third of the input
    assert max(sizes) < 0.2 * sum(sizes)
    # and its revenue is whole after the attribution legs
    pv = processing_volume(pay, _merchants(spark, act=base), None, None, base, None)
    assert pv.filter("sales_merchant_id = 1").agg(F.sum("total_npv")).first()[0] == 30_000


def test_forecast_weighting_branches(spark):
    from ledgerline.functions.measures import forecast_weighted_amount, weighted_amount

    rows = [(Decimal("200000000.00"), 40, "Commit", Decimal("150000000.00")),   # big commit: 0.9 x deal amount
            (Decimal("200000000.00"), 40, "Best Case", Decimal("150000000.00")),  # not commit: amount x prob
            (Decimal("1000.00"), 40, "Commit", Decimal("1000.00")),              # small commit: amount x prob
            (Decimal("1000.00"), None, "Pipeline", Decimal("1000.00")),          # NULL probability -> NULL
            (None, 40, "Pipeline", None)]
    df = spark.createDataFrame(rows, "a decimal(18,2), p int, c string, d decimal(18,2)")
    got = [r.w for r in df.select(forecast_weighted_amount("a", "p", "c", "d").alias("w")).collect()]
    assert got == [Decimal("135000000.0000"), Decimal("80000000.0000"), Decimal("400.0000"), None, None]
    w = [r.w for r in df.select(weighted_amount("p", "a").alias("w")).collect()]
    assert w[2] == Decimal("400.0000") and w[3] is None


def test_left_join_nullable_keeps_null_keys_once(spark):
    from ledgerline.operators.enrich import left_join_nullable

    left = spark.createDataFrame([(1, 10), (2, None), (3, 11), (4, None)], "id int, k long")
    right = spark.createDataFrame([(10, "a"), (12, "b")], "rk long, v string")
    got = sorted((r.id, r.v) for r in left_join_nullable(left, right, "k", "rk").collect())
    assert got == [(1, "a"), (2, None), (3, None), (4, None)]


def test_upsert_roles_replaces_and_removes(spark):
    from ledgerline.plans.reports import upsert_roles

    team = spark.createDataFrame([("ann", "AE", "Hub"), ("bob", "AM", "Hub"), ("cy", "NBA", "In-country")],
                                 "sales_owner string, role string, team string")
    add = spark.createDataFrame([("bob", "AE", "In-country"), ("dee", "AE", "In-country")],
                                "sales_owner string, role string, team string")
    remove = spark.createDataFrame([("cy",)], "sales_owner string")
    got = sorted(tuple(r) for r in upsert_roles(team, add, remove).collect())
    assert got == [("ann", "AE", "Hub"), ("bob", "AE", "In-country"), ("dee", "AE", "In-country")]


def test_role_edits_last_one_wins(spark):
    from ledgerline.plans.reports import apply_role_edits

    stored = spark.createDataFrame([("ann", "AE", "Hub"), ("bob", "AM", "Hub"), ("cy", "AE", "Hub")], "sales_owner string, role string, team string")
    kind = "seq long, action string, sales_owner string, role string, team string"
    edits = spark.createDataFrame([(5, "add", "bob", "NBA", "In-country"), (2, "remove", "bob", None, None), (1, "add", "di", "AE", "Hub"), (9, "remove", "di", None, None),
                                   (3, "remove", "cy", None, None), (4, "remove", "nobody", None, None), (7, "add", "ed", "AE", None)], kind)
    once = apply_role_edits(stored, edits)
    rows = {tuple(r) for r in once.collect()}
    assert rows == {("ann", "AE", "Hub"), ("bob", "NBA", "In-country"), ("ed", "AE", None)}
    assert {tuple(r) for r in apply_role_edits(once, edits).collect()} == rows
    assert {tuple(r) for r in apply_role_edits(stored, edits.limit(0)).collect()} == {tuple(r) for r in stored.collect()}
    with pytest.raises(DuplicateKeyError):
        apply_role_edits(stored, edits.unionByName(edits.filter("seq = 1")))
    with pytest.raises(Exception, match="unknown action"):
        apply_role_edits(stored, spark.createDataFrame([(1, "drop", "ann", None, None)], kind)).collect()


def test_opportunity_merchant_key(spark):
    from ledgerline.operators.enrich import opportunity_merchant_key

    df = spark.createDataFrame([("42",)], "o string")
    assert df.select(opportunity_merchant_key("o").alias("k")).first().k == "OPTI__42"


def test_backlog_spans_equal_daily_expansion(spark):
    """Spans summed by week and flags equal daily rows summed the same way, also on a curve with missing days."""
    from ledgerline.functions import periods as P
    from ledgerline.operators.curves import backlog_spans, cumulative_shares
    from ledgerline.params import ReportParams

    as_of = D(1999, 12, 26)
    p = ReportParams(as_of=as_of, fy_start=D(1999, 1, 1), fy_end=D(2000, 3, 1))
    curve = spark.createDataFrame([(d, (366 - d) / 67161, (d + 1) / 366) for d in range(366) if d % 50 != 7 and not 200 <= d < 212],
                                  "days_since_activation int, first_year_sold_pct double, first_year_sold_cumulative_pct double")
    acts = [as_of - dt.timedelta(days=a) for a in (0, 1, 30, 88, 90, 91, 199, 300, 364, 365)]
    ends = [None, as_of, D(2000, 1, 1), as_of + dt.timedelta(days=61), D(2000, 3, 2), D(1999, 1, 1), None, D(2000, 2, 29), None, None]
    summary = spark.createDataFrame(
        [(i, "new biz", a, a, (as_of - a).days, Decimal("10.0000"), 1000.0 + i, e) for i, (a, e) in enumerate(zip(acts, ends))],
        "sales_merchant_id long, sales_category string, sales_activation_date date, orig_activation date, days_since_activation int, "
        "first_year_npv decimal(18,4), first_year_est_npv double, backlog_end_date date")
    act, end = "sales_activation_date", F.col("backlog_end_date")

    def keys(day):
        return ["sales_merchant_id", *P.week_bucket_keys(day), P.ninety_day_live(act, day, end).alias("a"),
                P.first_year_sold(act, day, end).alias("b"), P.new_npv("orig_activation", p, fcst=day).alias("c")]

    daily = expand_backlog(summary, curve)
    sums = cumulative_shares(curve)
    cuts = [F.date_add(act, 91), end, F.lit(p.fy_end + dt.timedelta(days=1))]
    for first in (None, D(2000, 1, 12)):
        kept = daily if first is None else daily.filter(F.col("fcst_date") >= F.lit(first))
        want = kept.groupBy(*keys(F.col("fcst_date"))).agg(F.count("*").alias("n"), F.sum("backlog_amount").cast("decimal(38,16)").alias("x"))
        spans = backlog_spans(summary, sums, cuts, weeks=True, first=first)
        got = spans.groupBy(*keys(F.col("span_start"))).agg(F.sum("n_days").alias("n"), F.sum("backlog_amount").cast("decimal(38,16)").alias("x"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    whole = backlog_spans(summary, sums, cuts)
    flags = keys(F.col("span_start"))[3:]
    want = daily.groupBy("sales_merchant_id", *keys(F.col("fcst_date"))[3:]).agg(F.count("*").alias("n"))
    assert sorted(map(tuple, whole.groupBy("sales_merchant_id", *flags).agg(F.sum("n_days").alias("n")).collect())) == sorted(map(tuple, want.collect()))
    assert whole.count() < 10 * 4
