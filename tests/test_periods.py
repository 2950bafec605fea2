import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import periods as P
from ledgerline.params import ReportParams

D = dt.date


def _one(spark, col, d):
    return spark.createDataFrame([(d,)], "d date").select(col.alias("x")).first()["x"]


def test_finance_week_starts_on_sunday(spark):
    rows = [(D(2017, 2, 25), "2017-02-19"), (D(2017, 2, 26), "2017-02-26"), (D(2017, 3, 4), "2017-02-26"),
            (D(2017, 2, 27), "2017-02-26"), (D(2016, 12, 31), "2016-12-25"), (D(2017, 1, 1), "2017-01-01")]
    df = spark.createDataFrame([(d,) for d, _ in rows], "d date")
    got = {r["d"]: r["w"] for r in df.select("d", P.finance_week("d").alias("w")).collect()}
    assert got == {d: w for d, w in rows}


def test_period_labels(spark):
    df = spark.createDataFrame([(D(2017, 2, 25),), (D(2017, 3, 4),), (D(2017, 11, 30),)], "d date")
    got = df.select(P.period_label("d", "year").alias("y"), P.period_label("d", "quarter").alias("q"),
                    P.period_label("d", "month").alias("m")).collect()
    assert [(r.y, r.q, r.m) for r in got] == [("2017", "2017-01", "2017-02"), ("2017", "2017-01", "2017-03"),
                                              ("2017", "2017-10", "2017-11")]


def test_age_flags_boundaries(spark):
    act = D(2017, 1, 1)
    ages = [-1, 0, 90, 91, 365, 366]
    df = spark.createDataFrame([(act, act + dt.timedelta(days=a)) for a in ages] + [(None, act)], "act date, d date")
    got = df.select(P.ninety_day_live("act", "d").alias("n"), P.first_year_sold("act", "d").alias("f")).collect()
    assert [r.n for r in got] == [0, 1, 1, 0, 0, 0, 0]
    assert [r.f for r in got] == [0, 1, 1, 1, 1, 0, 0]


def test_end_date_zeroes_flags_from_end_on(spark):
    act, end = D(2017, 1, 1), D(2017, 1, 10)
    days = [D(2017, 1, 9), D(2017, 1, 10), D(2017, 1, 11)]
    df = spark.createDataFrame([(act, d, end) for d in days] + [(act, days[0], None)], "act date, d date, e date")
    got = df.select(P.first_year_sold("act", "d", F.col("e")).alias("f")).collect()
    assert [r.f for r in got] == [1, 0, 0, 1]


def test_report_flags(spark):
    as_of = D(2000, 1, 2)  # Sunday; "this week" is the week of 1999-12-30
    df = spark.createDataFrame([(D(1999, 12, 26),), (D(2000, 1, 1),), (D(2000, 1, 2),), (D(1999, 12, 25),)], "d date")
    got = df.select(P.this_week_flag("d", as_of).alias("w"), P.qtd_flag("d", as_of).alias("q"),
                    P.cohort_flag("d", as_of).alias("c")).collect()
    assert [r.w for r in got] == [1, 1, 0, 0]
    assert [r.q for r in got] == [0, 1, 1, 0]
    assert [r.c for r in got] == [0, 0, 1, 0]


def test_new_npv_and_in_quarter(spark):
    p = ReportParams(as_of=D(2017, 6, 11), fy_start=D(2017, 1, 1), fy_end=D(2017, 12, 31))
    df = spark.createDataFrame(
        [(D(2016, 12, 31), D(2017, 5, 1), None), (D(2017, 1, 1), D(2018, 1, 1), "New Business"),
         (D(2017, 4, 2), D(2017, 6, 1), "Existing Customer"), (D(2017, 4, 2), D(2017, 5, 1), None)],
        "act date, fcst date, t string")
    got = df.select(P.new_npv("act", p).alias("a"), P.new_npv("act", p, fcst="fcst").alias("b"),
                    P.new_npv("act", p, opp_type="t").alias("c"),
                    P.in_quarter("act", "fcst", p.as_of).alias("iq")).collect()
    assert [r.a for r in got] == [0, 1, 1, 1]
    assert [r.b for r in got] == [0, 0, 1, 1]
    assert [r.c for r in got] == [0, 1, 0, 0]  # NULL type -> 0
    assert [r.iq for r in got] == [0, 0, 1, 1]
