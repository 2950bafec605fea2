"""Jobs that write tables: weekly snapshots, table rotation, role maintenance, deal export.

Each job writes a dated partition under the dataset's output folder in the
shared scratch area and returns the table read back from storage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import fold_snapshots, join_as_of
from ..operators.changes import changes
from ..operators.checks import Checks
from ..operators.dims import check_unique
from ..params import ReportParams
from ..sources import fixtures
from ..sources.snapshots import SNAPSHOT_COL, publish, read_snapshot, snapshot_dates, write_snapshot
from ..sources.tables import Tables
from ..sources.uploads import CSV_READ, CSV_WRITE, check_upload, latest_upload, write_lines
from . import reports as R


def weekly_processing_snapshot_job(t: Tables, p: ReportParams, path: str | None = None) -> DataFrame:
    """J-7: write this week's processing snapshot; return it read back."""
    path = path or t.output_path("weekly_processing")
    write_snapshot(R.weekly_processing_snapshot(t, p), path, p.as_of)
    return read_snapshot(t.spark, path, p.as_of)


def weekly_upsell_snapshot_job(t: Tables, p: ReportParams, path: str | None = None) -> DataFrame:
    """J-8: write this week's upsell snapshot; return it read back."""
    path = path or t.output_path("weekly_processing_upsells")
    write_snapshot(R.weekly_upsell_snapshot(t, p), path, p.as_of)
    return read_snapshot(t.spark, path, p.as_of)


def snapshot_rotation(t: Tables, p: ReportParams, path: str | None = None) -> DataFrame:
    """O-27: write this week's snapshot; return last week's as it was stored then.

    Only the partition of ``as_of`` is written; without a stored snapshot of
    the week before, the result is empty.
    """
    path = path or t.output_path("rotation_weekly_processing")
    write_snapshot(R.weekly_processing_snapshot(t, p), path, p.as_of)
    return read_snapshot(t.spark, path, p.as_of, weeks_back=1)


def two_weekly_runs(t: Tables, p: ReportParams) -> DataFrame:
    """O-27 as it goes in two weeks: the run of ``as_of - 7``, unless it is stored, and then that of ``as_of``."""
    path = t.output_path("rotation_weekly_processing")
    last = p.shifted(-7)
    if not snapshot_dates(t.spark, path):
        snapshot_rotation(t, last, path)
    return snapshot_rotation(t, p, path)


# what names a row of the weekly snapshot, and what else may change beside its revenue
SNAPSHOT_KEYS = ["sales_merchant_id", "year", "quarter", "finance_week", "activation_date", "ninety_day_live", "first_year_sold"]
SNAPSHOT_ATTRIBUTES = ["region", "country", "sub_region", "vertical", "owner", "sales_role", "sales_location", "merchant_name"]


def snapshot_changes(t: Tables, path: str, before: dt.date, after: dt.date) -> DataFrame:
    """R-2, as stored: what changed between two dates of a stored weekly snapshot table.

    Both sides are read as they were written, so restated weeks, merchants that
    moved or left and late captures all show.
    """
    return changes(read_snapshot(t.spark, path, before), read_snapshot(t.spark, path, after), SNAPSHOT_KEYS, ["npv_fixed_fx"], SNAPSHOT_ATTRIBUTES)


def change_since_midweek(t: Tables, p: ReportParams, days: int = 10) -> DataFrame:
    """R-2 between a run ``days`` before the report date, with the role table of then, and that of the report date."""
    path, then = t.output_path("changes_weekly_processing"), p.shifted(-days)
    if not snapshot_dates(t.spark, path):
        roles = fixtures.team_role_on(t.spark, t.source_dir, max(d for d in fixtures.ROLE_DATES if d <= then.as_of))
        write_snapshot(R.weekly_snapshot(t, then, team=roles), path, then.as_of)
    write_snapshot(R.weekly_processing_snapshot(t, p), path, p.as_of)
    return snapshot_changes(t, path, then.as_of, p.as_of)


def upsell_table_rotation(t: Tables, p: ReportParams, path: str | None = None,
                          upload_path: str | None = None) -> DataFrame:
    """J-11: read this week's upsell upload (CSV, declared schema) and store it as this week's snapshot.

    Earlier weeks stay in the table as the backups the source kept by renaming.
    Without ``upload_path`` the upload file is produced from the staged upsell list.
    """
    from ..sources.uploads import read_upload, write_upload

    path = path or t.output_path("upsells")
    if upload_path is None:
        upload_path = t.output_path("uploads", f"upsells-{p.as_of.isoformat()}")
        write_upload(t.upsells, upload_path, "upsells")
    write_snapshot(read_upload(t.spark, upload_path, "upsells"), path, p.as_of)
    return read_snapshot(t.spark, path, p.as_of)


LISTS = ("country_codes", "team_role", "upsells", "backlog_curve", "pipeline_curve")
# a line that cannot be used, as it stands at the end of this week's upload of each list
BAD_LINES = {"country_codes": "99,,Nowhere,New Markets", "team_role": "Supplier#0,AE", "upsells": "3,1999-13-01,0.2500,1",
             "backlog_curve": "366,-0.5,1.0", "pipeline_curve": "0,0.5"}


def land_uploads(t: Tables, p: ReportParams, landing: str) -> str:
    """A landing folder as the weeks leave it: an older upload of each list, the one of the day before the report
    date with a bad line at its end, and one that comes after the report date."""
    for name in LISTS:
        current = getattr(t, name)
        write_lines(current.limit(3), f"{landing}/{name}/{p.shifted(-15).as_of}", name)
        write_lines(current, f"{landing}/{name}/{p.shifted(-1).as_of}", name, (BAD_LINES[name],))
        write_lines(current.limit(1), f"{landing}/{name}/{p.shifted(1).as_of}", name)
    return landing


def uploaded_lists(t: Tables, landing: str, as_of: dt.date) -> tuple[Tables, DataFrame]:
    """``t`` with its lists from the latest uploads on or before ``as_of``, and the lines that were set aside."""
    lists, rejected = {}, []
    for name in LISTS:
        day, path = latest_upload(t.spark, landing, name, as_of)
        rows, bad = check_upload(t.spark, path, name)
        stored = t.output_path("uploaded", name, day.isoformat())
        rows.write.mode("overwrite").parquet(stored)  # read once; reports of the week read columns
        lists[name] = t.spark.read.schema(rows.schema).parquet(stored)
        rejected.append(bad.select("list", F.lit(day).alias("upload_date"), "line", "record", "reason"))
    every = rejected[0]
    for bad in rejected[1:]:
        every = every.unionByName(bad)
    return t.with_lists(f"uploads-{as_of.isoformat()}", **lists), every


def report_from_uploads(t: Tables, p: ReportParams) -> DataFrame:
    """J-5 with country codes, roles, upsells and curves read from the CSV files of a landing folder."""
    landing = land_uploads(t, p, t.output_path("landing", "report"))
    return R.processing_and_backlog_report(uploaded_lists(t, landing, p.as_of)[0], p)


def rejected_uploads(t: Tables, p: ReportParams) -> DataFrame:
    """Lines of the uploads that count for the report date and could not be used, with the reason."""
    landing = land_uploads(t, p, t.output_path("landing", "rejected"))
    return uploaded_lists(t, landing, p.as_of)[1]


def team_role_maintenance(t: Tables, p: ReportParams, path: str | None = None) -> DataFrame:
    """J-12: store the maintained role table (missing owners added, stale rows removed) as a snapshot."""
    path = path or t.output_path("team_roles")
    write_snapshot(R.team_role_fix(t), path, p.as_of)
    return read_snapshot(t.spark, path, p.as_of)


def edited_roles(t: Tables, p: ReportParams, path: str | None = None, edits: DataFrame | None = None) -> DataFrame:
    """O-31, J-12: this week's edits applied to the stored role table of the week before, stored as this week's snapshot.

    A table without any snapshot first gets the latest upload on record as that of the week before.
    """
    path = path or t.output_path("edited_roles")
    edits = fixtures.role_edits(t.spark, t.source_dir) if edits is None else edits
    before = [d for d in snapshot_dates(t.spark, path) if d < p.as_of]
    if not before:
        before = [max(d for d in fixtures.ROLE_DATES if d < p.as_of)]
        write_snapshot(fixtures.team_role_on(t.spark, t.source_dir, before[0]), path, before[0])
    edited = R.apply_role_edits(read_snapshot(t.spark, path, before[-1]), edits)
    write_snapshot(edited, path, p.as_of, check=lambda rows: check_unique(rows, "sales_owner", "edited roles"))
    return read_snapshot(t.spark, path, p.as_of)


def data_checks(t: Tables, p: ReportParams) -> DataFrame:
    """S-3 and the dropped rows of the inner joins, counted while segments, J-5 and J-1 are written."""
    run, checks = t.with_lists("data-checks"), Checks()
    R.report_segments(run, "A", "A", True, checks=checks)
    for name, build in (("report", R.processing_and_backlog_report), ("deals", R.deal_signed_report)):
        write_snapshot(build(run, p, checks=checks), run.output_path("checked", name), p.as_of)
    return checks.table(t.spark)


def deal_level_export(t: Tables, p: ReportParams, path: str | None = None) -> DataFrame:
    """R-1: weekly deal-level CSV file (with header) beside the report; returns it read back."""
    path = path or t.output_path("deal_level_export")
    deals = R.deal_signed_report(t, p)
    schema = deals.schema.add(SNAPSHOT_COL, "date")
    publish(t.spark, path, p.as_of, lambda folder: deals.write.options(**CSV_WRITE).csv(folder),
            lambda folder: t.spark.read.schema(deals.schema).options(**CSV_READ).csv(folder).count())
    back = t.spark.read.schema(schema).options(**CSV_READ).csv(path)
    return back.filter(F.col(SNAPSHOT_COL) == F.lit(p.as_of))


def role_history(t: Tables, p: ReportParams, path: str | None = None) -> DataFrame:
    """Dated role-table snapshots up to the report date: the uploads of earlier dates, and this run's maintained table.

    A table without any snapshot first gets the uploads on record, oldest first.
    """
    path = path or t.output_path("role_history")
    if not snapshot_dates(t.spark, path):
        for date in fixtures.ROLE_DATES:
            if date < p.as_of:
                write_snapshot(fixtures.team_role_on(t.spark, t.source_dir, date), path, date)
    write_snapshot(R.team_role_fix(t), path, p.as_of)
    return t.spark.read.parquet(path).filter(F.col(SNAPSHOT_COL) <= F.lit(p.as_of))


def stored_dates(t: Tables, path: str, p: ReportParams) -> DataFrame:
    """Dates of a snapshot table up to the report date, those of empty snapshots too."""
    days = [(d,) for d in snapshot_dates(t.spark, path) if d <= p.as_of]
    return t.spark.createDataFrame(days, f"{SNAPSHOT_COL} date")


def role_intervals(t: Tables, p: ReportParams) -> DataFrame:
    """R-6: the stored role history as intervals: owner, role, team, valid_from, valid_to."""
    path = t.output_path("role_history")
    history = role_history(t, p, path)
    return fold_snapshots(history, "sales_owner", ("role", "team"), dates=stored_dates(t, path, p))


def deal_roles_as_of_close(t: Tables, p: ReportParams) -> DataFrame:
    """R-6: each deal's owner role and team as of the deal's close date, and since and until when the owner held them."""
    deals = t.opportunities.select("opportunity", "opportunity_owner", "opportunity_close_date")
    return join_as_of(deals, role_intervals(t, p), "opportunity_owner", "opportunity_close_date", "sales_owner", ("role", "team"))
