"""Weekly run: every report of a report date, written as dated snapshots.

Cluster entry point (``spark-submit -m``-style)::

    python -m ledgerline.plans.weekly_run --source <input folder> --out <output folder> --as-of 2000-01-02

The session comes from the cluster (``SparkSession.builder.getOrCreate()``,
so master, shuffle partitions and ``spark.checkpoint.dir`` are whatever the
cluster configures).  Each report lands in ``<out>/<report>/snapshot_date=<as_of>``;
re-running a week replaces only that week.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from ..operators.checks import Checks
from ..params import ReportParams
from ..sources.snapshots import write_snapshot
from ..sources.tables import Tables, load_tables
from ..sources.warehouse import UPLOADS, tables_from_paths
from . import jobs
from . import reports as R

REPORTS = {
    "processing_and_backlog": lambda t, p, checks: R.processing_and_backlog_report(t, p, checks=checks),
    "pipeline_forecast": lambda t, p, checks: R.pipeline_report(t, p),
    "deal_signed": lambda t, p, checks: R.deal_signed_report(t, p, checks=checks),
    "margin_first_year": lambda t, p, checks: R.margin_report(t, p),
    "weekly_processing": lambda t, p, checks: R.weekly_processing_snapshot(t, p),
    "weekly_upsell": lambda t, p, checks: R.weekly_upsell_snapshot(t, p),
}


def run_weekly(spark: SparkSession, source, out_dir: str, p: ReportParams) -> dict[str, str]:
    """Write every report for ``p.as_of``; returns report name -> table folder.

    ``source`` is the test-data folder, or a ``Tables`` object (for example
    from ``sources.warehouse.tables_from_paths``).
    """
    t = source if isinstance(source, Tables) else load_tables(spark, source)
    # this week's lists: what they go into is derived for this run
    t = t.with_lists("-".join(filter(None, (t.lists, f"run-{p.as_of.isoformat()}"))))
    checks = Checks()
    R.prepare_shared(t, checks)
    out_dir = out_dir.rstrip("/")
    paths = {}
    for name, build in REPORTS.items():
        paths[name] = f"{out_dir}/{name}"
        write_snapshot(build(t, p, checks), paths[name], p.as_of)
    paths["deal_level_export"] = f"{out_dir}/deal_level_export"
    jobs.deal_level_export(t, p, paths["deal_level_export"])
    # data checks beside the reports, counted while these were written
    paths["checks"] = f"{out_dir}/checks"
    write_snapshot(checks.table(spark), paths["checks"], p.as_of)
    return paths


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv=None) -> None:
    """Command line: parse dates and inputs, run the week, print the written folders."""
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--source", help="test-data folder (TPC-H style parquet tables)")
    ap.add_argument("--margin", help="margin facts (parquet); payments are read from it unless --payments is given")
    ap.add_argument("--payments", help="payment facts (parquet)")
    ap.add_argument("--merchants", help="merchant dimension (parquet)")
    ap.add_argument("--opportunities", help="CRM table (parquet)")
    ap.add_argument("--uploads", help="folder with the uploaded lists as CSV: " + ", ".join(UPLOADS))
    ap.add_argument("--out", required=True, help="output folder (shared storage)")
    ap.add_argument("--as-of", type=_date, required=True, help="report date, yyyy-mm-dd")
    defaults = ReportParams()
    for name in ("history_start", "report_start", "horizon_end", "fy_start", "fy_end", "pipeline_cutoff", "run_date"):
        ap.add_argument("--" + name.replace("_", "-"), type=_date, default=getattr(defaults, name))
    ap.add_argument("--exclude-roles", default="", help="comma-separated team roles to leave out")
    a = ap.parse_args(argv)
    if not a.source:
        missing = [f"--{n}" for n in ("margin", "merchants", "opportunities", "uploads") if not getattr(a, n)]
        if missing:
            ap.error("without --source, these are needed: " + ", ".join(missing))
    p = ReportParams(as_of=a.as_of, history_start=a.history_start, report_start=a.report_start,
                     horizon_end=a.horizon_end, fy_start=a.fy_start, fy_end=a.fy_end,
                     pipeline_cutoff=a.pipeline_cutoff, run_date=a.run_date,
                     exclude_roles=tuple(r for r in a.exclude_roles.split(",") if r))
    spark = SparkSession.builder.appName("ledgerline-weekly").getOrCreate()
    if a.source:
        source = a.source
    else:
        paths = {k: getattr(a, k) for k in ("margin", "payments", "merchants", "opportunities") if getattr(a, k)}
        paths.update({name: f"{a.uploads.rstrip('/')}/{name}" for name in UPLOADS})
        source = tables_from_paths(spark, paths)
    for name, path in run_weekly(spark, source, a.out, p).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
