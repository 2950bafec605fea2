"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Each key is one item of the operator inventory.  Every callable reads the
staged report tables derived from the driver's parquet files in ``sf_dir``
and runs over the whole tables with the default ``ReportParams``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..params import DEFAULT_PARAMS, ReportParams
from ..sources.tables import Tables, load_tables
from . import reports as R

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Callable[[Tables, ReportParams], DataFrame]] = {}


def register(key: str):
    """Decorator: register ``fn(tables, params)`` under ``key``."""
    def deco(fn):
        REGISTRY[key] = fn
        return fn
    return deco


def _bind(fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_tables(spark, sf_dir), DEFAULT_PARAMS)
    run.__name__ = fn.__name__
    return run


def queries() -> dict[str, QueryFn]:
    """Every registered query as ``(spark, sf_dir) -> DataFrame`` with the default parameters."""
    from . import catalog  # noqa: F401  (registers the operator-level queries)
    return {k: _bind(v) for k, v in REGISTRY.items()}


register("processing_report")(R.processing_report)
register("backlog_report")(R.backlog_report)
register("processing_and_backlog_report")(R.processing_and_backlog_report)
register("backlog_daily")(R.backlog_daily)
register("pipeline_forecast_report")(R.pipeline_report)
register("pipeline_daily")(R.pipeline_daily)
register("deal_signed_report")(R.deal_signed_report)
register("margin_first_year_report")(R.margin_report)

from . import jobs as J  # noqa: E402

register("weekly_processing_snapshot")(J.weekly_processing_snapshot_job)
register("weekly_upsell_snapshot")(J.weekly_upsell_snapshot_job)
register("snapshot_rotation")(J.two_weekly_runs)
register("snapshot_changes")(J.change_since_midweek)
register("upsell_table_rotation")(J.upsell_table_rotation)
register("report_from_uploads")(J.report_from_uploads)
register("rejected_uploads")(J.rejected_uploads)
register("team_role_maintenance")(J.team_role_maintenance)
register("edited_roles")(J.edited_roles)
register("data_checks")(J.data_checks)
register("deal_level_export")(J.deal_level_export)
register("owners_missing_role")(lambda t, p: R.owners_missing_role(t))
register("team_role_upsert")(lambda t, p: R.team_role_fix(t))
register("role_intervals")(J.role_intervals)
register("deal_roles_as_of_close")(J.deal_roles_as_of_close)
