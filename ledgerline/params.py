"""Report parameters.

The SQL this library re-expresses edits literal dates inside each script
before every run (report date, history start, horizon, fiscal year).
Here they are one immutable object passed to every job, so no library code
reads the wall clock.
"""

from __future__ import annotations

import dataclasses
import datetime as dt


@dataclasses.dataclass(frozen=True)
class ReportParams:
    # report date: actuals are captured strictly before it, backlog starts on it
    as_of: dt.date = dt.date(2000, 1, 2)
    # first capture date read for actuals (inclusive)
    history_start: dt.date = dt.date(1995, 1, 1)
    # first capture / forecast date shown in the weekly reports (inclusive)
    report_start: dt.date = dt.date(1999, 1, 1)
    # last expected go-live date taken into the pipeline (inclusive)
    horizon_end: dt.date = dt.date(2000, 12, 31)
    # activations on or after this date count as new NPV
    fy_start: dt.date = dt.date(1999, 1, 1)
    # backlog forecast days on or before this date count as new NPV
    fy_end: dt.date = dt.date(2000, 12, 31)
    # lag (days) from the report date to the week flagged as "this week"
    this_week_lag_days: int = 3
    # lag (days) from the report date to the quarter of "in quarter" deals
    in_quarter_lag_days: int = 5
    # team roles left out of reports (request: leave out AM until role history exists)
    exclude_roles: tuple[str, ...] = ()
    # first go-live day (and "not yet live" test) of the pipeline; the report date when unset
    pipeline_cutoff: dt.date | None = None

    # the day the pipeline report is run, for its "this week" and "in quarter" flags; the report date when unset
    run_date: dt.date | None = None

    @property
    def run_day(self) -> dt.date:
        return self.run_date or self.as_of

    @property
    def cutoff(self) -> dt.date:
        return self.pipeline_cutoff or self.as_of

    def shifted(self, days: int) -> "ReportParams":
        """Same parameters with the report date moved by ``days``."""
        return dataclasses.replace(self, as_of=self.as_of + dt.timedelta(days=days))

    def with_(self, **changes) -> "ReportParams":
        return dataclasses.replace(self, **changes)


# the pipeline report of the default run is made seven weeks after its cutoff
DEFAULT_PARAMS = ReportParams(run_date=dt.date(2000, 2, 20))
