"""Run parameters.

The reference binds its dates as script variables and reads ``CURRENT_DATE()``
in two different scripts. Here every date is an explicit field of one frozen
dataclass, so a run is reproducible and the tenure threshold and the tenure
buckets always see the same ``as_of``.
"""

from __future__ import annotations

import calendar
import dataclasses
import datetime as dt

Date = dt.date


def last_day_of_month(d: Date) -> Date:
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


@dataclasses.dataclass(frozen=True)
class Params:
    # "today" of the run; the tenure threshold is as_of - tenure_days
    as_of: Date = Date(2020, 12, 8)
    tenure_days: int = 7
    # adopter_group split (pre / during)
    campaign_start_date: Date = Date(2020, 7, 29)
    # engagement KPIs: plays in [campaign_start_period, + analysis_window days)
    campaign_start_period: Date = Date(2020, 12, 1)
    # None = through the last day of campaign_start_period's month (as the code does)
    analysis_window_days: int | None = None
    # save rate window (inclusive)
    save_report_start: Date = Date(2020, 12, 1)
    save_report_end: Date = Date(2020, 12, 31)
    # winback month start; the end is the last day of that month
    winback_report_start: Date = Date(2020, 12, 1)
    # service launch: floor on report_date in both lapse queries
    launch_date: Date = Date(2020, 7, 29)
    save_signup_floor: Date = Date(2020, 6, 21)
    winback_signup_floor: Date = Date(2020, 7, 29)
    # lapse bands in days
    save_gap_min: int = 15
    save_gap_max: int = 29
    winback_gap_min: int = 30
    alpha: float = 0.05
    # a cohort/tenure group without one of the arms: 'skip' it or raise an 'error'
    on_missing_arm: str = "skip"
    # the day tenure is counted to; None = as_of
    tenure_as_of: Date | None = None
    # opt-in corrections of reference behaviour (defaults are faithful)
    exclude_braze: bool = False
    dedupe_audience: bool = False
    # Also filter plays on adobe_date for partition pruning, with a margin of
    # days around the window; a run stops if a play of the window lies beyond it.
    prune_on_play_date: bool = False
    play_date_margin_days: int = 1

    def __post_init__(self):
        if self.on_missing_arm not in ("skip", "error"):
            raise ValueError(f"on_missing_arm: {self.on_missing_arm}")

    @property
    def status_start(self) -> Date:
        """First report date a derived daily status needs: winback looks back to the launch."""
        return min(self.launch_date, self.save_report_start, self.winback_report_start)

    @property
    def status_end(self) -> Date:
        return max(self.save_report_end, self.winback_report_end)

    @property
    def last_return_day(self) -> Date:
        """Last play day that status, save rate or winback rate looks at."""
        return max(self.status_end, self.save_report_end + dt.timedelta(days=self.save_gap_max))

    @property
    def tenure_date(self) -> Date:
        return self.tenure_as_of or self.as_of

    @property
    def tenure_threshold(self) -> Date:
        return self.as_of - dt.timedelta(days=self.tenure_days)

    @property
    def window_days(self) -> int:
        if self.analysis_window_days is not None:
            return self.analysis_window_days
        s = self.campaign_start_period
        return (last_day_of_month(s) - s).days + 1

    @property
    def window_end_exclusive(self) -> Date:
        return self.campaign_start_period + dt.timedelta(days=self.window_days)

    @property
    def winback_report_end(self) -> Date:
        return last_day_of_month(self.winback_report_start)

    @property
    def winback_signup_ceiling(self) -> Date:
        return self.winback_report_start - dt.timedelta(days=1)

    def with_custom_window_end(self, custom_end_exclusive: Date) -> "Params":
        """The checklist's override: window = days from start to (end + 1 day)."""
        days = (custom_end_exclusive - self.campaign_start_period).days
        return dataclasses.replace(self, analysis_window_days=days)

    def replace(self, **kw) -> "Params":
        return dataclasses.replace(self, **kw)


# Parameters that go with the test fixtures built from the driver's tables
# (see FIXTURES.md). The driver's line items ship between 1995 and 2001, so the
# report month is March 1996.
FIXTURE_PARAMS = Params(
    as_of=Date(1996, 4, 3),
    campaign_start_date=Date(1996, 3, 1),
    campaign_start_period=Date(1996, 3, 1),
    save_report_start=Date(1996, 3, 1),
    save_report_end=Date(1996, 3, 31),
    winback_report_start=Date(1996, 3, 1),
    launch_date=Date(1995, 7, 29),
    save_signup_floor=Date(1995, 6, 21),
    winback_signup_floor=Date(1995, 7, 29),
)
