"""Report parameters (the scripts' @rp* variables) as frozen dataclasses.

Multi-valued parameters are tuples; `None`, the default, means "no restriction", which a
report server cannot express but a library user needs.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values that must equal the reference's for equal results:
# base year per resource-profile report mode ('1'..'4'); other modes use the as-of year.
REPORT_BASE_YEAR = {"1": "2015", "2": "2018", "3": "2020", "4": "2022"}
# Modes whose year axis runs from base-3 to base+10 and that clamp at both ends.
WIDE_MODES = ("0", "5")
# Modes whose axis runs from base to base+10 and clamp only below.
NARROW_MODES = ("1", "2", "3", "4")


@dataclass(frozen=True)
class ReportParams:
    """Parameters of the earned-value report."""

    period_type: str = "Weekly"
    period: dt.date = dt.date(2017, 6, 2)
    projects: tuple[str, ...] | None = None
    piepccc: tuple[str, ...] | None = None
    baseline_type: str = "Approved"
    group: str = "Bundle"
    live_offset_days: int = 1
    # the scripts' constant bucket for burn-rate rows
    burn_week: str = "2019WW01"
    safe_finish: bool = False
    # how strings are compared: 'binary', or 'case_blind' (see sources.comparison)
    comparison: str = "binary"


@dataclass(frozen=True)
class ResolvedPeriods:
    """Scalars resolved before the ledger is built (all may be None)."""

    period: dt.date | None
    last_period: dt.date | None
    last2_period: dt.date | None
    period_week: str | None
    last_period_week: str | None
    last2_period_week: str | None


@dataclass(frozen=True)
class ProfileParams:
    """Parameters of the resource profile."""

    cw: dt.date | None = None
    projects: tuple[str, ...] | None = None
    report: str = "0"
    outage_segments: tuple[str, ...] | None = None
    piepccc: tuple[str, ...] | None = None
    resources: tuple[str, ...] | None = None
    graph_start: str = "201001"
    graph_end: str = "202701"
    as_of: dt.date = field(default_factory=dt.date.today)
    comparison: str = "binary"

    @property
    def base_year(self) -> str:
        return REPORT_BASE_YEAR.get(self.report, str(self.as_of.year))
