"""String comparison without regard to case and trailing blanks, as an option of the reports.

Spark compares strings byte by byte. A database whose collation ignores case, and which pads
before it compares, finds more matches: in joins, filters, groups and parameter lists. With
`comparison=CASE_BLIND` the sources are given with their compared columns as normalised keys
(upper case, trailing blanks off), so that every join, filter and group below stays an
ordinary one on plain columns: no collation, no function in a join condition, and pruning
and pushed filters on snapshots as before. What is shown as it was written stands beside its key
(`<column>__written`).

Trailing blanks count inside functions, as they do there: `RIGHT(x, 1)` of `'12C '` is a blank,
and `Project + wbs` keeps the blanks in its middle. So a column that is only sliced is
folded in case alone, and a computed join key is made of the columns as they came, then
normalised (`FEED_KEY`).
"""

from __future__ import annotations

from dataclasses import fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import concat_null
from hourglass.sources.catalog import ProjectSources

BINARY, CASE_BLIND = "binary", "case_blind"
#: suffix of a column that holds what a key column was made of
WRITTEN = "__written"
#: normalised `Project + wbs` of the feeds that are joined on it
FEED_KEY = "_feed_key"

# How the reports spell the codes they compare with, by column.
SPELLINGS = {
    "PeriodType": ("Daily", "Weekly", "Monthly", "Quarter", "Year"),
    "Snapshot_Period": ("Live",),
    "Activity_Type": ("TT_WBS", "TT_Task", "TT_LOE"),
    "BR_Resource_Type": ("RT_Labor",),
    "BaselineType": ("Approved", "Recovery", "Original", "Homer"),
    "Approval_Status": ("APPROVED", "NEGATED", "PENDING"),
    "FinSourceSystemDesc": ("Tempus",),
}
GROUPS = ("Project", "Bundle", "Vendor", "Strat III", "Strat IV")
# Columns that the reports join, filter or group by.
KEYS = ("BR_ProjectNumber", "ProjectNumber", "Project", "project_no", "Project_ID", "Activity_ID", "Activity_Name", "BR_PIEPCCC",
        "BR_CM_ACTIVITY_LEVEL_Val", "BR_NR_LOE_WORK_Val", "BR_NR_OUTAGE_SEGMENT_Val", "BR_L2WorkPackage", "WorkPackage", "wp",
        "line_code", "alter_cost_c1_", "wbs", "WBS", "Local", "Resource_ID", "BR_WorkWeek", "WorkWeek", "FiscalWeek", "FiscalMonth",
        "BR_FiscalMonth")
SLICED = ("BR_NR_EXECUTION_WINDOWS_Val",)
SHOWN = {"activity_l2_daily": ("Activity_ID", "Activity_Name"), "activity_l2_weekly": ("Activity_ID", "Activity_Name")}
FEEDS = {"actual_hour": "wbs", "timesheet": "WBS"}


def key_of(c: Column) -> Column:
    """The key of a string; NULL has none."""
    return F.upper(F.rtrim(c))


def spelled(c: Column, spellings: tuple[str, ...]) -> Column:
    """A code as the reports spell it; another code's key."""
    key = key_of(c)
    out = None
    for s in spellings:
        out = F.when(key == s.upper(), s) if out is None else out.when(key == s.upper(), s)
    return out.otherwise(key)


def _view(name: str, df: DataFrame) -> DataFrame:
    made = {}
    for f in df.schema.fields:
        if not isinstance(f.dataType, T.StringType):
            continue
        c = F.col(f.name)
        if f.name in SPELLINGS:
            made[f.name] = spelled(c, SPELLINGS[f.name])
        elif f.name in KEYS:
            made[f.name] = key_of(c)
        elif f.name in SLICED:
            made[f.name] = F.upper(c)
        elif f.name == "SnapshotPeriod":
            made[f.name] = F.initcap(c)  # the names of months, which are matched by prefix
    beside = [F.col(c).alias(c + WRITTEN) for c in SHOWN.get(name, ()) if c in made]
    if name in FEEDS:
        beside.append(key_of(concat_null(F.col("Project"), F.col(FEEDS[name]))).alias(FEED_KEY))
    return df.select(*[made[c].alias(c) if c in made else F.col(c) for c in df.columns], *beside)


def compared_sources(src: ProjectSources, comparison: str) -> ProjectSources:
    """The sources as a report with this comparison reads them; as they are for `BINARY`."""
    if comparison == BINARY:
        return src
    if comparison != CASE_BLIND:
        raise ValueError(f"no comparison named {comparison!r}: {BINARY!r} or {CASE_BLIND!r}")
    views = {f.name: getattr(src, f.name) for f in fields(src)}
    return replace(src, **{name: _view(name, df) for name, df in views.items() if df is not None})


def _list(values):
    if values is None:
        return None
    if isinstance(values, DataFrame):
        return values.select(key_of(F.col(values.columns[0])).alias(values.columns[0]))
    if isinstance(values, str):
        values = (values,)
    return tuple(None if v is None else v.rstrip(" ").upper() for v in values)


def _choice(value: str, spellings: tuple[str, ...]) -> str:
    return next((s for s in spellings if s.upper() == value.rstrip(" ").upper()), value)


#: parameters that are lists, and those that pick one of fixed values
LISTS = ("projects", "piepccc", "outage_segments", "resources")
CHOICES = {"period_type": SPELLINGS["PeriodType"], "baseline_type": SPELLINGS["BaselineType"], "group": GROUPS}


def compared_params(params):
    """Report parameters as they are compared: lists as keys, choices as the reports spell them."""
    if params.comparison == BINARY:
        return params
    names = {f.name for f in fields(params)}
    return replace(params, **{n: _list(getattr(params, n)) for n in LISTS if n in names},
                   **{n: _choice(getattr(params, n), s) for n, s in CHOICES.items() if n in names})
