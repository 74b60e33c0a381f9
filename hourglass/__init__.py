"""hourglass: project-controls reporting (earned value, resource profiles, snapshot
matrices) written as Spark DataFrame plans.

Layers:
  functions/  column-level helpers with T-SQL report semantics (NULL-propagating concat,
              suffix tests, period codes, NULL-sensitive min/max)
  operators/  reusable relational operators (top-1 per group as a partial aggregate,
              null-aware anti join, range join via exploded days, typed ledger append,
              conditional-sum pivots, dynamic pivots, running totals)
  sources/    table catalog, snapshot-scoped scans, driver-table stand-ins
  plans/      the report pipelines built from the operators (period calendar, ledger,
              earned value, resource profile, snapshot month matrix)
"""

from hourglass.params import ReportParams, ResolvedPeriods, ProfileParams  # noqa: F401

__all__ = ["ReportParams", "ResolvedPeriods", "ProfileParams"]
