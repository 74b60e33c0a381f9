"""Calendar codes and date arithmetic.

Period codes are strings that sort in time order: work week `YYYYWWnn` (ISO week-numbering
year and week) and fiscal month `YYYYMM`. Range tests on them are string comparisons.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_date_col(c) -> Column:
    return F.to_date(_c(c))


def work_week_code(d) -> Column:
    d = _c(d)
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), d).cast("string"),
        F.lit("WW"),
        F.lpad(F.weekofyear(d).cast("string"), 2, "0"),
    )


def fiscal_month_code(d) -> Column:
    return F.date_format(_c(d), "yyyyMM")


def month_label(d) -> Column:
    """Monthly snapshot name such as `March 2017`."""
    return F.date_format(_c(d), "MMMM yyyy")


def mdy(d) -> Column:
    """`CONVERT(nvarchar(20), d, 101)`."""
    return F.date_format(_c(d), "MM/dd/yyyy")


def add_days(d, n) -> Column:
    return F.date_add(_c(d), n)


def add_weeks(d, n: int) -> Column:
    """`DATEADD(ww, n, d)` on a date."""
    return F.date_add(_c(d), 7 * n)


def add_months(d, n: int) -> Column:
    """`DATEADD(mm, n, d)`: clamps to the month's last day, no end-of-month snapping."""
    return F.add_months(_c(d), n)


def year_text(d) -> Column:
    return F.year(_c(d)).cast("string")
