"""String helpers.

T-SQL `a + b` on strings yields NULL when either side is NULL; `F.concat` does the same, so
it is the right primitive (`concat_ws` would skip NULLs and change join keys).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourglass.functions.nulls import in_parameters


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def concat_null(*parts) -> Column:
    """NULL-propagating `a + b + ...`; Columns as given, Python strings as literals."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def left(c, n: int) -> Column:
    return F.substring(_c(c), 1, n)


def right(c, n: int) -> Column:
    return F.right(_c(c), F.lit(n))


def lacks_suffix(c, suffix: str = "C") -> Column:
    """`RIGHT(c, len) <> suffix`: NULL input gives NULL, so the row is filtered out."""
    return F.right(_c(c), F.lit(len(suffix))) != F.lit(suffix)


def lacks_suffix_like(c, suffix: str = "C") -> Column:
    """`c NOT LIKE '%suffix'`: same outcome as `lacks_suffix`, NULL drops the row."""
    return ~_c(c).endswith(suffix)


def first_char_in(c, values) -> Column:
    """`LEFT(c, 1) IN (values)`; `values=None` means no restriction."""
    return in_parameters(left(c, 1), values)


def number_text(c) -> Column:
    """`LTRIM(STR(n))`: number rounded to an integer, as text."""
    return F.round(_c(c).cast("double"), 0).cast("long").cast("string")


def spaces(n: int) -> Column:
    """`CAST(SPACE(n) AS varchar(n))`."""
    return F.lit(" " * n)
