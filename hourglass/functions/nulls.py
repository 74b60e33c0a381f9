"""NULL-aware helpers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def isnull(x, default) -> Column:
    """`ISNULL(x, default)`."""
    d = F.lit(default) if not isinstance(default, Column) else default
    return F.coalesce(_c(x), d)


def min2(a, b) -> Column:
    """`CASE WHEN a < b THEN a ELSE b END`: a NULL on either side yields b.

    Not `least`, which skips NULLs.
    """
    a, b = _c(a), _c(b)
    return F.when(a < b, a).otherwise(b)


def max2(a, b) -> Column:
    """`CASE WHEN a > b THEN a ELSE b END`."""
    a, b = _c(a), _c(b)
    return F.when(a > b, a).otherwise(b)


#: longer lists are joined as a table instead of being written into the plan
LITERALS = 1_000


def parameter_table(values) -> DataFrame:
    """A parameter list as a relation of one column; a DataFrame's first column as it is."""
    if isinstance(values, DataFrame):
        return values.select(values.columns[0])
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(pa.table({"value": pa.array(list(values), pa.string())}))


def in_parameters(x: Column, values) -> Column:
    """`x IN (@multi)` for a condition of a filter; `None` means the parameter does not
    restrict. A long list, or a parameter given as a DataFrame, is an IN subquery: Spark plans
    a semi-join with it. NULLs as in SQL: a NULL `x` or a NULL in the list matches nothing."""
    if values is None:
        return F.lit(True)
    if isinstance(values, str):  # one value given bare, not a list of characters
        values = (values,)
    if isinstance(values, DataFrame) or len(values) > LITERALS:
        return x.isin(parameter_table(values))
    return x.isin(list(values))


def in_list(c, values) -> Column:
    """`c IN (@multi)`."""
    return in_parameters(_c(c), values)
