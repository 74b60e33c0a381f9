"""Column helpers with the reports' semantics; all built-in expressions (codegen-friendly)."""

from hourglass.functions.strings import (  # noqa: F401
    concat_null, left, right, lacks_suffix, lacks_suffix_like, first_char_in, number_text, spaces,
)
from hourglass.functions.dates import (  # noqa: F401
    work_week_code, fiscal_month_code, mdy, add_days, add_weeks, add_months, year_text,
    to_date_col, month_label,
)
from hourglass.functions.nulls import isnull, min2, max2, in_list  # noqa: F401
