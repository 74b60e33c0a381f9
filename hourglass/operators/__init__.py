"""Reusable relational operators."""

from hourglass.operators.relational import (  # noqa: F401
    top1_per_group, first_source_rows, keys_in_no_list, null_aware_anti_join, update_from_join, conform, append_typed,
    template_row, union_distinct,
)
from hourglass.operators.joins import asof_max, join_to_few, pre_aggregated_join, range_join_days  # noqa: F401
from hourglass.operators.aggregates import conditional_sums, pre_sum, sum_of, two_level_ratio, week_bits  # noqa: F401
from hourglass.operators.windows import ordinal, running_total  # noqa: F401
from hourglass.operators.pivot import dynamic_pivot, month_steps  # noqa: F401
from hourglass.operators.ordered import asof_max_by_ranges, ordinal_by_ranges, running_total_by_ranges  # noqa: F401
