"""Reusable DataFrame operators of the pay-grid job."""

from gridwright.operators.filters import (
    exclude_containing,
    exclude_equal,
    exclude_values,
    where_all,
    where_equal,
    where_null,
)
from gridwright.operators.latest import group_max, last_day_in_month, latest_per_group, with_group_max
from gridwright.operators.merge import check_key_types, fill_from, fill_value, left_merge
from gridwright.operators.quality import (
    distinct_where,
    duplicate_groups,
    first_n,
    first_n_then_sort,
    group_sizes,
    null_census,
    ordered_nulls_last,
)
from gridwright.operators.reduce import count_by, distinct_keys, expand_levels, union_levels
from gridwright.operators.sizing import broadcast_if_small, materialize, materialize_counted, small_side

__all__ = [
    "broadcast_if_small",
    "check_key_types",
    "count_by",
    "distinct_keys",
    "distinct_where",
    "duplicate_groups",
    "exclude_containing",
    "exclude_equal",
    "exclude_values",
    "expand_levels",
    "fill_from",
    "fill_value",
    "first_n",
    "first_n_then_sort",
    "group_max",
    "group_sizes",
    "last_day_in_month",
    "latest_per_group",
    "left_merge",
    "materialize",
    "materialize_counted",
    "null_census",
    "ordered_nulls_last",
    "small_side",
    "union_levels",
    "where_all",
    "where_equal",
    "where_null",
    "with_group_max",
]
