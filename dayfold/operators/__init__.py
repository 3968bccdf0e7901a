"""Aggregations, combines, joins and clean-up steps."""

from dayfold.operators.aggregate import (
    category_sums,
    cross_join_count,
    find_duplicates,
    group_metrics,
)
from dayfold.operators.bitmaps import (
    count_bitmaps,
    merge_bitmaps,
    number_terms,
    rolling_distinct,
    term_bitmaps,
)
from dayfold.operators.clean import (
    add_ratios,
    drop_incomplete,
    fill_zero,
    preview_rows,
    rename_column,
    select_ordered,
    tag_date,
)
from dayfold.operators.collect import group_collect
from dayfold.operators.combine import (
    Categories,
    DistinctCounts,
    Metric,
    combine_sources,
    metric_names,
    outer_combine,
)
from dayfold.operators.join import attach_dimension, theta_join

__all__ = [
    "Categories",
    "DistinctCounts",
    "Metric",
    "add_ratios",
    "attach_dimension",
    "category_sums",
    "combine_sources",
    "count_bitmaps",
    "cross_join_count",
    "drop_incomplete",
    "fill_zero",
    "find_duplicates",
    "group_collect",
    "group_metrics",
    "merge_bitmaps",
    "metric_names",
    "number_terms",
    "outer_combine",
    "preview_rows",
    "rename_column",
    "rolling_distinct",
    "select_ordered",
    "tag_date",
    "term_bitmaps",
    "theta_join",
]
