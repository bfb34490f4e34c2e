from .checks import dimension_check, five_way_check, input_counts, pass_fail, reconcile
from .flags import flag_counts, flag_mask, flag_summary, flag_summary_union, flag_summary_unpivot
from .quality import distinct_metrics, missing_values, profile, quality_summary, validation
from .rows import apply_rules, clean, clean_rows, dedup_by_key, derive, retype_times, row_rule
from .runs import run_facts, run_metrics, run_summary, run_table, side_by_side, timed
from .summaries import (
    combination_counts,
    dimension_counts,
    dimension_table,
    grouping_counts,
    grouping_counts_sql,
    having_min,
    level_counts,
    mean_columns,
    summarize,
    top_ascending,
    top_k,
    value_counts,
)

__all__ = [
    "apply_rules",
    "clean",
    "clean_rows",
    "combination_counts",
    "dedup_by_key",
    "derive",
    "dimension_check",
    "dimension_counts",
    "dimension_table",
    "distinct_metrics",
    "five_way_check",
    "flag_counts",
    "flag_mask",
    "flag_summary",
    "flag_summary_union",
    "flag_summary_unpivot",
    "grouping_counts",
    "grouping_counts_sql",
    "having_min",
    "input_counts",
    "level_counts",
    "mean_columns",
    "missing_values",
    "pass_fail",
    "profile",
    "quality_summary",
    "reconcile",
    "retype_times",
    "row_rule",
    "run_facts",
    "run_metrics",
    "run_summary",
    "run_table",
    "side_by_side",
    "summarize",
    "timed",
    "top_ascending",
    "top_k",
    "value_counts",
]
