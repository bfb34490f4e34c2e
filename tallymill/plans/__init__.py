from . import charts, reports
from .jobs import (
    analysis_job,
    benchmark_counts,
    benchmark_increment,
    benchmark_job,
    benchmark_store,
    prepare_job,
    refresh_years,
    split_benchmark_job,
)
from .rollup import incident_rollup, report_base, rollup_slice, slice_counts

__all__ = [
    "analysis_job",
    "benchmark_counts",
    "benchmark_increment",
    "benchmark_job",
    "benchmark_store",
    "charts",
    "incident_rollup",
    "prepare_job",
    "refresh_years",
    "report_base",
    "reports",
    "rollup_slice",
    "slice_counts",
    "split_benchmark_job",
]
