"""Plan shapes: what is scanned, exchanged and reused."""

from plans_helper import plan_of

from tallymill.operators import dedup_by_key, flag_counts, flag_summary, profile
from tallymill.plans import incident_rollup, report_base, reports, rollup_slice, slice_counts
from tallymill.sinks import shared_folder, write_partitioned
from tallymill.sources import FLAG_COLUMNS
from tallymill.workloads import QUERIES
from tallymill.workloads.standin import cleaned_incidents, table

import pytest


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    path = shared_folder(spark)
    write_partitioned(cleaned_incidents(spark, sf_dir), path)
    return spark.read.parquet(path)


def final(plan: str) -> str:
    """The final plan only, without the plans it started from."""
    kept, skip = [], False
    for line in plan.splitlines():
        if "== Initial Plan ==" in line:
            skip, depth = True, line.index("== Initial")
        elif skip and (len(line) - len(line.lstrip(" :+-"))) < depth:
            skip = False
        if not skip:
            kept.append(line)
    return "\n".join(kept)


def test_share_of_total_scans_once(stored):
    """The grand total reuses the report's first exchange: one scan of the data."""
    plan = final(plan_of(reports.state_summary(slice_counts(stored, "place"))))
    assert "ReusedExchange" in plan and "Subquery" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_report_reads_only_its_columns(stored):
    plan = slice_counts(stored, "weather")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Severity:int,Weather_Condition:string>" in plan


def test_year_filter_prunes_partitions(stored):
    plan = stored.filter("Year = 1996").select("State")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan


def test_top_k_is_not_a_full_sort(stored):
    assert "TakeOrderedAndProject" in plan_of(reports.top_cities(slice_counts(stored, "place")))


def test_dedup_limits_groups_before_the_exchange(spark, sf_dir):
    frame = dedup_by_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    before = plan.index("Partial", plan.index("Exchange hashpartitioning"))
    assert plan.count("WindowGroupLimit") == 2 and before > 0
    assert plan.count("Exchange hashpartitioning") == 1


def test_rollup_is_one_scan_for_all_reports(stored):
    plan = incident_rollup(report_base(stored))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_flags_unpivot_after_counting(stored):
    counts = flag_counts(stored, FLAG_COLUMNS)
    plan = flag_summary(counts, FLAG_COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.index("Generate inline") < plan.rindex("HashAggregate")


def test_profile_does_not_carry_buffers_with_the_key(stored):
    plan = final(plan_of(profile(stored)))
    keyed = [line for line in plan.splitlines() if "Exchange hashpartitioning(ID" in line]
    assert len(keyed) == 1 and "ReadSchema: struct<ID:string>" in plan


def test_no_python_workers_anywhere(spark, sf_dir):
    for name in ("state_summary", "quality_summary", "clean_rows", "incident_rollup", "road_feature_summary"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_slices_of_the_rollup_are_the_direct_counts(stored):
    rollup = incident_rollup(report_base(stored))
    for name in ("place", "time", "weather", "feature"):
        a, b = rollup_slice(rollup, name), slice_counts(stored, name)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
