"""Plan shape: what the physical plans of the registered queries must (not) contain."""

import pytest
from pyspark.errors import PySparkException

import __spark_entry__ as entry
from conftest import SF001
from daybook.params import ReportParams
from daybook.plans.catalog import QUERIES
from daybook.plans.report import build_report
from daybook.sources.config import config_lookup
from daybook.sources.loan_model import loan_tables

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_and_no_pair_explosion(spark, name):
    plan = plan_of(QUERIES[name](spark, SF001))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"


def test_report_shuffles_the_order_side_once_at_scale(spark):
    """With broadcasts off (sizes as on a cluster), the bill, extension and
    history joins reuse the order-id partitioning of the reported orders."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = build_report(loan_tables(spark, SF001), ReportParams())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    a_shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning(a_uuid" in line]
    assert len(a_shuffles) == 1, a_shuffles
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    # the orders scan of the reported side reads only the columns it needs
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_config_lookup_collapses_copies(spark):
    rows = [("g", "a", "1", i) for i in range(50)] + [("g", "a", "0", 99), ("g", "b", "x", 1), ("h", "a", "y", 1)]
    long = spark.createDataFrame(rows, "group string, name string, value string, at int")
    got = {r["group"]: dict(r["attributes"]) for r in config_lookup(long, "at").collect()}
    assert got == {"g": {"a": "0", "b": "x"}, "h": {"a": "y"}}  # the last value of a name
    got = {r["group"]: dict(r["attributes"]) for r in config_lookup(long.where("at < 60")).collect()}
    assert got == {"g": {"a": "1", "b": "x"}, "h": {"a": "y"}}
    with pytest.raises(PySparkException, match="conflicting values of attribute a in group g"):
        config_lookup(long).collect()


@pytest.mark.parametrize("name", ["filter_report_day", "filter_last_7_days", "daily_counts", "order_by_ordinal"])
def test_history_queries_read_the_stored_snapshot(spark, name):
    """One pruned scan of the written table; no report is rebuilt."""
    plan = plan_of(QUERIES[name](spark, SF001))
    assert "PartitionFilters: [isnotnull(tgl_pelaporan_data" in plan
    assert "Join" not in plan and plan.count("FileScan") == 1


def test_filters_reach_the_scans_of_stored_tables(spark):
    """With the operational tables stored as parquet (as in a deployment),
    the report's base filters are pushed into the scans."""
    import dataclasses

    from daybook.session import scratch_path

    t = loan_tables(spark, SF001)
    stored = {}
    for name in ("order", "user", "history", "bill"):
        path = scratch_path(spark, f"t-{name}")
        getattr(t, name).write.parquet(path)
        stored[name] = spark.read.parquet(path)
    t = dataclasses.replace(t, **stored)
    plan = build_report(t, ReportParams())._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.split("\n") if "PushedFilters" in line]
    text = " ".join(pushed)
    assert "EqualTo(disabled,0)" in text  # enabled orders / borrowers
    assert "In(status, [10,11,7,8])" in text  # reported statuses
    assert "In(orderType, [0,2,3])" in text  # reported types
    assert "EqualTo(billTerm,3)" in text and "EqualTo(billTerm,1)" in text  # one term per bill join
    assert "EqualTo(status,20)" in text  # agreement history rows


def test_backfill_runs_the_joins_once_for_all_days(spark):
    """Eight report days in one plan: the order side is shuffled once and no
    table is read more often than for a single day (no per-day plans)."""
    import datetime as dt

    from daybook.plans.report import build_report_days

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t = loan_tables(spark, SF001)
        rep = ReportParams().rep
        one = plan_of(build_report(t, ReportParams()))
        eight = plan_of(build_report_days(t, rep - dt.timedelta(days=7), rep))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert eight.count("Exchange hashpartitioning(a_uuid") == 1
    assert eight.count("FileScan parquet") == one.count("FileScan parquet")
    assert "Generate explode" in eight  # the days are a generator, not a join


def test_backfill_repeats_rows_per_day_after_all_joins(spark):
    """No join's sort or shuffle holds a row once per day."""
    import datetime as dt

    from daybook.plans.report import build_report_days

    t, rep = loan_tables(spark, SF001), ReportParams().rep
    plan = build_report_days(t, rep - dt.timedelta(days=7), rep)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode([") < plan.index("Join ")


def test_history_is_written_with_partitions_for_its_input(spark, monkeypatch):
    """However few shuffle partitions are set, a task's share stays the same."""
    from daybook.plans import catalog
    from daybook.session import INPUT_PER_PARTITION

    count, seen = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(count)
    monkeypatch.setattr(catalog, "_state", lambda *_: (("a", 300 * INPUT_PER_PARTITION, 1), ("b", 1, 1)))
    monkeypatch.setattr(catalog, "_STORED", {})
    monkeypatch.setattr(catalog.snapshot, "replace_snapshot", lambda spark, *_: seen.append(int(spark.conf.get(count))))
    monkeypatch.setattr(catalog.snapshot, "read_snapshot", lambda spark, path, schema: spark.createDataFrame([], schema))
    catalog._history(spark, SF001)
    catalog._written_snapshot(spark, SF001)
    assert seen == [301, 301, 301] and spark.conf.get(count) == before
