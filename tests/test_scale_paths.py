"""The cluster-scale plan paths: sort-merge joins instead of broadcasts, and
AQE splitting a hot borrower key."""

import dataclasses

import pytest
from pyspark.sql import functions as F

import oracles
from conftest import SF001, SF01
from daybook.params import ReportParams
from daybook.plans.present import comparable
from daybook.plans.report import build_report
from daybook.sources.loan_model import loan_tables
from util import assert_same, spark_rows


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_sort_merge_path_equals_oracle(no_broadcast, duck001):
    df = comparable(build_report(loan_tables(no_broadcast, SF001), ReportParams()))
    assert_same(df, duck001, oracles.report_sql())


SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_borrower_is_split_by_aqe(no_broadcast):
    spark = no_broadcast
    t = loan_tables(spark, SF01)
    hot = t.order.withColumn("userUuid", F.when(F.col("uuid") % 3 == 0, F.lit(7)).otherwise(F.col("userUuid")))
    t = dataclasses.replace(t, order=hot)
    expected = spark_rows(build_report(t, ReportParams()))
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = build_report(t, ReportParams())
        got = spark_rows(df)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == expected
    assert "skew=true" in plan, plan[:2000]


def test_bucketed_tables_join_without_shuffling_orders_or_bills(no_broadcast, duck001):
    """Operational tables stored bucketed by order id: the order side and
    the three bill joins read matching buckets side by side (no exchange)."""
    import uuid

    from daybook.session import scratch_path
    from daybook.sources.loan_model import read_catalog_loan_tables, write_bucketed_loan_tables

    spark = no_broadcast
    names = write_bucketed_loan_tables(
        loan_tables(spark, SF001), scratch_path(spark, "t-bucketed"), 8, prefix=f"t{uuid.uuid4().hex[:8]}_"
    )
    df = build_report(read_catalog_loan_tables(spark, names), ReportParams())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(a_uuid" not in plan
    assert not any(f"Exchange hashpartitioning({p}_orderNo" in plan for p in ("d", "d1", "d2"))
    # the history (the largest table) is never shuffled either
    assert "Exchange hashpartitioning(orderId" not in plan and "Exchange hashpartitioning(c_orderId" not in plan
    exchanges = sorted(line.split("hashpartitioning(")[1].split("#")[0] for line in plan.split("\n") if "Exchange hashpartitioning(" in line)
    assert exchanges == ["a_userUuid", "b_uuid", "e_orderNo"], exchanges
    assert_same(comparable(df), duck001, oracles.report_sql())
