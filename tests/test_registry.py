"""Every registered query runs at sf0.001 and equals its DuckDB oracle."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from daybook.plans.catalog import QUERIES
from util import assert_same

ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["id", "id_penyelenggara", "id_borrower"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck001, name):
    df = QUERIES[name](spark, SF001)
    if name in ORACLES:
        assert_same(df, duck001, ORACLES[name])
    else:
        df.count()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


ZONE_SENSITIVE = ["report", "report_date", "counter_upsert", "export_name", "ticks_to_temporal", "token_decrypt"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, duck001, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert_same(QUERIES[name](spark, SF001), duck001, ORACLES[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
