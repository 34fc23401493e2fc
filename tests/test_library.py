"""Library behaviour not covered through the registered queries."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from daybook.params import ReportParams
from daybook.plans.report import build_report, build_report_days
from daybook.session import tune
from daybook.sources.config import config_of, long_config
from daybook.sources.loan_model import loan_tables
from daybook.sources.tables import read_table
from util import spark_rows


def test_backfill_equals_union_of_daily_reports(spark):
    t = loan_tables(spark, SF001)
    last = ReportParams().rep
    first = last - dt.timedelta(days=3)
    union = None
    d = first
    while d <= last:
        daily = build_report(t, ReportParams.for_report_day(d))
        union = daily if union is None else union.unionByName(daily)
        d += dt.timedelta(days=1)
    assert spark_rows(build_report_days(t, first, last)) == spark_rows(union)


def test_config_of_one_group(spark):
    long = long_config(read_table(spark, SF001, "customer"))
    (row,) = config_of(long, "7").collect()
    attrs = dict(row["attributes"])
    assert row["group"] == "7" and set(attrs) == {"name", "nation", "segment", "balance"}
    assert attrs["name"] == "Customer#000000007"


def test_tune_keeps_runtime_settings(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "32m")
    try:
        tune(spark)
        assert spark.conf.get(key) == "32m"
    finally:
        spark.conf.set(key, old)


def test_report_day_parameter_moves_every_date(spark):
    t = loan_tables(spark, SF001)
    rep = dt.date(2020, 6, 10)
    df = build_report(t, ReportParams.for_report_day(rep))
    assert df.select(F.countDistinct("tgl_pelaporan_data")).first()[0] == 1
    assert df.first()["tgl_pelaporan_data"] == rep


def test_a_cluster_needs_a_shared_folder():
    """Without a configured folder: scratch in local mode only."""
    import pytest

    from daybook.session import shared_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

        def getConf(self):  # noqa: N802
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())
