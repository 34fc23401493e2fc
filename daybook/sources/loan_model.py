"""The five source tables of the report, derived from the driver tables.

The reporting job reads ``ordOrder``, ``usrUser``, ``ordHistory``, ``ordBill`` and
``ordDelayRecord`` from an operational database.  For tests and benchmarks they
are derived row-for-row from ``orders``, ``customer`` and ``lineitem`` with the
rules of FIXTURES.md section 2 (so their size grows with the scale factor).
All derivations are narrow projections: no shuffle, no Python.

On a real deployment the same ``LoanTables`` is filled from parquet exports or
``sources.jdbc`` instead; the report only depends on the column names below.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.cache import cached
from daybook.functions.dates import floor_div
from daybook.params import AMOUNT_TYPE
from daybook.sources.tables import read_table

# Fixed values of the test model (FIXTURES.md section 2).
MODEL_ASOF = dt.date(2020, 6, 16)
STATUS_BY_K_MOD_6 = {0: 7, 1: 8, 2: 10, 3: 11, 4: 10, 5: 20}
TYPE_BY_K_DIV_6_MOD_4 = {0: 0, 1: 2, 2: 3, 3: 1}


@dataclass(frozen=True)
class LoanTables:
    order: DataFrame  # ordOrder: uuid, userUuid, disabled, status, orderType, amountApply, times
    user: DataFrame  # usrUser: uuid, realName, idCardNo, disabled
    history: DataFrame  # ordHistory: orderId, status, disabled, updateTime, statusChangeTime
    bill: DataFrame  # ordBill: orderNo, billTerm, refundTime, actualRefundTime, billAmout
    delay: DataFrame  # ordDelayRecord: orderNo, delayOrderNo
    bucketed: bool = False  # order-keyed tables stored bucketed by order id

    def register(self) -> None:
        """Expose the tables under their operational names for ``spark.sql``."""
        self.order.createOrReplaceTempView("ordOrder")
        self.user.createOrReplaceTempView("usrUser")
        self.history.createOrReplaceTempView("ordHistory")
        self.bill.createOrReplaceTempView("ordBill")
        self.delay.createOrReplaceTempView("ordDelayRecord")


def _lookup(key: Column, mapping: dict[int, int]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.cast("int")


def _day(asof: dt.date, minus_days: Column) -> Column:
    """Midnight of ``asof - minus_days`` as timestamp_ntz."""
    return F.date_sub(F.lit(asof), minus_days.cast("int")).cast("timestamp_ntz")


def _plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days.cast("int"), ts)


def order_model(orders: DataFrame, asof: dt.date = MODEL_ASOF) -> DataFrame:
    return orders.select(*cached(("order_model", asof), lambda: _order_columns(asof)))


def _order_columns(asof: dt.date) -> list[Column]:
    k = F.col("o_orderkey")
    otype = _lookup(floor_div(k, 6) % 4, TYPE_BY_K_DIV_6_MOD_4)
    lending = _day(asof, k % 181)
    refund = (
        F.when(k % 89 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(otype == 3, _plus_days(lending, 30 * (1 + (k % 5) % 3)))
        .otherwise(_plus_days(lending, F.lit(30)))
    )
    actual = (
        F.when(~(k % 6).isin(2, 3, 4) | (k % 23 == 0), F.lit(None).cast("timestamp_ntz"))
        .when(otype == 3, _day(asof, 1 + k % 2))
        .otherwise(_plus_days(lending, 30 + k % 130 - 10))
    )
    return [
        k.alias("uuid"),
        F.col("o_custkey").alias("userUuid"),
        F.when(k % 97 == 0, 1).otherwise(0).cast("int").alias("disabled"),
        _lookup(k % 6, STATUS_BY_K_MOD_6).alias("status"),
        otype.alias("orderType"),
        F.col("o_totalprice").cast(AMOUNT_TYPE).alias("amountApply"),
        lending.alias("lendingTime"),
        refund.alias("refundTime"),
        actual.alias("actualRefundTime"),
        _day(asof, floor_div(k, 7) % 3).alias("updateTime"),
    ]


def user_model(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("uuid"),
        F.col("c_name").alias("realName"),
        F.concat(F.lit("32"), F.lpad(key.cast("string"), 18, "7")).alias("idCardNo"),
        F.when(key % 50 == 0, 1).otherwise(0).cast("int").alias("disabled"),
    )


def history_model(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(*cached(("history_model",), _history_columns))


def _history_columns() -> list[Column]:
    return [
        F.col("l_orderkey").alias("orderId"),
        F.when(F.col("l_returnflag") == "N", 20).otherwise(10).cast("int").alias("status"),
        F.when(F.col("l_linenumber") % 5 == 0, 1).otherwise(0).cast("int").alias("disabled"),
        F.col("l_shipdate").alias("updateTime"),
        _plus_days(F.col("l_shipdate"), F.lit(1)).alias("statusChangeTime"),
    ]


def bill_model(orders: DataFrame, asof: dt.date = MODEL_ASOF) -> DataFrame:
    """Three bills per order, as a union of one projection per term: a filter
    on ``billTerm`` prunes the other branches at planning time, as a term
    filter would be pushed into the scan of a real bill table."""
    out = None
    for term in (1, 2, 3):
        part = orders.select(*cached(("bill_model", asof, term), lambda: _bill_columns(asof, term)))
        out = part if out is None else out.unionByName(part)
    return out


def _bill_columns(asof: dt.date, term: int) -> list[Column]:
    k = F.col("o_orderkey")
    t = F.lit(term)
    refund = _plus_days(_day(asof, k % 181), 30 * t)
    actual = F.when((k % 6).isin(2, 3, 4) | (k % 5 >= t), _plus_days(refund, k % 37 - 5))
    return [
        k.alias("orderNo"),
        t.cast("int").alias("billTerm"),
        refund.alias("refundTime"),
        actual.alias("actualRefundTime"),
        (F.col("o_totalprice") / 3).cast(AMOUNT_TYPE).alias("billAmout"),
    ]


def delay_model(order: DataFrame) -> DataFrame:
    """One delay record per extended order (type 2), pointing at its
    follow-up order (always a type-1 order; it may lie past the last key)."""
    k = F.col("uuid")
    return order.where(F.col("orderType") == 2).select(
        k.alias("orderNo"),
        (k - k % 6 + 12 + floor_div(k, 24) % 6).alias("delayOrderNo"),
    )


OPERATIONAL_TABLES = ("ordOrder", "usrUser", "ordHistory", "ordBill", "ordDelayRecord")


def read_loan_tables(spark: SparkSession, tables_dir: str) -> LoanTables:
    """The operational tables stored as parquet folders
    ``<tables_dir>/<ordOrder|usrUser|ordHistory|ordBill|ordDelayRecord>``
    (for example exported from the operational database)."""
    r = lambda name: spark.read.parquet(f"{tables_dir.rstrip('/')}/{name}")
    return LoanTables(
        order=r("ordOrder"), user=r("usrUser"), history=r("ordHistory"), bill=r("ordBill"), delay=r("ordDelayRecord")
    )


def write_loan_tables(t: LoanTables, tables_dir: str) -> None:
    for name, df in zip(OPERATIONAL_TABLES, (t.order, t.user, t.history, t.bill, t.delay)):
        df.write.mode("overwrite").parquet(f"{tables_dir.rstrip('/')}/{name}")


# The bucketing column of each operational table: the order id it is first
# joined on (delay records join their follow-up order first).
ORDER_KEY = {"ordOrder": "uuid", "ordBill": "orderNo", "ordHistory": "orderId", "ordDelayRecord": "delayOrderNo"}


def write_bucketed_loan_tables(t: LoanTables, tables_dir: str, buckets: int, prefix: str = "") -> dict[str, str]:
    """Store the operational tables bucketed (and sorted) by the order id
    they are first joined on (``ORDER_KEY``; delay records by their
    follow-up order), all with the same bucket count, as catalog tables at
    ``tables_dir``.  Those joins then need no shuffle: Spark reads matching
    buckets side by side.  ``usrUser`` is keyed by the borrower and is left
    unbucketed.  Returns the catalog names."""
    frames = dict(zip(OPERATIONAL_TABLES, (t.order, t.user, t.history, t.bill, t.delay)))
    names = {}
    for name, df in frames.items():
        table = f"{prefix}{name}"
        w = df.write.mode("overwrite").option("path", f"{tables_dir.rstrip('/')}/{name}")
        if name in ORDER_KEY:
            w = w.bucketBy(buckets, ORDER_KEY[name]).sortBy(ORDER_KEY[name])
        w.saveAsTable(table)
        names[name] = table
    return names


def read_catalog_loan_tables(spark: SparkSession, names: dict[str, str]) -> LoanTables:
    t = {k: spark.table(v) for k, v in names.items()}
    return LoanTables(
        order=t["ordOrder"], user=t["usrUser"], history=t["ordHistory"], bill=t["ordBill"], delay=t["ordDelayRecord"],
        bucketed=True,
    )


def loan_tables(spark: SparkSession, base_dir: str, asof: dt.date = MODEL_ASOF) -> LoanTables:
    orders = read_table(spark, base_dir, "orders")
    order = order_model(orders, asof)
    return LoanTables(
        order=order,
        user=user_model(read_table(spark, base_dir, "customer")),
        history=history_model(read_table(spark, base_dir, "lineitem")),
        bill=bill_model(orders, asof),
        delay=delay_model(order),
    )


# The same derivation as DuckDB SQL, used by oracle queries.  ``{asof}`` is a
# DATE literal.  Kept next to the Spark version so the two stay in step.
ORACLE_MODEL_CTES = """
ordOrder AS (
  SELECT o_orderkey AS uuid, o_custkey AS userUuid,
         CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS disabled,
         CASE o_orderkey % 6 WHEN 0 THEN 7 WHEN 1 THEN 8 WHEN 2 THEN 10 WHEN 3 THEN 11 WHEN 4 THEN 10 ELSE 20 END AS status,
         CASE (o_orderkey // 6) % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END AS orderType,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amountApply,
         CAST(DATE '{asof}' - CAST(o_orderkey % 181 AS INTEGER) AS TIMESTAMP) AS lendingTime,
         CASE WHEN o_orderkey % 89 = 0 THEN NULL
              WHEN (o_orderkey // 6) % 4 = 2
                THEN CAST(DATE '{asof}' - CAST(o_orderkey % 181 AS INTEGER) + CAST(30 * (1 + (o_orderkey % 5) % 3) AS INTEGER) AS TIMESTAMP)
              ELSE CAST(DATE '{asof}' - CAST(o_orderkey % 181 AS INTEGER) + 30 AS TIMESTAMP) END AS refundTime,
         CASE WHEN o_orderkey % 6 NOT IN (2, 3, 4) OR o_orderkey % 23 = 0 THEN NULL
              WHEN (o_orderkey // 6) % 4 = 2 THEN CAST(DATE '{asof}' - CAST(1 + o_orderkey % 2 AS INTEGER) AS TIMESTAMP)
              ELSE CAST(DATE '{asof}' - CAST(o_orderkey % 181 AS INTEGER) + CAST(30 + o_orderkey % 130 - 10 AS INTEGER) AS TIMESTAMP) END AS actualRefundTime,
         CAST(DATE '{asof}' - CAST((o_orderkey // 7) % 3 AS INTEGER) AS TIMESTAMP) AS updateTime
  FROM orders),
usrUser AS (
  SELECT c_custkey AS uuid, c_name AS realName,
         '32' || lpad(CAST(c_custkey AS VARCHAR), 18, '7') AS idCardNo,
         CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS disabled
  FROM customer),
ordHistory AS (
  SELECT l_orderkey AS orderId, CASE WHEN l_returnflag = 'N' THEN 20 ELSE 10 END AS status,
         CASE WHEN l_linenumber % 5 = 0 THEN 1 ELSE 0 END AS disabled,
         l_shipdate AS updateTime, l_shipdate + INTERVAL 1 DAY AS statusChangeTime
  FROM lineitem),
ordBill AS (
  SELECT o_orderkey AS orderNo, t AS billTerm,
         CAST(DATE '{asof}' - CAST(o_orderkey % 181 AS INTEGER) + CAST(30 * t AS INTEGER) AS TIMESTAMP) AS refundTime,
         CASE WHEN o_orderkey % 6 IN (2, 3, 4) OR o_orderkey % 5 >= t
              THEN CAST(DATE '{asof}' - CAST(o_orderkey % 181 AS INTEGER) + CAST(30 * t + o_orderkey % 37 - 5 AS INTEGER) AS TIMESTAMP) END AS actualRefundTime,
         CAST(o_totalprice / 3 AS DECIMAL(18,2)) AS billAmout
  FROM orders CROSS JOIN (VALUES (1), (2), (3)) AS terms(t)),
ordDelayRecord AS (
  SELECT uuid AS orderNo, uuid - uuid % 6 + 12 + (uuid // 24) % 6 AS delayOrderNo
  FROM ordOrder WHERE orderType = 2)
"""


def oracle_model_ctes(asof: dt.date = MODEL_ASOF) -> str:
    return ORACLE_MODEL_CTES.replace("{asof}", asof.isoformat()).strip()
