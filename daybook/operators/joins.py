"""The report's joins.

Every join except the borrower lookup is keyed on the order id, so once the
reported orders are hash-partitioned by ``a_uuid`` the bill, extension and
history joins reuse that partitioning (one exchange of the wide side).  Join
strategy is left to Catalyst and AQE: broadcast happens only when the measured
size of a side is under ``spark.sql.autoBroadcastJoinThreshold``; otherwise a
sort-merge join, with AQE splitting skewed partitions.

Fan-out of the original SQL is kept: tied latest history rows, duplicate bills
per term and several delay records per order each yield extra report rows.
Identical copies of history rows and delay records are counted before the
joins (partial aggregates, so a copy group never crosses a shuffle whole) and
their rows repeated after the joins (``expand_copies``).  Different tied rows
of one order (not copies) meet in that order's task; the sort-merge join
streams and spills them, but AQE cannot split the right side of a left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.params import AGREEMENT_HISTORY_STATUS


def prefixed(df: DataFrame, prefix: str, columns) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in columns])


# ---- history ---------------------------------------------------------------
def latest_agreement_max(history: DataFrame) -> DataFrame:
    """``max(updateTime)`` of the enabled agreement rows (status 20) per order.

    ``groupBy`` plans a partial (map-side) aggregate before the shuffle, so a
    hot order sends one row per map task, never all its rows."""
    return (
        history.where((F.col("status") == AGREEMENT_HISTORY_STATUS) & (F.col("disabled") == 0))
        .groupBy("orderId")
        .agg(F.max("updateTime").alias("maxUpdateTime"))
    )


def latest_agreement_rows(history: DataFrame, co_located: bool = False) -> DataFrame:
    """Agreement rows whose ``updateTime`` equals that maximum, as distinct
    (order, statusChangeTime) rows with their number of copies.

    The original is a correlated scalar subquery inside ``ON``; Spark rejects
    that form, so the maximum is pre-aggregated and joined back on
    (order, time).  All status-20 rows on the maximum time count (ties and
    disabled rows sharing the time fan out, as in the original).  Joining on
    both keys spreads a hot order's rows over partitions by time, and the
    final count collapses identical copies before they reach the report join
    (``c_copies``; the report repeats its row that many times at the end).

    ``co_located``: the history is stored bucketed by order id.  The
    join-back then keys on the order id alone (the time equality becomes a
    non-key condition), so it, the copy count and the report join all reuse
    the bucket partitioning and the history is never shuffled."""
    agreement = history.where(F.col("status") == AGREEMENT_HISTORY_STATUS).select(
        "orderId", "updateTime", "statusChangeTime"
    )
    latest = latest_agreement_max(history)
    if co_located:
        # between max and max: equal for the non-NULL maximum, but not
        # extracted as a join key
        at_max = agreement.updateTime.between(latest.maxUpdateTime, latest.maxUpdateTime)
    else:
        at_max = agreement.updateTime == latest.maxUpdateTime
    rows = agreement.join(latest, (agreement.orderId == latest.orderId) & at_max, "inner")
    return rows.groupBy(
        agreement.orderId.alias("c_orderId"), agreement.statusChangeTime.alias("c_statusChangeTime")
    ).agg(F.count(F.lit(1)).alias("c_copies"))


def join_latest_history(rows: DataFrame, latest: DataFrame) -> DataFrame:
    return rows.join(latest, rows.a_uuid == latest.c_orderId, "left")


COPY_COLUMNS = ("c_copies", "e_copies")


CHUNK_COPIES = 1 << 16


def expand_copies(rows: DataFrame, chunk: int = CHUNK_COPIES) -> DataFrame:
    """Repeat each row by the copies of its history and delay-record matches
    (1 without a match): the fan-out of identical rows, restored after the
    joins.  Copies of two joined sides multiply, as the joins would.

    Two steps: a row becomes one row per ``chunk`` copies, then each of these
    its copies, so arrays stay short (the chunk's length, and the count over it)
    and any 64-bit count works.  Rows of one task stream out one by one."""
    present = [c for c in COPY_COLUMNS if c in rows.columns]
    n = F.lit(1).cast("bigint")
    for c in present:
        n = n * F.coalesce(F.col(c), F.lit(1)).cast("bigint")
    one = F.lit(1).cast("bigint")
    counted = rows.withColumn("_n", n)
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / F.lit(chunk)).cast("bigint"))
    left = F.least(F.lit(chunk).cast("bigint"), F.col("_n") - F.col("_chunk") * chunk)
    chunked = counted.withColumn("_chunk", F.explode(chunks))
    return chunked.withColumn("_copy", F.explode(F.sequence(one, left))).drop("_n", "_chunk", "_copy", *present)


# ---- bills -----------------------------------------------------------------
BILL_COLUMNS = ("orderNo", "refundTime", "actualRefundTime", "billAmout")


def bills_of_term(bill: DataFrame, term: int, prefix: str) -> DataFrame:
    return prefixed(bill.where(F.col("billTerm") == term), prefix, BILL_COLUMNS)


def join_bills(rows: DataFrame, bill: DataFrame) -> DataFrame:
    """Three left joins to the bill table (term 3 as ``d``, 1 as ``d1``, 2 as
    ``d2``), only for instalment orders: ``a.orderType = 3`` stays in the join
    condition, so other orders keep NULL bills.  A pivot would need one bill per
    (order, term); separate joins keep duplicate bills' fan-out exact."""
    for term, prefix in ((3, "d"), (1, "d1"), (2, "d2")):
        b = bills_of_term(bill, term, prefix)
        rows = rows.join(
            b,
            (rows.a_uuid == b[f"{prefix}_orderNo"]) & (rows.a_orderType == 3),
            "left",
        ).drop(f"{prefix}_orderNo")
    return rows


# ---- extension ---------------------------------------------------------------
FOLLOW_UP_COLUMNS = ("uuid", "status", "amountApply", "refundTime", "actualRefundTime")


def extension_leg(delay: DataFrame, order: DataFrame) -> DataFrame:
    """delay record ``e`` left join follow-up order ``f``, keyed by the original
    order.  Joining ``e`` to ``f`` first keeps the wide report rows from being
    shuffled by the follow-up key: ``a ⟕ e ⟕ f  ==  a ⟕ (e ⟕ f)`` because the
    second condition references only ``e`` and ``f``."""
    f = prefixed(order, "f", FOLLOW_UP_COLUMNS)
    # identical delay records are counted (partially, before the shuffle) and
    # travel as one row with ``e_copies``; the report repeats them at the end
    e = delay.groupBy(F.col("orderNo").alias("e_orderNo"), F.col("delayOrderNo").alias("e_delayOrderNo")).agg(
        F.count(F.lit(1)).alias("e_copies")
    )
    return e.join(f, e.e_delayOrderNo == f.f_uuid, "left").drop("e_delayOrderNo", "f_uuid")


def join_extension(rows: DataFrame, leg: DataFrame) -> DataFrame:
    return rows.join(leg, rows.a_uuid == leg.e_orderNo, "left").drop("e_orderNo")


# ---- borrower ------------------------------------------------------------------
USER_COLUMNS = ("uuid", "realName", "idCardNo", "disabled")


def join_borrower(rows: DataFrame, user: DataFrame) -> DataFrame:
    """Left join in the original, made inner by its ``b.disabled = 0`` filter;
    written as the inner join it is."""
    b = prefixed(user.where(F.col("disabled") == 0), "b", USER_COLUMNS)
    return rows.join(b, rows.a_userUuid == b.b_uuid, "inner")
