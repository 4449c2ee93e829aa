"""DWD fact builders (J3-J8, F4, F11, F12, P16) over the net (upserted) source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import ms_to_date_text


def detail_id(order_col: str = "l_orderkey", line_col: str = "l_linenumber"):
    return F.concat_ws("_", F.col(order_col).cast("string"), F.col(line_col).cast("string"))


def amount_text(c) -> F.Column:
    """Amounts travel as text in the fact topics (F11: 'decimal(16,2)*decimal(16,2)' keeps 4 decimals)."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def order_detail_fact(detail: DataFrame, order_info: DataFrame, activity: DataFrame, coupon: DataFrame,
                      on: Sequence[str] = ("id",)) -> DataFrame:
    """Detail inner order_info, left activity, left coupon, keyed by detail id.

    ``on`` is the detail key the link tables carry.  ``detail`` must already be the net
    (last-per-id) table; the upsert sink of the stream form absorbs the null-then-filled
    rows the left joins emit.
    """
    d = detail.join(activity, list(on), "left").join(coupon, list(on), "left")
    d = d.join(order_info, "order_id", "inner")
    return d.select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        ms_to_date_text("create_time").alias("date_id"), "create_time", "sku_num",
        "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts_ms")


def cancel_rows(joined: DataFrame) -> DataFrame:
    """Cancel fact columns (J5) of cancels joined to order detail facts."""
    return joined.select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        "date_id", "operate_time", "sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount",
        "split_total_amount", "ts_ms")


def payment_rows(joined: DataFrame) -> DataFrame:
    """Payment fact columns (J6) of payments joined to order detail facts."""
    return joined.select(
        F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", "payment_type_code", "callback_time", "sku_num", "split_original_amount",
        "split_activity_amount", "split_coupon_amount", F.col("split_total_amount").alias("split_payment_amount"), "ts_ms")


def refund_payment_rows(joined: DataFrame) -> DataFrame:
    """Refund payment fact columns (J8) of refund payments joined to refunds and orders."""
    return joined.select("id", "user_id", "order_id", "sku_id", "province_id", "payment_type",
                         ms_to_date_text("callback_time").alias("date_id"), "callback_time", "refund_num", "total_amount",
                         "ts_ms")


def status_filter(df: DataFrame, status_col: str, statuses) -> DataFrame:
    """Keep rows in the given statuses (intent form; no AND/OR precedence slip)."""
    return df.filter(F.col(status_col).isin(*statuses))


def cart_add(changes: DataFrame, literal: bool = False) -> DataFrame:
    """cart adds from cart_info changes.

    Inserts add their whole quantity; updates add ``after - before`` when the
    quantity grew (intent).  ``literal=True`` reproduces the reference predicate,
    which compares the new quantity with itself and so passes snapshot rows only.
    Input columns: op, sku_num_after, sku_num_before.
    """
    if literal:
        return changes.filter(F.col("op") == "r").withColumn("sku_num", F.col("sku_num_after"))
    grown = (F.col("op") == "u") & (F.col("sku_num_after") > F.col("sku_num_before"))
    return (changes.filter((F.col("op").isin("c", "r")) | grown)
            .withColumn("sku_num", F.when(F.col("op") == "u", F.col("sku_num_after") - F.col("sku_num_before"))
                        .otherwise(F.col("sku_num_after"))))
