"""Stream forms of the bounded fact and label joins: cancels, payments, refund payments (J5, J6, J8),
profile and order labels (J10-J13).

All are chains of inner interval joins; a side's state is dropped once the watermark passes
the bound, so ``STATE_BOUND_S`` plays the part of the state's time to live.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import facts as fx

STATE_BOUND_S = 1805
LABEL_BOUNDS_S = (10 * 86_400, 86_400)


def interval_chain_stream(first: DataFrame, ts: str, steps: Sequence[tuple], delay: str) -> DataFrame:
    """Join ``first`` to one stream after the other, each within its bound of the event time so
    far, the latest of the joined times (returned as ``event_ts_ms``).

    A step is ``(right, {left key: right key}, right_ts, bound_s)``.  A stream carries one
    event time, here ``ts`` of the first: each step's window around it is as wide as the event
    time may have moved, and the exact bound is a second condition.  Right keys and
    times are dropped; other column names must not clash.
    """
    out = first.withWatermark(ts, delay).withColumn("event_ts_ms", F.unix_millis(ts))
    moved = 0
    for n, (right, keys, right_ts, bound_s) in enumerate(steps):
        names = {rk: f"__k{n}_{i}" for i, rk in enumerate(keys.values())}
        r = right.withWatermark(right_ts, delay).withColumnsRenamed({**names, right_ts: f"__ts{n}"})
        at = F.col(f"__ts{n}")
        cond = ((at >= F.col(ts) - F.expr(f"INTERVAL {bound_s} SECONDS"))
                & (at <= F.col(ts) + F.expr(f"INTERVAL {moved + bound_s} SECONDS"))
                & (F.abs(F.unix_millis(at) - F.col("event_ts_ms")) <= bound_s * 1000))
        for lk, rk in keys.items():
            cond = cond & (F.col(lk) == F.col(names[rk]))
        out = (out.join(r, cond).withColumn("event_ts_ms", F.greatest("event_ts_ms", F.unix_millis(at)))
               .drop(*names.values(), f"__ts{n}"))
        moved += bound_s
    return out


def cancel_stream(cancels: DataFrame, details: DataFrame, delay: str = "0 seconds", bound_s: int = STATE_BOUND_S) -> DataFrame:
    """Cancels (event time ``cancel_ts``) x order detail facts (``detail_ts``)."""
    return fx.cancel_rows(interval_chain_stream(
        cancels, "cancel_ts", [(details, {"order_id": "order_id"}, "detail_ts", bound_s)], delay))


def payment_stream(payments: DataFrame, details: DataFrame, delay: str = "0 seconds", bound_s: int = STATE_BOUND_S) -> DataFrame:
    """Successful payments (event time ``payment_ts``) x order detail facts (``detail_ts``)."""
    return fx.payment_rows(interval_chain_stream(
        payments, "payment_ts", [(details, {"order_id": "order_id"}, "detail_ts", bound_s)], delay))


def refund_payment_stream(payments: DataFrame, refunds: DataFrame, orders: DataFrame, delay: str = "0 seconds",
                          bound_s: int = STATE_BOUND_S) -> DataFrame:
    """Refund payments (``payment_ts``) x refunds (``refund_ts``) on order and sku, then x
    orders (``order_ts``)."""
    return fx.refund_payment_rows(interval_chain_stream(payments, "payment_ts", [
        (refunds, {"order_id": "order_id", "sku_id": "sku_id"}, "refund_ts", bound_s),
        (orders, {"order_id": "order_id"}, "order_ts", bound_s)], delay))


def profile_stream(users: DataFrame, orders: DataFrame, pages: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """User labels (``user_ts``) x order labels (``order_ts``) within +-10 days, then x page
    labels (``page_ts``) within +-24 hours, all by ``uid``."""
    return interval_chain_stream(users, "user_ts", [
        (orders, {"uid": "uid"}, "order_ts", LABEL_BOUNDS_S[0]), (pages, {"uid": "uid"}, "page_ts", LABEL_BOUNDS_S[1])], delay)


def order_label_stream(orders: DataFrame, details: DataFrame, skus: DataFrame, brands: DataFrame,
                       delay: str = "0 seconds", bound_s: int = 120) -> DataFrame:
    """Order changes (``o_ts``) x detail changes (``d_ts``) x sku changes (``s_ts``) x brand
    changes (``b_ts``), each within +-``bound_s``."""
    return interval_chain_stream(orders, "o_ts", [
        (details, {"order_id": "order_id"}, "d_ts", bound_s), (skus, {"sku_id": "sku_id"}, "s_ts", bound_s),
        (brands, {"tm_name": "tm_name"}, "b_ts", bound_s)], delay)
