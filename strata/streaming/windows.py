"""Stream forms of the DWS window summaries (W1-W8 with A5, A7): the batch functions'
aggregates over a watermarked stream, append mode (a window is emitted once the
watermark passes its end; later rows for it are dropped, W8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.keywords import keywords
from strata.operators.windows import tumbling
from strata.sources.applog import page_rows


def keyword_window_stream(entries: DataFrame, size: str = "10 minutes", delay: str = "0 seconds") -> DataFrame:
    """A7 over a stream of (ts, item) search entries."""
    words = keywords(entries.withWatermark("ts", delay), "item", "keyword")
    return tumbling(words, "ts", size, ["keyword"], [F.count("*").alias("keyword_count")])


def home_detail_uv_stream(logs: DataFrame, size: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """A5 with D4: first home / detail view per mid and day (state expires with the
    watermark), then counted per window."""
    pages = (logs.filter(F.col("page_id").isin("home", "good_detail")).withWatermark("ts", delay)
             .withColumn("d", F.to_date("ts")))
    firsts = pages.dropDuplicatesWithinWatermark(["mid", "page_id", "d"])
    return tumbling(firsts, "ts", size, [], [
        F.sum(F.when(F.col("page_id") == "home", 1).otherwise(0)).alias("home_uv_ct"),
        F.sum(F.when(F.col("page_id") == "good_detail", 1).otherwise(0)).alias("good_detail_uv_ct"),
    ])


def traffic_window_stream(logs: DataFrame, size: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """A4 with D3: page views per window and (vc, ch, ar, is_new).  The daily first visit
    of a mid is found by ``dropDuplicatesWithinWatermark`` and counted (uv); every row
    counts towards pv / sv / dur.  Both branches are unioned and summed once."""
    dims = ["vc", "ch", "ar", "is_new"]
    pages = page_rows(logs).withWatermark("ts", delay)
    rows = pages.select("ts", *dims, F.lit(0).alias("uv"), F.lit(1).alias("pv"),
                        F.when(F.coalesce(F.col("last_page_id"), F.lit("")) == "", 1).otherwise(0).alias("sv"),
                        F.coalesce(F.col("during_time"), F.lit(0)).alias("dur"))
    firsts = (pages.withColumn("d", F.to_date("ts")).dropDuplicatesWithinWatermark(["mid", "d"])
              .select("ts", *dims, F.lit(1).alias("uv"), F.lit(0).alias("pv"), F.lit(0).alias("sv"),
                      F.lit(0).cast("bigint").alias("dur")))
    both = rows.unionByName(firsts)
    return tumbling(both, "ts", size, dims, [
        F.sum("uv").alias("uv_ct"), F.sum("sv").alias("sv_ct"), F.sum("pv").alias("pv_ct"), F.sum("dur").alias("dur_sum")])


def login_window_stream(logins: DataFrame, size: str = "1 day", delay: str = "1 day",
                        back_days: int = 8) -> DataFrame:
    """A6 with D5: unique and returning users per window.  The per-user state (last login
    day) lives in a ``transformWithStateInPandas`` processor that declares ``ts`` as its
    output event time, so the windowed sum after it runs in append mode."""
    from strata.streaming.stateful import LoginDays
    days = (logins.select("uid", "ts", "event_id").withWatermark("ts", delay).groupBy("uid")
            .transformWithStateInPandas(statefulProcessor=LoginDays(back_days),
                                        outputStructType="uid string, ts timestamp, event_id long, uu int, back int",
                                        outputMode="Append", timeMode="None", eventTimeColumnName="ts"))
    return tumbling(days, "ts", size, [], [F.sum("back").cast("bigint").alias("back_ct"),
                                           F.sum("uu").cast("bigint").alias("uu_ct")])


def province_window_stream(details: DataFrame, customers: DataFrame, provinces: DataFrame,
                           order: list[str], size: str = "1 day", delay: str = "1 day") -> DataFrame:
    """A2 with D6, W2, J18 on a stream of order-detail changes that already carry their
    order's ``order_id``, ``o_custkey`` and ``create_time`` (event time; one per order).

    Stream-static join to the customer's province, retraction by negation per detail
    (transformWithState by order, event time kept), window sums of amounts and of orders, each
    counted at its first row, per province, then the province name (static lookup after the aggregate)."""
    from strata.streaming.stateful import NetAmount
    carry = ["order_id", "province_id", "create_time"]
    d = details.join(customers, details.o_custkey == customers.c_custkey).withColumnRenamed("c_nationkey", "province_id")
    d = d.withWatermark("create_time", delay)
    net = (d.select("l_orderkey", "l_linenumber", *order, *[c for c in carry if c not in order], "amount")
           .groupBy("l_orderkey")
           .transformWithStateInPandas(statefulProcessor=NetAmount(order, carry, "l_linenumber"),
                                       outputStructType="order_id long, province_id int, create_time timestamp, "
                                                        "amount decimal(38,4), is_retraction int, orders int",
                                       outputMode="Append", timeMode="None", eventTimeColumnName="create_time"))
    win = tumbling(net, "create_time", size, ["province_id"], [
        F.sum("amount").cast("decimal(38,4)").alias("order_amount"),
        F.sum("orders").cast("bigint").alias("order_count")])
    return win.join(provinces, "province_id", "left")


def dwd_route_stream(lines: DataFrame, config: DataFrame, db: str) -> DataFrame:
    """Config-driven facts (P2, P5, J2, P11) on a change topic: a stateless stream-static
    join with the current fact config; write it with ``partition_by=["sink_table"]`` (or to
    a message queue with a ``topic`` column) for the per-table outputs (S6)."""
    from strata.operators import cdc
    changes = cdc.normalise(cdc.parse_envelopes(lines))
    valid = cdc.valid_changes(changes, db, keep_deletes=True, drop_bootstrap=True)
    r = cdc.route_by_config(valid, config, [("table_name", "source_table"), ("op", "source_type")])
    pruned = cdc.prune_columns(F.col("after"), F.col("config")["sink_columns"])
    return r.select(F.col("config")["sink_table"].alias("sink_table"), cdc.row_id().alias("id"),
                    cdc.map_text(pruned).alias("columns"), "ts_ms")
