"""Keyed state in batch form: new-visitor repair, de-duplication, retraction, running profiles, merges."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import ts_to_ms
from strata.operators.bitmaps import distinct_bitmaps, distinct_counts, united
from strata.operators.bloom import BloomState
from strata.operators.dedupe import exact_dedupe, first_per_key
from strata.operators.facts import detail_id
from strata.operators.scan import running_max_before, running_profile, seq_and_previous
from strata.plans.dws import _sql_window, logs
from strata.plans.registry import query
from strata.sources import tables as t
from strata.session import ensure_checkpoint_dir
from strata.sources.applog import APPLOG_SQL, PAGE_SQL, page_rows
from strata.streaming.keyed_table import KeyedTable

DETAIL_ORDER_SQL = ("l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
                    "l_returnflag, l_linestatus")


def new_visitor_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair the client's is_new flag per mid (no state expiry; intent).

    The state is the first visit date, fixed by the mid's first row: that row's
    day when it says is_new=1, else the day before.  A later is_new=1 row on
    another day becomes 0.  The first row per mid is a combining aggregate; the
    one-row-per-mid state is joined back by key.
    """
    lg = logs(spark, sf_dir).select("event_id", "mid", "ts", "is_new", F.to_date("ts").alias("d"))
    first = (lg.groupBy("mid").agg(F.min(F.struct("ts", "event_id", "is_new", "d")).alias("f"))
             .select("mid", F.when(F.col("f.is_new") == "1", F.col("f.d"))
                     .otherwise(F.date_sub(F.col("f.d"), 1)).alias("first_date")))
    j = lg.join(first, "mid")
    fixed = F.when((F.col("is_new") == "1") & (F.col("first_date") != F.col("d")), "0").otherwise(F.col("is_new"))
    return j.select("event_id", "mid", F.col("d").cast("string").alias("visit_date"),
                    F.col("is_new").alias("is_new_raw"), fixed.alias("is_new"),
                    F.col("first_date").cast("string").alias("first_date"))


query("new_visitor_fix", f"""
WITH l AS (SELECT event_id, mid, ts, is_new, CAST(ts AS DATE) AS d FROM ({APPLOG_SQL})),
f AS (SELECT mid, CASE WHEN is_new = '1' THEN d ELSE d - INTERVAL 1 DAY END AS first_date
      FROM l QUALIFY row_number() OVER (PARTITION BY mid ORDER BY ts, event_id) = 1)
SELECT l.event_id, l.mid, CAST(l.d AS VARCHAR) AS visit_date, l.is_new AS is_new_raw,
  CASE WHEN l.is_new = '1' AND CAST(f.first_date AS DATE) <> l.d THEN '0' ELSE l.is_new END AS is_new,
  CAST(CAST(f.first_date AS DATE) AS VARCHAR) AS first_date
FROM l JOIN f USING (mid)
""")(new_visitor_fix)


def exact_dedupe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop records that repeat an earlier record exactly, per language stream."""
    docs = t.read(spark, sf_dir, "documents").select("lang", "text")
    return exact_dedupe(docs)


query("exact_dedupe", "SELECT DISTINCT lang, text FROM documents")(exact_dedupe_query)


def monotone_filter(spark: SparkSession, sf_dir: str, chunk_orders: int = 1_000_000) -> DataFrame:
    """Per customer, in arrival (order id) order, keep an order only when its date is
    later than every earlier order's date.  Running max as a two-level scan over
    order-id chunks, so a customer with very many orders spans many tasks."""
    o = t.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    chunk = F.floor(F.col("o_orderkey") / chunk_orders)
    r = running_max_before(o, ["o_custkey"], ["o_orderkey"], chunk, "o_orderdate", "prev_max")
    kept = r.filter(F.col("prev_max").isNull() | (F.col("o_orderdate") > F.col("prev_max")))
    return kept.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))


query("monotone_filter", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM (
  SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
  FROM orders)
WHERE prev_max IS NULL OR o_orderdate > prev_max
""")(monotone_filter)


def retraction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog of order amounts by detail id: every version is emitted, and a
    repeat first retracts the previous version (negated amount).  Summing per id
    gives the last version's amount (the net form used by the windows)."""
    d = t.order_detail(spark, sf_dir).select(*t.DETAIL_KEY, *t.DETAIL_ORDER,
                                             F.col("split_total_amount").cast("decimal(38,4)").alias("amount"))
    # Position and previous amount per detail as a two-level scan over ship-month chunks,
    # so one detail with very many versions is spread over many tasks.
    chunk = F.date_trunc("month", "l_shipdate")
    s = seq_and_previous(d, t.DETAIL_KEY, t.DETAIL_ORDER, chunk, ["amount"])
    v = s.select(detail_id().alias("id"), F.col("seq").cast("bigint").alias("seq"), "amount", "prev_amount")
    # One pass: each version emits its own row and, for a repeat, the negated previous one.
    own = F.struct(F.lit(0).alias("is_retraction"), F.col("amount").alias("amount"))
    neg = F.struct(F.lit(1).alias("is_retraction"), (-F.col("prev_amount")).alias("amount"))
    rows = F.when(F.col("seq") > 1, F.array(own, neg)).otherwise(F.array(own))
    return v.select("id", "seq", F.inline(rows))


query("retraction_stream", f"""
WITH v AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id,
    row_number() OVER w AS seq,
    CAST(l_extendedprice AS DECIMAL(16,2)) - CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2))
      - CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(4,2)) AS amount
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY {DETAIL_ORDER_SQL}))
SELECT id, seq, 0 AS is_retraction, CAST(amount AS DECIMAL(38,4)) AS amount FROM v
UNION ALL
SELECT id, seq, 1 AS is_retraction, CAST(-prev AS DECIMAL(38,4)) AS amount FROM (
  SELECT id, seq, lag(amount) OVER (PARTITION BY id ORDER BY seq) AS prev FROM v) WHERE seq > 1
""")(retraction_stream)


def key_ts_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact de-duplication on (order id, change time); the first arrival is kept.

    Replaces the reference's Bloom filter (whose false positives drop rows) by an
    exact combining aggregate."""
    d = t.order_detail(spark, sf_dir).select(*t.DETAIL_ORDER, "l_orderkey", "l_linenumber")
    first = first_per_key(d, ["l_orderkey", "l_shipdate"], ["l_linenumber", *t.DETAIL_ORDER[1:]])
    return first.select("l_orderkey", ts_to_ms("l_shipdate").alias("ts_ms"), "l_linenumber", "l_partkey")


query("key_ts_dedupe", f"""
SELECT l_orderkey, epoch_ms(l_shipdate) AS ts_ms, l_linenumber, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_shipdate ORDER BY l_linenumber, {DETAIL_ORDER_SQL.replace('l_shipdate, ', '')}) = 1
""")(key_ts_dedupe)


def running_user_profile(spark: SparkSession, sf_dir: str, chunk_seconds: int = 3600) -> DataFrame:
    """Per user, with every page row, the running page count and the sorted sets of
    os, channel, model, brand and search word seen so far (never reset).
    Two-level scan over time chunks of ``chunk_seconds``."""
    lg = page_rows(logs(spark, sf_dir)).select(
        "event_id", "uid", "ts", "os", "ch", "md", "ba", F.col("item").alias("search_item"))
    chunk = F.floor(F.unix_seconds("ts") / chunk_seconds)
    r = running_profile(lg, ["uid"], ["ts", "event_id"], chunk, ["os", "ch", "md", "ba", "search_item"])
    return r.select("event_id", "uid", "pv", "os_set", "ch_set", "md_set", "ba_set", "search_item_set")


def _sql_set(c: str) -> str:
    return f"coalesce(array_to_string(list_sort(list_distinct(list({c}) OVER w)), ','), '') AS {c}_set"


query("running_user_profile", f"""
SELECT event_id, uid, count(*) OVER w AS pv, {_sql_set('os')}, {_sql_set('ch')}, {_sql_set('md')},
  {_sql_set('ba')}, {_sql_set('search_item')}
FROM (SELECT *, item AS search_item FROM ({PAGE_SQL}))
WINDOW w AS (PARTITION BY uid ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")(running_user_profile)


def last_per_window(spark: SparkSession, sf_dir: str, size: str = "1 hour") -> DataFrame:
    """A10: per user and window, the newest page row (ties broken by event id)."""
    lg = page_rows(logs(spark, sf_dir))
    latest = lg.groupBy(F.window("ts", size).alias("window"), "uid").agg(
        F.max(F.struct("ts", "event_id", "page_id", "os", "ch")).alias("r"))
    from strata.functions.dates import window_text
    return latest.select(*window_text("window"), "uid", "r.event_id", "r.page_id", "r.os", "r.ch")


query("last_per_window", f"""
SELECT {_sql_window('1 hour')}, uid, event_id, page_id, os, ch FROM ({PAGE_SQL})
QUALIFY row_number() OVER (PARTITION BY uid, time_bucket(INTERVAL '1 hour', ts) ORDER BY ts DESC, event_id DESC) = 1
""")(last_per_window)


def cart_lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart rows for the lake table (P23): id, ds (ship year as the partition day stand-in),
    sparse columns (null where the source change did not carry them), ts_ms and version."""
    d = t.order_detail(spark, sf_dir)
    return d.select(
        detail_id().alias("id"), F.date_format("l_shipdate", "yyyy").alias("ds"),
        F.when(F.col("l_linestatus") == "F", F.col("sku_num")).alias("sku_num"),
        F.when(F.col("l_returnflag") != "N", F.col("split_original_amount").cast("decimal(16,2)")).alias("cart_price"),
        F.when(F.col("l_discount") > 0.03, F.col("l_partkey").cast("string")).alias("sku_id"),
        ts_to_ms("l_shipdate").alias("ts_ms"),
        F.struct(*[F.col(c) for c in t.DETAIL_ORDER]).alias("version"))


def partial_update_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (id, ds) the latest non-null value of every column by change time
    (deletes ignored).  ``max_by`` over a version that is null where the value is
    null skips those rows, so each column takes its own latest non-null value."""
    from strata.operators.merge import partial_update
    rows = cart_lake_rows(spark, sf_dir)
    return partial_update(rows, ["id", "ds"], "version", ["sku_num", "cart_price", "sku_id"],
                          [F.max("ts_ms").alias("ts_ms")])


query("partial_update_merge", f"""
WITH r AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id, strftime(l_shipdate, '%Y') AS ds,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) END AS sku_num,
    CASE WHEN l_returnflag <> 'N' THEN CAST(l_extendedprice AS DECIMAL(16,2)) END AS cart_price,
    CASE WHEN l_discount > 0.03 THEN CAST(l_partkey AS VARCHAR) END AS sku_id,
    epoch_ms(l_shipdate) AS ts_ms, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {DETAIL_ORDER_SQL}) AS v
  FROM lineitem)
SELECT id, ds, arg_max(sku_num, v) FILTER (WHERE sku_num IS NOT NULL) AS sku_num,
  arg_max(cart_price, v) FILTER (WHERE cart_price IS NOT NULL) AS cart_price,
  arg_max(sku_id, v) FILTER (WHERE sku_id IS NOT NULL) AS sku_id, max(ts_ms) AS ts_ms
FROM r GROUP BY id, ds
""")(partial_update_merge)


# ---- keyed tables of change files (S7, S9, S14, A9) ----------------------------------------

CART_CELLS = {"sku_num": "bigint", "cart_price": "decimal(16,2)", "sku_id": "string"}


def cart_table(spark: SparkSession, buckets: int = 16) -> KeyedTable:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/keyed-{uuid.uuid4().hex}"
    return KeyedTable(spark, folder, {"id": "string", "ds": "string"}, CART_CELLS, buckets=buckets)


def keyed_table_cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S14 by last-writer-wins cells: cart changes arrive in three batches, the newest batch first, and the
    first two are compacted before the third, late one.  Each column keeps the value of its newest change."""
    rows = cart_lake_rows(spark, sf_dir)
    table = cart_table(spark)
    part = F.pmod(F.month(F.timestamp_millis("ts_ms")), F.lit(3))
    for batch, arrives in enumerate((2, 0, 1)):
        table.write(rows.where(part == arrives), batch, "ts_ms")
        if batch == 1:
            table.compact(0)
    return table.read()


query("keyed_table_cart", """
WITH r AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id, strftime(l_shipdate, '%Y') AS ds,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) END AS sku_num,
    CASE WHEN l_returnflag <> 'N' THEN CAST(l_extendedprice AS DECIMAL(16,2)) END AS cart_price,
    CASE WHEN l_discount > 0.03 THEN CAST(l_partkey AS VARCHAR) END AS sku_id, epoch_ms(l_shipdate) AS ts_ms
  FROM lineitem)
SELECT id, ds,
  (max(struct_pack(t := ts_ms, v := sku_num)) FILTER (WHERE sku_num IS NOT NULL)).v AS sku_num,
  (max(struct_pack(t := ts_ms, v := cart_price)) FILTER (WHERE cart_price IS NOT NULL)).v AS cart_price,
  (max(struct_pack(t := ts_ms, v := sku_id)) FILTER (WHERE sku_id IS NOT NULL)).v AS sku_id
FROM r GROUP BY id, ds
""")(keyed_table_cart)


# ---- state that merges: Bloom filters and distinct bitmaps ------------------------------------

def bloom_dedupe(spark: SparkSession, sf_dir: str, buckets: int = 64) -> DataFrame:
    """D10 over three batches with a stored Bloom filter: the first arrival of each (order, change time) stays,
    none is dropped by a false positive.  Details arrive by line number."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bloom-{uuid.uuid4().hex}"
    state = BloomState(spark, folder, ["l_orderkey", "l_shipdate"], buckets)
    d = t.order_detail(spark, sf_dir).select("l_orderkey", "l_shipdate", "l_linenumber", *t.DETAIL_ORDER[1:])
    order = ["l_linenumber", *t.DETAIL_ORDER[1:]]
    parts = [state.new_rows(d.where(c), i, order) for i, c in enumerate(("l_linenumber <= 2", "l_linenumber in (3, 4)", "l_linenumber > 4"))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.select("l_orderkey", ts_to_ms("l_shipdate").alias("ts_ms"), "l_linenumber", "l_partkey")


query("bloom_dedupe", f"""
SELECT l_orderkey, epoch_ms(l_shipdate) AS ts_ms, l_linenumber, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_shipdate ORDER BY l_linenumber, {DETAIL_ORDER_SQL.replace('l_shipdate, ', '')}) = 1
""")(bloom_dedupe)


def uv_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, A4, A5: exact unique visitors per page by hour, day and month from one stored table of hourly bitmaps."""
    rows = page_rows(logs(spark, sf_dir)).select("page_id", F.date_trunc("hour", "ts").alias("hour"), "user_id")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/uv-{uuid.uuid4().hex}"
    distinct_bitmaps(rows, ["page_id", "hour"], "user_id").write.parquet(path)
    stored, out = spark.read.parquet(path), None
    for grain in ("hour", "day", "month"):
        coarse = united(stored, ["page_id", F.date_trunc(grain, "hour").alias("at")])
        part = distinct_counts(coarse, ["page_id", "at"], "uv").select(
            F.lit(grain).alias("grain"), F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("stt"), "page_id", "uv")
        out = part if out is None else out.unionByName(part)
    return out


query("uv_rollup", " UNION ALL ".join(f"""
SELECT '{g}' AS grain, strftime(date_trunc('{g}', ts), '%Y-%m-%d %H:%M:%S') AS stt, page_id, count(DISTINCT user_id) AS uv
FROM ({PAGE_SQL}) GROUP BY ALL""" for g in ("hour", "day", "month")))(uv_rollup)
