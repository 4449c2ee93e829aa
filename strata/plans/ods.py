"""ODS/DWD log split and CDC normalisation, config routing and dimension maintenance."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import cdc
from strata.operators import logs as lg
from strata.operators.merge import merge_dimension
from strata.plans.registry import query
from strata.session import ensure_checkpoint_dir
from strata.sources import tables as t
from strata.sources.applog import APPLOG_SQL, raw_log_lines
from strata.sources.cdc import DB, cdc_topic, order_envelopes
from strata.sources.snapshot import snapshot_then_log, table_after
from strata.streaming.keyed_table import KeyedTable

CLEAN_LOG_SQL = f"SELECT * FROM ({APPLOG_SQL}) WHERE k <> 0"


def parsed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.parse_logs(raw_log_lines(t.events(spark, sf_dir)))


def clean_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.clean(parsed_logs(spark, sf_dir))


def log_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are not JSON go to the dirty side output (raw text kept)."""
    return lg.dirty(parsed_logs(spark, sf_dir))


query("log_dirty", f"""
SELECT CAST(ts_ms AS VARCHAR) || ' ' || event_type AS line FROM ({APPLOG_SQL}) WHERE k = 0
""")(log_dirty)


def log_err(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error records."""
    e = lg.err_logs(clean_logs(spark, sf_dir))
    return e.select("common.mid", "common.uid", "page.page_id", F.col("err")["error_code"].alias("error_code"),
                    F.col("err")["msg"].alias("msg"), "ts")


query("log_err", f"""
SELECT mid, uid, page_id, CAST(k AS VARCHAR) AS error_code, 'err_' || CAST(k AS VARCHAR) AS msg, ts_ms AS ts
FROM ({CLEAN_LOG_SQL}) WHERE event_type = 'error'
""")(log_err)


def log_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: start records."""
    s = lg.start_logs(clean_logs(spark, sf_dir))
    return s.select("common.mid", "common.uid", "common.ch", F.col("start")["entry"].alias("entry"),
                    F.col("start")["loading_time"].alias("loading_time"), "ts")


query("log_start", f"""
SELECT mid, uid, ch, 'icon' AS entry, CAST(k * 10 AS VARCHAR) AS loading_time, ts_ms AS ts
FROM ({CLEAN_LOG_SQL}) WHERE event_type = 'signup'
""")(log_start)


def log_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display elements exploded with common, page and ts."""
    d = lg.display_logs(clean_logs(spark, sf_dir))
    e = F.col("display")
    return d.select("common.mid", "common.uid", "common.ch", "page.page_id", "page.during_time",
                    e["display_type"].alias("display_type"), e["item"].alias("item"),
                    e["item_type"].alias("item_type"), e["pos_id"].alias("pos_id"), "ts")


query("log_display", f"""
SELECT mid, uid, ch, page_id, during_time, 'query' AS display_type, CAST(user_id * 100 + i AS VARCHAR) AS item,
  'sku_id' AS item_type, CAST(i AS VARCHAR) AS pos_id, ts_ms AS ts
FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM ({CLEAN_LOG_SQL}) WHERE event_type IN ('view', 'click'))
""")(log_display)


def log_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Action elements exploded with common and page (no record ts)."""
    a = lg.action_logs(clean_logs(spark, sf_dir))
    e = F.col("action")
    return a.select("common.mid", "common.uid", "page.page_id", e["action_id"].alias("action_id"),
                    e["item"].alias("item"), e["item_type"].alias("item_type"), e["ts"].alias("action_ts"))


query("log_action", f"""
SELECT mid, uid, page_id, CASE WHEN i % 2 = 1 THEN 'favor_add' ELSE 'cart_add' END AS action_id,
  CAST(k + i AS VARCHAR) AS item, 'sku_id' AS item_type, CAST(ts_ms + i AS VARCHAR) AS action_ts
FROM (SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM ({CLEAN_LOG_SQL}) WHERE event_type = 'click')
""")(log_action)


def log_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page records (every non-start record, err/displays/actions removed)."""
    p = lg.page_logs(clean_logs(spark, sf_dir))
    return p.select("common.mid", "common.uid", "common.ar", "common.ch", "common.vc", "common.is_new",
                    "page.page_id", "page.last_page_id", "page.item", "page.item_type", "page.during_time", "ts")


query("log_page", f"""
SELECT mid, uid, ar, ch, vc, is_new, page_id, last_page_id, item, item_type, during_time, ts_ms AS ts
FROM ({CLEAN_LOG_SQL}) WHERE event_type <> 'signup'
""")(log_page)


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All outputs of the log split as whole records, with the fields that no column is made of."""
    return lg.whole_records(raw_log_lines(t.events(spark, sf_dir)))


def _json_fields(*fields: tuple[str, str]) -> str:
    """SQL for a JSON object of ``(name, SQL of a JSON value)``, in order, without those that are null."""
    parts = [f"""coalesce('"{name}":' || {value}, '')""" for name, value in fields]
    return "'{' || array_to_string(list_filter([" + ", ".join(parts) + "], lambda x: x <> ''), ',') || '}'"


def _json_text(column: str) -> str:
    return f"""'"' || {column} || '"'"""


_COMMON_SQL = _json_fields(*[(c, _json_text(c)) for c in ("ar", "ba", "ch", "is_new", "md", "mid", "os")],
                           ("sid", _json_text("'s_' || CAST(event_id AS VARCHAR)")), ("uid", _json_text("uid")), ("vc", _json_text("vc")))
_PAGE_SQL = _json_fields(("during_time", "CAST(during_time AS VARCHAR)"), ("item", _json_text("item")), ("item_type", _json_text("item_type")),
                         ("last_page_id", _json_text("last_page_id")), ("page_id", _json_text("page_id")), ("pos_id", "CAST(k % 9 AS VARCHAR)"))
_TS = ("ts", "CAST(ts_ms AS VARCHAR)")
_DISPLAY_SQL = _json_fields(("display_type", "'\"query\"'"), ("item", _json_text("CAST(user_id * 100 + i AS VARCHAR)")),
                            ("item_type", "'\"sku_id\"'"), ("pos_id", _json_text("CAST(i AS VARCHAR)")))
_ACTION_SQL = _json_fields(("action_id", _json_text("CASE WHEN i % 2 = 1 THEN 'favor_add' ELSE 'cart_add' END")),
                           ("item", _json_text("CAST(k + i AS VARCHAR)")), ("item_type", "'\"sku_id\"'"), ("ts", _json_text("CAST(ts_ms + i AS VARCHAR)")))

query("log_records", f"""
WITH l AS (
  SELECT *, {_COMMON_SQL} AS common, {_PAGE_SQL} AS page,
    '{{"net":"wifi","trace":[' || CAST(k AS VARCHAR) || ',' || CAST(k + 1 AS VARCHAR) || ']}}' AS ext,
    {_json_fields(("error_code", _json_text("CAST(k AS VARCHAR)")), ("msg", _json_text("'err_' || CAST(k AS VARCHAR)")))} AS err,
    {_json_fields(("entry", "'\"icon\"'"), ("loading_time", _json_text("CAST(k * 10 AS VARCHAR)")))} AS start
  FROM ({APPLOG_SQL}))
SELECT 'dirty' AS tag, CAST(ts_ms AS VARCHAR) || ' ' || event_type AS record FROM l WHERE k = 0
UNION ALL SELECT 'err', {_json_fields(("common", "common"), ("err", "err"), ("ext", "ext"), ("page", "page"), _TS)}
FROM l WHERE k <> 0 AND event_type = 'error'
UNION ALL SELECT 'start', {_json_fields(("common", "common"), ("ext", "ext"), ("start", "start"), _TS)} FROM l WHERE k <> 0 AND event_type = 'signup'
UNION ALL SELECT 'page', {_json_fields(("common", "common"), ("ext", "ext"), ("page", "page"), _TS)} FROM l WHERE k <> 0 AND event_type <> 'signup'
UNION ALL SELECT 'display', {_json_fields(("common", "common"), ("display", _DISPLAY_SQL), ("page", "page"), _TS)}
FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM l WHERE k <> 0 AND event_type IN ('view', 'click'))
UNION ALL SELECT 'action', {_json_fields(("action", _ACTION_SQL), ("common", "common"), ("page", "page"))}
FROM (SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM l WHERE k <> 0 AND event_type = 'click')
""")(log_records)


# ---- CDC -----------------------------------------------------------------------------------

ORDER_OP_SQL = """CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'd'
  WHEN o_orderstatus = 'F' THEN 'r' WHEN o_orderstatus = 'O' THEN 'c' ELSE 'u' END"""
CUST_TYPE_SQL = """CASE WHEN c_acctbal < 0 THEN 'update' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'bootstrap-insert'
  ELSE 'insert' END"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.normalise(cdc.parse_envelopes(cdc_topic(spark, sf_dir)))


def cdc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both envelope forms parsed and normalised to one shape."""
    c = changes(spark, sf_dir)
    return c.select("db", "table_name", "op", "is_bootstrap", cdc.row_id().alias("id"), "ts_ms",
                    F.col("before")["order_status"].alias("status_before"),
                    F.col("after")["order_status"].alias("status_after"),
                    F.col("before")["acctbal"].alias("acctbal_before"),
                    F.col("after")["acctbal"].alias("acctbal_after"))


NORMALISED_SQL = f"""
SELECT 'shop' AS db, 'order_info' AS table_name, {ORDER_OP_SQL} AS op, false AS is_bootstrap,
  CAST(o_orderkey AS VARCHAR) AS id, epoch_ms(o_orderdate) AS ts_ms,
  CASE WHEN o_orderstatus = 'P' THEN 'O' WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'F' END AS status_before,
  CASE WHEN NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW') THEN o_orderstatus END AS status_after,
  CAST(NULL AS VARCHAR) AS acctbal_before, CAST(NULL AS VARCHAR) AS acctbal_after
FROM orders
UNION ALL
SELECT 'shop', 'user_info',
  CASE {CUST_TYPE_SQL} WHEN 'update' THEN 'u' WHEN 'insert' THEN 'c' ELSE 'r' END,
  c_mktsegment = 'AUTOMOBILE' AND c_acctbal >= 0,
  CAST(c_custkey AS VARCHAR), (1700000000 + c_custkey) * 1000, NULL, NULL,
  CASE WHEN c_acctbal < 0 THEN '0.00' END, CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS VARCHAR)
FROM customer
"""

query("cdc_normalise", NORMALISED_SQL)(cdc_normalise)


def cdc_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + P5: valid changes of the warehouse database (intent: deletes kept), bootstrap dropped."""
    v = cdc.valid_changes(changes(spark, sf_dir), DB, keep_deletes=True, drop_bootstrap=True)
    return v.select("table_name", "op", cdc.row_id().alias("id"), "ts_ms")


query("cdc_valid", f"""
SELECT table_name, op, id, ts_ms FROM ({NORMALISED_SQL}) WHERE NOT is_bootstrap
""")(cdc_valid)


def _config_stream(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return t.literal_table(spark, rows, "op string, before map<string,string>, after map<string,string>, ts_ms bigint")


# The dimension routing config as a change stream (table_process_dim).
# user_info is created, then its column list changes; order_info is created, then deleted.
_DIM_USER_V1 = {"source_table": "user_info", "sink_table": "dim_user_info", "sink_columns": "id,name,nation_id",
                "sink_family": "info", "sink_row_key": "id"}
_DIM_USER_V2 = dict(_DIM_USER_V1, sink_columns="id,name,segment")
_DIM_ORDER = {"source_table": "order_info", "sink_table": "dim_order_info", "sink_columns": "id,user_id",
              "sink_family": "info", "sink_row_key": "id"}
DIM_CONFIG_CHANGES = [("r", None, _DIM_USER_V1, 1), ("r", None, _DIM_ORDER, 1),
                      ("u", _DIM_USER_V1, _DIM_USER_V2, 2), ("d", _DIM_ORDER, None, 3)]

# The fact routing config (table_process_dwd), key = table + ':' + op.
DWD_CONFIG = [
    {"source_table": "order_info", "source_type": "c", "sink_table": "dwd_order_created", "sink_columns": "id,user_id,total_amount"},
    {"source_table": "order_info", "source_type": "u", "sink_table": "dwd_order_status_change", "sink_columns": "id,order_status"},
    {"source_table": "user_info", "source_type": "c", "sink_table": "dwd_user_register", "sink_columns": "id,name"},
]


def cdc_config_route_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DIM build (P4, P9, J1, P11, S20): changes of tables named in the current dim config,
    columns pruned to the config's list, keyed by the config's row-key column."""
    cfg = cdc.latest_config(_config_stream(spark, DIM_CONFIG_CHANGES), ["source_table"])
    v = cdc.valid_changes(changes(spark, sf_dir), DB, keep_deletes=True, drop_bootstrap=False)
    r = cdc.route_by_config(v, cfg, [("table_name", "source_table")])
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    pruned = cdc.prune_columns(row, F.col("config")["sink_columns"])
    return r.select(F.col("config")["sink_table"].alias("sink_table"), "op",
                    row[F.col("config")["sink_row_key"]].alias("row_key"), cdc.map_text(pruned).alias("columns"))


query("cdc_config_route_dim", """
SELECT 'dim_user_info' AS sink_table,
  CASE WHEN c_acctbal < 0 THEN 'u' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'r' ELSE 'c' END AS op,
  CAST(c_custkey AS VARCHAR) AS row_key,
  'id=' || CAST(c_custkey AS VARCHAR) || ',name=' || c_name || ',segment=' || c_mktsegment AS columns
FROM customer
""")(cdc_config_route_dim)


def cdc_config_route_dwd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Config-driven facts (P2, P5, J2, P11, S6): key = (table, op); bootstrap rows dropped."""
    cfg_rows = [("r", None, c, 1) for c in DWD_CONFIG]
    cfg = cdc.latest_config(_config_stream(spark, cfg_rows), ["source_table", "source_type"])
    v = cdc.valid_changes(changes(spark, sf_dir), DB, keep_deletes=True, drop_bootstrap=True)
    r = cdc.route_by_config(v, cfg, [("table_name", "source_table"), ("op", "source_type")])
    pruned = cdc.prune_columns(F.col("after"), F.col("config")["sink_columns"])
    return r.select(F.col("config")["sink_table"].alias("sink_table"), cdc.row_id().alias("id"),
                    cdc.map_text(pruned).alias("columns"), "ts_ms")


query("cdc_config_route_dwd", """
SELECT 'dwd_order_created' AS sink_table, CAST(o_orderkey AS VARCHAR) AS id,
  'id=' || CAST(o_orderkey AS VARCHAR) || ',total_amount=' || CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR)
    || ',user_id=' || CAST(o_custkey AS VARCHAR) AS columns, epoch_ms(o_orderdate) AS ts_ms
FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT 'dwd_order_status_change', CAST(o_orderkey AS VARCHAR),
  'id=' || CAST(o_orderkey AS VARCHAR) || ',order_status=' || o_orderstatus, epoch_ms(o_orderdate)
FROM orders WHERE o_orderstatus = 'P'
UNION ALL
SELECT 'dwd_user_register', CAST(c_custkey AS VARCHAR),
  'id=' || CAST(c_custkey AS VARCHAR) || ',name=' || c_name, (1700000000 + c_custkey) * 1000
FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'AUTOMOBILE'
""")(cdc_config_route_dwd)


# A config history in the middle of the changes.  user_info changes its columns, order_info
# is configured, removed (a gap) and configured anew.
_T95, _T97, _T98 = 788_918_400_000, 852_076_800_000, 883_612_800_000      # new year of 1995, 1997, 1998
_USER_T1, _USER_T2 = 1_700_000_050_000, 1_700_000_100_000
_ORDER_V2 = dict(_DIM_ORDER, sink_table="dim_order_2", sink_columns="id,order_status")
CONFIG_HISTORY = [("r", None, _DIM_USER_V1, _USER_T1), ("u", _DIM_USER_V1, _DIM_USER_V2, _USER_T2),
                  ("r", None, _DIM_ORDER, _T95), ("d", _DIM_ORDER, None, _T97), ("r", None, _ORDER_V2, _T98)]


def cdc_config_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 over history: each change routed and pruned by the config that was valid at its time."""
    v = cdc.valid_changes(changes(spark, sf_dir), DB, keep_deletes=True, drop_bootstrap=False)
    r = cdc.route_asof(v, _config_stream(spark, CONFIG_HISTORY), [("table_name", "source_table")], chunk_ms=30 * 86_400_000)
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    pruned = cdc.prune_columns(row, F.col("config")["sink_columns"])
    return r.select(F.col("config")["sink_table"].alias("sink_table"), "op", row["id"].alias("row_key"), "ts_ms",
                    cdc.map_text(pruned).alias("columns"))


query("cdc_config_history", f"""
WITH o AS (SELECT *, epoch_ms(o_orderdate) AS t, {ORDER_OP_SQL} AS op FROM orders),
c AS (SELECT *, (1700000000 + c_custkey) * 1000 AS t, CASE {CUST_TYPE_SQL} WHEN 'update' THEN 'u' WHEN 'insert' THEN 'c' ELSE 'r' END AS op FROM customer)
SELECT 'dim_order_info' AS sink_table, op, CAST(o_orderkey AS VARCHAR) AS row_key, t AS ts_ms,
  'id=' || CAST(o_orderkey AS VARCHAR) || ',user_id=' || CAST(o_custkey AS VARCHAR) AS columns
FROM o WHERE t >= {_T95} AND t < {_T97}
UNION ALL
SELECT 'dim_order_2', op, CAST(o_orderkey AS VARCHAR), t, 'id=' || CAST(o_orderkey AS VARCHAR) || ',order_status=' || o_orderstatus
FROM o WHERE t >= {_T98}
UNION ALL
SELECT 'dim_user_info', op, CAST(c_custkey AS VARCHAR), t,
  'id=' || CAST(c_custkey AS VARCHAR) || ',name=' || c_name
    || CASE WHEN t < {_USER_T2} THEN ',nation_id=' || CAST(c_nationkey AS VARCHAR) ELSE ',segment=' || c_mktsegment END
FROM c WHERE t >= {_USER_T1}
""")(cdc_config_history)


# ---- dimension maintenance -------------------------------------------------------------------

DIM_COLS = ["name", "nation_id", "segment", "acctbal"]


def dim_user_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t.read(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
                    F.col("c_nationkey").cast("string").alias("nation_id"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_acctbal").cast("decimal(16,2)").cast("string").alias("acctbal"))


def dim_user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes to apply: balances below -900 are deletes; HOUSEHOLD rows are updates with an
    empty name (the old name must survive), a new segment and balance + 100; BUILDING rows
    re-register under id + 10,000,000 (inserts).  HOUSEHOLD rows get a second, later put of the
    segment alone; balances below -950 are inserted again after their delete, without name."""
    c = t.read(spark, sf_dir, "customer")
    bal = F.col("c_acctbal").cast("decimal(16,2)")
    dels = c.filter(F.col("c_acctbal") < -900).select(
        F.col("c_custkey").cast("string").alias("id"), F.lit("d").alias("op"), F.lit(2).cast("bigint").alias("ts_ms"),
        *[F.lit(None).cast("string").alias(x) for x in DIM_COLS])
    ups = c.filter(F.col("c_mktsegment") == "HOUSEHOLD").select(
        F.col("c_custkey").cast("string").alias("id"), F.lit("u").alias("op"), F.lit(1).cast("bigint").alias("ts_ms"),
        F.lit("").alias("name"), F.lit(None).cast("string").alias("nation_id"), F.lit("HOUSEHOLD_VIP").alias("segment"),
        (bal + 100).cast("string").alias("acctbal"))
    ins = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        (F.col("c_custkey") + 10_000_000).cast("string").alias("id"), F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("ts_ms"),
        F.concat(F.col("c_name"), F.lit("_2")).alias("name"), F.col("c_nationkey").cast("string").alias("nation_id"),
        F.col("c_mktsegment").alias("segment"), bal.cast("string").alias("acctbal"))
    later = ups.select("id", F.lit("u").alias("op"), F.lit(3).cast("bigint").alias("ts_ms"), F.lit(None).cast("string").alias("name"),
                       F.lit("").alias("nation_id"), F.lit("HOUSEHOLD_TOP").alias("segment"), F.lit(None).cast("string").alias("acctbal"))
    again = c.filter(F.col("c_acctbal") < -950).select(
        F.col("c_custkey").cast("string").alias("id"), F.lit("c").alias("op"), F.lit(4).cast("bigint").alias("ts_ms"),
        F.lit("").alias("name"), F.lit("7").alias("nation_id"), F.lit("BACK").alias("segment"), F.lit(None).cast("string").alias("acctbal"))
    return dels.unionByName(ups).unionByName(ins).unionByName(later).unionByName(again)


def dim_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """put/delete by row key; empty values keep the old cell."""
    return merge_dimension(dim_user_snapshot(spark, sf_dir), dim_user_changes(spark, sf_dir), "id", DIM_COLS)


DIM_MERGE_SQL = """
WITH c AS (
  SELECT *, CAST(c_acctbal AS DECIMAL(16,2)) AS bal, c_acctbal < -900 AS del, c_acctbal < -950 AS back,
    c_mktsegment = 'HOUSEHOLD' AS hh FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN NOT del THEN c_name END AS name,
  CASE WHEN back THEN '7' WHEN NOT del THEN CAST(c_nationkey AS VARCHAR) END AS nation_id,
  CASE WHEN back THEN 'BACK' WHEN hh THEN 'HOUSEHOLD_TOP' ELSE c_mktsegment END AS segment,
  CASE WHEN NOT del THEN CAST(bal + CASE WHEN hh THEN 100 ELSE 0 END AS VARCHAR) END AS acctbal
FROM c WHERE NOT del OR hh OR back
UNION ALL
SELECT CAST(c_custkey + 10000000 AS VARCHAR), c_name || '_2', CAST(c_nationkey AS VARCHAR), c_mktsegment, CAST(bal AS VARCHAR)
FROM c WHERE c_mktsegment = 'BUILDING'
"""

query("dim_upsert_merge", DIM_MERGE_SQL)(dim_upsert_merge)


def keyed_table_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 over change files: the snapshot is the oldest of three batches but comes last, the changes come in
    two batches against the order of their times, with a compaction between; deletes are cells too."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/keyed-{uuid.uuid4().hex}"
    table = KeyedTable(spark, folder, {"id": "string"}, dict.fromkeys(DIM_COLS, "string"), buckets=16)
    snap = dim_user_snapshot(spark, sf_dir).select("id", F.lit("r").alias("op"), F.lit(0).cast("bigint").alias("ts_ms"), *DIM_COLS)
    changes = dim_user_changes(spark, sf_dir)
    table.write(changes.where("ts_ms >= 3"), 0, "ts_ms", "op", skip_empty=True)
    table.write(changes.where("ts_ms < 3"), 1, "ts_ms", "op", skip_empty=True)
    table.compact(0)
    table.write(snap, 2, "ts_ms", "op", skip_empty=True)
    return table.read()


query("keyed_table_dim", DIM_MERGE_SQL)(keyed_table_dim)


def dim_upsert_ignore_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 with F16: deletes ignored, nulls written as 'null', row key = md5 of the id."""
    m = merge_dimension(dim_user_snapshot(spark, sf_dir), dim_user_changes(spark, sf_dir), "id", DIM_COLS,
                        ignore_deletes=True, null_text=True)
    return m.select(F.md5("id").alias("row_key"), "id", *DIM_COLS)


query("dim_upsert_ignore_deletes", """
WITH c AS (
  SELECT *, CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS VARCHAR) AS bal, c_acctbal < -950 AS back, c_mktsegment = 'HOUSEHOLD' AS hh FROM customer)
SELECT md5(CAST(c_custkey AS VARCHAR)) AS row_key, CAST(c_custkey AS VARCHAR) AS id,
  CASE WHEN back THEN '' WHEN hh THEN 'null' ELSE c_name END AS name,
  CASE WHEN back THEN '7' WHEN hh THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation_id,
  CASE WHEN back THEN 'BACK' WHEN hh THEN 'HOUSEHOLD_TOP' ELSE c_mktsegment END AS segment,
  CASE WHEN back OR hh THEN 'null' ELSE bal END AS acctbal
FROM c
UNION ALL
SELECT md5(CAST(c_custkey + 10000000 AS VARCHAR)), CAST(c_custkey + 10000000 AS VARCHAR), c_name || '_2',
  CAST(c_nationkey AS VARCHAR), c_mktsegment, bal
FROM c WHERE c_mktsegment = 'BUILDING'
""")(dim_upsert_ignore_deletes)


def dim_scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 row count of the merged dimension, per segment."""
    m = dim_upsert_merge(spark, sf_dir)
    return m.groupBy("segment").agg(F.count("*").alias("row_count"))


query("dim_scan_count", f"""
SELECT segment, count(*) AS row_count FROM ({DIM_MERGE_SQL}) GROUP BY segment
""")(dim_scan_count)


# ---- snapshot, then log ----------------------------------------------------------------------

CHUNK_KEYS = 1000


def _snapshot_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``orders`` read in chunks of the key beside its change log.  Stand-in for positions: a chunk's marks and a
    change's position follow from the key, so changes fall before, between and after the marks.  The rows
    read lack every 13th order; the log delivers some changes twice and follows some with another."""
    o = t.read(spark, sf_dir, "orders")
    chunk = F.floor(F.col("o_orderkey") / CHUNK_KEYS).cast("bigint")
    rows = o.where("o_orderkey % 13 <> 0").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("s"), "o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(16,2)").cast("string").alias("amount"))
    low = F.col("chunk") * 1009 % 60_000
    marks = o.select(chunk.alias("chunk")).distinct().select("chunk", low.alias("low"), (low + 30_000).alias("high"))
    c = cdc.normalise(cdc.parse_envelopes(order_envelopes(spark, sf_dir)))
    log = c.where("op <> 'r'").select(cdc.row_id().cast("bigint").alias("id"), "op", F.col("after")["order_status"].alias("status"),
                                      F.col("after")["total_amount"].alias("amount"))
    pos = F.col("id") * 7919 % 100_000
    own = F.struct("id", "op", "status", "amount", pos.alias("pos"))
    follow = F.struct("id", F.lit("u").alias("op"), F.lit("X").alias("status"), F.lit("1.00").alias("amount"), (pos + 20_000).alias("pos"))
    rows_ = F.concat(F.array(own), F.when(F.col("id") % 5 == 0, F.array(own)).otherwise(F.array()),
                     F.when(F.col("id") % 3 == 0, F.array(follow)).otherwise(F.array()))
    return rows, marks, log.select(F.inline(rows_))


def snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the chunked snapshot reconciled with the log, as one stream of changes."""
    rows, marks, log = _snapshot_inputs(spark, sf_dir)
    return snapshot_then_log(rows, marks, log, "id", lambda k: F.floor(k / CHUNK_KEYS).cast("bigint"), ["status", "amount"])


SNAPSHOT_SQL = f"""
WITH m AS (SELECT DISTINCT o_orderkey // 1000 AS chunk, (o_orderkey // 1000) * 1009 % 60000 AS low,
             (o_orderkey // 1000) * 1009 % 60000 + 30000 AS high FROM orders),
s AS (SELECT o_orderkey AS id, 's' || o_orderstatus AS status, CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS amount
      FROM orders WHERE o_orderkey % 13 <> 0),
c AS (SELECT o_orderkey AS id, {ORDER_OP_SQL} AS op, o_orderstatus AS status,
        CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS amount, o_orderkey * 7919 % 100000 AS pos FROM orders),
g AS (SELECT id, op, CASE WHEN op <> 'd' THEN status END AS status, CASE WHEN op <> 'd' THEN amount END AS amount, pos FROM c WHERE op <> 'r'
      UNION ALL SELECT id, 'u', 'X', '1.00', pos + 20000 FROM c WHERE op <> 'r' AND id % 3 = 0),
l AS (SELECT g.*, low, high FROM g JOIN m ON g.id // 1000 = m.chunk),
i AS (SELECT * FROM l WHERE pos > low AND pos <= high QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos DESC) = 1)
SELECT coalesce(s.id, i.id) AS id, m.high AS pos, 'r' AS op, CASE WHEN i.id IS NULL THEN s.status ELSE i.status END AS status,
  CASE WHEN i.id IS NULL THEN s.amount ELSE i.amount END AS amount
FROM s FULL JOIN i ON s.id = i.id JOIN m ON m.chunk = coalesce(s.id, i.id) // 1000 WHERE i.op IS NULL OR i.op <> 'd'
UNION ALL SELECT id, pos, op, status, amount FROM l WHERE pos > high
"""

query("snapshot_log", SNAPSHOT_SQL)(snapshot_log)


def snapshot_log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the table that the reconciled snapshot and the later changes leave."""
    return table_after(snapshot_log(spark, sf_dir), "id", ["status", "amount"])


query("snapshot_log_table", f"""
SELECT id, status, amount FROM ({SNAPSHOT_SQL})
QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos DESC, op <> 'r' DESC) = 1 AND op <> 'd'
""")(snapshot_log_table)
