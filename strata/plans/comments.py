"""Comment enrichment over change envelopes: dictionary, order fields, one flat record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import merged, prefixed
from strata.operators import cdc
from strata.operators.joins import enrich, interval_join, later_of
from strata.plans.dwd import DIC_SQL, dictionary
from strata.plans.registry import query
from strata.sources.cdc import DB, comment_envelopes, order_envelopes

BOUND_S = 60


def comment_enrichment(spark: SparkSession, sf_dir: str, bound_s: int = BOUND_S) -> DataFrame:
    """Comment and order changes of one topic: split by table (P6), comments flattened (P22) with
    the appraisal name ('N/A' when unknown, J20), orders flattened (P10), joined on the order
    within +-``bound_s`` (J14) and merged, the order's fields prefixed ``info_`` (F21)."""
    lines = comment_envelopes(spark, sf_dir).unionByName(order_envelopes(spark, sf_dir))
    env = cdc.parse_envelopes(lines).filter(F.col("source")["db"] == DB)
    com = env.filter(F.col("source")["table"] == "comment_info").select(cdc.flat_comment().alias("c")).filter("c is not null")
    com = com.select(F.col("c")["order_id"].alias("order_id"), F.col("c")["appraise"].alias("appraise"), "c",
                     F.timestamp_millis(F.col("c")["ts_ms"].cast("bigint")).alias("ts"))
    com = enrich(com, dictionary(spark), "appraise", "dic_code", {"dic_name": "dic_name"}, default={"dic_name": "N/A"}, literal=True)
    orders = env.filter(F.col("source")["table"] == "order_info").select(
        cdc.row_id().alias("order_id"), cdc.flat_change().alias("o"), F.timestamp_millis("ts_ms").alias("info_ts"))
    j = interval_join(com, orders, ["order_id"], "ts", "info_ts", -bound_s, bound_s)
    fields = merged(merged("c", F.create_map(F.lit("dic_name"), F.col("dic_name"))), prefixed("o", "info_"))
    return j.select(F.col("c")["id"].alias("id"), "order_id", "dic_name",
                    F.unix_millis(later_of("ts", "info_ts")).alias("event_ts_ms"), cdc.map_text(fields).alias("fields"))


query("comment_enrichment", f"""
WITH c AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.source AS user_id, d.text,
    CASE WHEN l.toxic = 1 THEN '1205' WHEN l.quality = 1 THEN '1201' WHEN l.quality = 0 THEN '1203' END AS appraise,
    epoch_ms(o.o_orderdate) AS order_ms, epoch_ms(o.o_orderdate) + d.doc_id % 120 * 1000 AS ts_ms, o.*
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id JOIN orders o ON d.doc_id = o.o_orderkey
  WHERE d.doc_id % 11 <> 0)
SELECT id, id AS order_id, coalesce(dic_name, 'N/A') AS dic_name, ts_ms AS event_ts_ms,
  concat_ws(',', 'appraise=' || appraise, 'commentTxt=' || text, 'create_time=' || ts_ms, 'db=shop',
    'dic_name=' || coalesce(dic_name, 'N/A'), 'id=' || id, 'info_create_time=' || order_ms, 'info_id=' || id,
    'info_op=' || CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'd' WHEN o_orderstatus = 'F' THEN 'r'
                       WHEN o_orderstatus = 'O' THEN 'c' ELSE 'u' END,
    'info_order_priority=' || o_orderpriority, 'info_order_status=' || o_orderstatus, 'info_tm_ms=' || order_ms,
    'info_total_amount=' || CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR), 'info_user_id=' || o_custkey,
    'op=c', 'order_id=' || id, 'server_id=1', 'table=comment_info', 'ts_ms=' || ts_ms, 'user_id=' || user_id) AS fields
FROM c LEFT JOIN {DIC_SQL} ON c.appraise = dic.dic_code
WHERE ts_ms - order_ms <= 60000
""")(comment_enrichment)
