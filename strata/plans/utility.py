"""Utility functions applied to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import keys as kf
from strata.functions import text as tf
from strata.functions.dates import normalise_epoch
from strata.plans.registry import query
from strata.sources import tables as t

# Hot keys with dedicated buckets (F15), compared in lower case.
HOT_KEYS = [("customer#000000000", "9001"), ("customer#000000001", "9002"), ("customer#000000002", "9003"),
            ("customer#000000003", "9004"), ("customer#000000004", "9005"), ("customer#000000005", "9006"),
            ("customer#000000006", "9007")]


def hash_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md5-suffix bucket (mod 128) per customer name, hot names in their own buckets."""
    c = t.read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    hot = F.broadcast(t.literal_table(spark, HOT_KEYS, "hot_key string, hot_bucket string"))
    j = c.join(hot, F.lower(c.c_name) == hot.hot_key, "left")
    return j.select("c_custkey", kf.hash_bucket("c_name").alias("bucket"),
                    kf.hash_bucket_with_hot_keys("c_name", F.col("hot_bucket")).alias("routed_bucket"))


query("hash_bucket", f"""
SELECT c_custkey, lpad(CAST(CAST('0x' || right(md5(c_name), 3) AS INTEGER) % 128 AS VARCHAR), 4, '0') AS bucket,
  coalesce(h.b, lpad(CAST(CAST('0x' || right(md5(c_name), 3) AS INTEGER) % 128 AS VARCHAR), 4, '0')) AS routed_bucket
FROM customer LEFT JOIN (VALUES {", ".join(f"('{k}', '{b}')" for k, b in HOT_KEYS)}) AS h(k, b) ON lower(c_name) = h.k
""")(hash_bucket)


def rowkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16: row keys from (nation, customer): plain, whole-key md5, per-item md5."""
    c = t.read(spark, sf_dir, "customer")
    parts = ["c_nationkey", "c_custkey"]
    return c.select("c_custkey", kf.row_key(parts).alias("rowkey_plain"),
                    kf.row_key(parts, md5_whole=True).alias("rowkey_md5"),
                    kf.row_key(parts, md5_items=True).alias("rowkey_items"))


query("rowkey", """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR) AS rowkey_plain,
  md5(CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR)) AS rowkey_md5,
  md5(CAST(c_nationkey AS VARCHAR)) || '_' || md5(CAST(c_custkey AS VARCHAR)) AS rowkey_items
FROM customer
""")(rowkey)


def string_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """capitalise / lower first letter, blank and character checks, zeros, tokens."""
    p = t.read(spark, sf_dir, "part")
    return p.select("p_partkey", tf.capitalize_first("p_name").alias("cap_name"),
                    tf.lower_first("p_type").alias("lower_type"),
                    tf.is_blank("p_name").alias("name_blank"),
                    tf.allowed_chars("p_brand").alias("brand_ok"),
                    F.concat(tf.zeros(3), F.col("p_size").cast("string")).alias("padded_size"),
                    tf.first_token("p_name").alias("first_word"),
                    tf.last_token("p_name", " ").alias("last_word"),
                    F.concat_ws(",", "p_brand", "p_type").alias("csv"))


query("string_helpers", """
SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS cap_name,
  lower(substr(p_type, 1, 1)) || substr(p_type, 2) AS lower_type,
  coalesce(trim(p_name) = '', true) AS name_blank,
  coalesce(regexp_full_match(p_brand, '[A-Za-z0-9#_]+'), false) AS brand_ok,
  '000' || CAST(p_size AS VARCHAR) AS padded_size,
  string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[-1] AS last_word,
  concat_ws(',', p_brand, p_type) AS csv
FROM part
""")(string_helpers)


def day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every day partition (yyyyMMdd as int) from a user's first to last active day."""
    ev = t.read(spark, sf_dir, "events")
    span = ev.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("d0"), F.max(F.to_date("ts")).alias("d1"))
    days = span.select("user_id", F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select("user_id", F.date_format("d", "yyyyMMdd").cast("int").alias("ds"))


query("day_range", """
SELECT user_id, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS ds FROM (
  SELECT user_id, unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d
  FROM events GROUP BY user_id)
""")(day_range)


def epoch_raw(ev: DataFrame) -> F.Column:
    """Stand-in producer mix: even event ids report epoch seconds, odd ones milliseconds."""
    return F.when(F.col("event_id") % 2 == 0, F.unix_seconds("ts")).otherwise(F.unix_millis("ts"))


def epoch_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seconds-or-millis epoch values normalised to millis (< 1e10 means seconds)."""
    ev = t.read(spark, sf_dir, "events")
    return ev.select("event_id", epoch_raw(ev).alias("raw"), normalise_epoch(epoch_raw(ev)).alias("ts_ms"))


query("epoch_normalise", """
SELECT event_id, raw, CASE WHEN raw < 10000000000 THEN raw * 1000 ELSE raw END AS ts_ms FROM (
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000000 ELSE epoch_us(ts) // 1000 END AS raw
  FROM events)
""")(epoch_normalise)


def list_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """append the user id to a JSON list text [event_type, k] (errors start from null)."""
    ev = t.events(spark, sf_dir)
    lst = F.when(F.col("event_type") != "error", F.to_json(F.array("event_type", F.col("k").cast("string"))))
    return ev.select("event_id", tf.list_append_text(lst, F.col("user_id")).alias("list_text"))


query("list_append", """
SELECT event_id, CASE WHEN event_type = 'error' THEN '[' || CAST(user_id AS VARCHAR) || ']'
  ELSE '[' || event_type || ', ' || json_extract_string(props, '$.k') || ', ' || CAST(user_id AS VARCHAR) || ']' END AS list_text
FROM events
""")(list_append)


def file_bucket_lines(ev: DataFrame) -> DataFrame:
    """Records for the day-bucketed file sink: the partition field ``ts`` holds epoch seconds
    or millis; error events carry a non-numeric value, signup events lack the field."""
    val = (F.when(F.col("event_type") == "error", F.col("props"))
           .when(F.col("event_type") == "signup", F.lit(None)).otherwise(epoch_raw(ev).cast("string")))
    return ev.select(F.to_json(F.struct("event_id", val.alias("ts"))).alias("line"))


def file_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day bucket (the bucket each record is written to)."""
    from strata.sources.sinks import day_bucket
    lines = file_bucket_lines(t.read(spark, sf_dir, "events"))
    return lines.select(day_bucket("line", "ts").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


query("file_buckets", """
SELECT CASE event_type WHEN 'error' THEN 'error_bucket' WHEN 'signup' THEN 'day=19700101'
  ELSE 'day=' || strftime(ts, '%Y%m%d') END AS bucket, count(*) AS n
FROM events GROUP BY 1
""")(file_buckets)
