"""Change-data-capture envelopes: the two wire forms, their schemas, and the stand-in topic.

Form 1 (log-based capture): ``{op, before, after, source{db, table, ts_ms}, ts_ms}``.
Form 2 (binlog relay):      ``{database, table, type, ts (seconds), data, old}``.
Both are read with one schema and normalised to
``(db, table_name, op, is_bootstrap, before, after, ts_ms)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import tables as t

S = T.StringType()
M = T.MapType(S, S)

ENVELOPE_SCHEMA = T.StructType([
    # form 1
    T.StructField("op", S), T.StructField("before", M), T.StructField("after", M),
    T.StructField("source", T.MapType(S, S)), T.StructField("ts_ms", T.LongType()),
    # form 2
    T.StructField("database", S), T.StructField("table", S), T.StructField("type", S),
    T.StructField("ts", T.LongType()), T.StructField("data", M), T.StructField("old", M),
])

DB = "shop"


def _money_text(c: str):
    return F.col(c).cast("decimal(16,2)").cast("string")


def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as form-1 changes of ``order_info``: status F is a snapshot read ('r', or a
    delete 'd' for priority 5-LOW), O an insert ('c'), P an update ('u') from status O."""
    o = t.read(spark, sf_dir, "orders")
    ms = F.unix_millis("o_orderdate")

    def row(status):
        return F.create_map(
            F.lit("id"), F.col("o_orderkey").cast("string"),
            F.lit("user_id"), F.col("o_custkey").cast("string"),
            F.lit("order_status"), status,
            F.lit("total_amount"), _money_text("o_totalprice"),
            F.lit("create_time"), ms.cast("string"),
            F.lit("order_priority"), F.col("o_orderpriority"))

    st = F.col("o_orderstatus")
    op = (F.when((st == "F") & (F.col("o_orderpriority") == "5-LOW"), "d").when(st == "F", "r")
          .when(st == "O", "c").otherwise("u"))
    env = F.struct(
        op.alias("op"),
        F.when(op == "d", row(st)).when(op == "u", row(F.lit("O"))).alias("before"),
        F.when(op != "d", row(st)).alias("after"),
        F.create_map(F.lit("db"), F.lit(DB), F.lit("table"), F.lit("order_info"),
                     F.lit("ts_ms"), ms.cast("string")).alias("source"),
        ms.alias("ts_ms"))
    return o.select(F.to_json(env).alias("value"))


def customer_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as form-2 changes of ``user_info``: negative balances are updates (old balance
    0.00), the AUTOMOBILE segment arrives as bootstrap rows, the rest as inserts."""
    c = t.read(spark, sf_dir, "customer")
    typ = (F.when(F.col("c_acctbal") < 0, "update").when(F.col("c_mktsegment") == "AUTOMOBILE", "bootstrap-insert")
           .otherwise("insert"))
    data = F.create_map(
        F.lit("id"), F.col("c_custkey").cast("string"), F.lit("name"), F.col("c_name"),
        F.lit("nation_id"), F.col("c_nationkey").cast("string"), F.lit("segment"), F.col("c_mktsegment"),
        F.lit("acctbal"), _money_text("c_acctbal"))
    env = F.struct(F.lit(DB).alias("database"), F.lit("user_info").alias("table"), typ.alias("type"),
                   (F.lit(1_700_000_000) + F.col("c_custkey")).alias("ts"), data.alias("data"),
                   F.when(typ == "update", F.create_map(F.lit("acctbal"), F.lit("0.00"))).alias("old"))
    return c.select(F.to_json(env).alias("value"))


def comment_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as form-1 changes of ``comment_info``, each on the order of its key, 0-119 s after
    it: inserts, and a delete ('d', no ``after``) for every eleventh."""
    o = t.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderdate")
    lab = t.read(spark, sf_dir, "labels")
    d = t.read(spark, sf_dir, "documents").join(lab, "doc_id", "left").join(o, "doc_id")
    ms = F.unix_millis("o_orderdate") + F.col("doc_id") % 120 * 1000
    code = (F.when(F.col("toxic") == 1, "1205").when(F.col("quality") == 1, "1201").when(F.col("quality") == 0, "1203"))
    key = F.col("doc_id").cast("string")
    row = F.create_map(F.lit("id"), key, F.lit("order_id"), key, F.lit("user_id"), F.col("source"),
                       F.lit("appraise"), code, F.lit("comment_txt"), F.col("text"), F.lit("create_time"), ms.cast("string"))
    gone = F.col("doc_id") % 11 == 0
    env = F.struct(F.when(gone, "d").otherwise("c").alias("op"), F.when(gone, row).alias("before"),
                   F.when(~gone, row).alias("after"),
                   F.create_map(F.lit("db"), F.lit(DB), F.lit("table"), F.lit("comment_info"), F.lit("server_id"), F.lit("1"),
                                F.lit("ts_ms"), ms.cast("string")).alias("source"), ms.alias("ts_ms"))
    return d.select(F.to_json(env).alias("value"))


def cdc_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed change topic: both envelope forms, one JSON text per line."""
    return order_envelopes(spark, sf_dir).unionByName(customer_envelopes(spark, sf_dir))
