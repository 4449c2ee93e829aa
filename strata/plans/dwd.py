"""DWD layer: cleaned fact tables (order detail, cancel, payment, refund, refund payment, cart, comment)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.dates import ts_to_ms
from strata.operators import facts as fx
from strata.operators.dedupe import latest_per_entity
from strata.operators.joins import enrich, literal_broadcast
from strata.plans.dws import LATEST_DETAIL_SQL, latest_details
from strata.plans.registry import query
from strata.sources import tables as t

# ---- net order details as the order_detail table (Spark and SQL forms) ------------------

DETAIL_COLS = ["sku_id", "sku_num", "split_original_amount", "split_activity_amount",
               "split_coupon_amount", "split_total_amount"]


def detail_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_detail rows after the upsert (last version per id), fact-topic column types."""
    d = latest_details(spark, sf_dir, DETAIL_COLS)
    return d.select(
        fx.detail_id().alias("id"),
        F.col("l_orderkey").alias("order_id"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        "l_discount", "l_tax", "l_quantity",
        F.col("sku_id").cast("string").alias("sku_id"),
        F.concat(F.lit("sku-"), F.col("sku_id").cast("string")).alias("sku_name"),
        F.col("sku_num").cast("string").alias("sku_num"),
        fx.amount_text("split_original_amount").alias("split_original_amount"),
        fx.amount_text("split_activity_amount").alias("split_activity_amount"),
        fx.amount_text("split_coupon_amount").alias("split_coupon_amount"),
        fx.amount_text("split_total_amount").alias("split_total_amount"),
        ts_to_ms("l_shipdate").cast("string").alias("create_time"),
        ts_to_ms("l_shipdate").alias("ts_ms"),
    )


DETAIL_SQL = f"""
SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id,
  l_orderkey AS order_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
  l_discount, l_tax, l_quantity,
  CAST(l_partkey AS VARCHAR) AS sku_id, 'sku-' || CAST(l_partkey AS VARCHAR) AS sku_name,
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS sku_num,
  CAST(split_original_amount AS VARCHAR) AS split_original_amount,
  CAST(split_activity_amount AS VARCHAR) AS split_activity_amount,
  CAST(split_coupon_amount AS VARCHAR) AS split_coupon_amount,
  CAST(split_total_amount AS VARCHAR) AS split_total_amount,
  CAST(epoch_ms(l_shipdate) AS VARCHAR) AS create_time,
  epoch_ms(l_shipdate) AS ts_ms
FROM ({LATEST_DETAIL_SQL})
"""


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as order_info: user = customer, province = the customer's nation."""
    o = t.read(spark, sf_dir, "orders")
    c = t.read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_custkey").cast("string").alias("user_id"),
                    F.col("c_nationkey").cast("string").alias("province_id"),
                    F.col("o_orderstatus").alias("order_status"),
                    ts_to_ms("o_orderdate").alias("order_ts_ms")))


ORDER_INFO_SQL = """
SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS user_id, CAST(c_nationkey AS VARCHAR) AS province_id,
       o_orderstatus AS order_status, epoch_ms(o_orderdate) AS order_ts_ms
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""

# Stand-in link tables: a detail with a version discounted by at least 5 % carries an
# activity (of the largest discount), one taxed at least 6 % a coupon (of the last supplier).
ACTIVITY_SQL = """
SELECT l_orderkey, l_linenumber, CAST(CAST(round(max(l_discount) * 100) AS INTEGER) AS VARCHAR) AS activity_id,
       CAST(CAST(round(max(l_discount) * 100) AS INTEGER) AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS activity_rule_id
FROM lineitem WHERE l_discount >= 0.05 GROUP BY l_orderkey, l_linenumber
"""
COUPON_SQL = """
SELECT l_orderkey, l_linenumber, 'cp' || CAST(max(l_suppkey) AS VARCHAR) AS coupon_id
FROM lineitem WHERE l_tax >= 0.06 GROUP BY l_orderkey, l_linenumber
"""


def links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """order_detail_activity and order_detail_coupon, one row per detail key."""
    li = t.read(spark, sf_dir, "lineitem")
    pct = F.round(F.max("l_discount") * 100).cast("int").cast("string")
    act = (li.filter(F.col("l_discount") >= 0.05).groupBy(*t.DETAIL_KEY).agg(pct.alias("activity_id"))
           .withColumn("activity_rule_id", F.concat_ws("_", "activity_id", F.col("l_linenumber").cast("string"))))
    cou = li.filter(F.col("l_tax") >= 0.06).groupBy(*t.DETAIL_KEY).agg(
        F.concat(F.lit("cp"), F.max("l_suppkey").cast("string")).alias("coupon_id"))
    return act, cou


def order_detail_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order detail fact (P8, J4, F4, F11, S7): net details x order_info, left activity and coupon.

    The links are joined on the detail's two-column key, by which ranking left the details
    partitioned; the one shuffle after that is by order."""
    act, cou = links(spark, sf_dir)
    return fx.order_detail_fact(detail_table(spark, sf_dir), order_info(spark, sf_dir), act, cou, on=t.DETAIL_KEY)


ORDER_DETAIL_FACT_SQL = f"""
SELECT d.id, d.order_id, o.user_id, d.sku_id, d.sku_name, o.province_id, a.activity_id, a.activity_rule_id, c.coupon_id,
  strftime(make_timestamp(CAST(d.create_time AS BIGINT) * 1000), '%Y-%m-%d') AS date_id,
  d.create_time, d.sku_num, d.split_original_amount, d.split_activity_amount, d.split_coupon_amount,
  d.split_total_amount, d.ts_ms
FROM ({DETAIL_SQL}) d JOIN ({ORDER_INFO_SQL}) o ON d.order_id = o.order_id
LEFT JOIN ({ACTIVITY_SQL}) a ON d.l_orderkey = a.l_orderkey AND d.l_linenumber = a.l_linenumber
LEFT JOIN ({COUPON_SQL}) c ON d.l_orderkey = c.l_orderkey AND d.l_linenumber = c.l_linenumber
"""

query("order_detail_fact", ORDER_DETAIL_FACT_SQL)(order_detail_fact)


def order_cancels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_info rows in the cancel status ('P' here): operated an hour after the order."""
    o = fx.status_filter(t.read(spark, sf_dir, "orders"), "o_orderstatus", ["P"])
    at = ts_to_ms("o_orderdate") + 3_600_000
    return o.select(F.col("o_orderkey").alias("order_id"), at.cast("string").alias("operate_time"), at.alias("ts_ms"))


def order_cancel_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancelled order details (P16, J5): cancels x the order detail fact.

    ``streaming.facts.cancel_stream`` is the stream form, where the 1805 s bound limits the
    state; the batch form joins the two tables whole.
    """
    od = order_detail_fact(spark, sf_dir)
    return fx.cancel_rows(order_cancels(spark, sf_dir).join(od.drop("ts_ms"), "order_id"))


query("order_cancel_fact", f"""
SELECT d.id, d.order_id, d.user_id, d.sku_id, d.sku_name, d.province_id, d.activity_id, d.activity_rule_id, d.coupon_id,
  d.date_id, CAST(epoch_ms(o_orderdate) + 3600000 AS VARCHAR) AS operate_time, d.sku_num, d.split_original_amount,
  d.split_activity_amount, d.split_coupon_amount, d.split_total_amount, epoch_ms(o_orderdate) + 3600000 AS ts_ms
FROM orders JOIN ({ORDER_DETAIL_FACT_SQL}) d ON d.order_id = o_orderkey WHERE o_orderstatus = 'P'
""")(order_cancel_fact)


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """payment_info stand-in, one payment per order: orders in status 'F' are paid (1602), the
    rest are not (1601); the type is one of three by key, the call-back within half an hour."""
    o = t.read(spark, sf_dir, "orders")
    at = ts_to_ms("o_orderdate") + F.col("o_orderkey") % 1800 * 1000
    return o.select(F.col("o_orderkey").alias("order_id"), (F.col("o_orderkey") % 3 + 1101).cast("string").alias("payment_type_code"),
                    at.cast("string").alias("callback_time"), at.alias("ts_ms"),
                    F.when(F.col("o_orderstatus") == "F", "1602").otherwise("1601").alias("payment_status"))


def payment_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid order details (P16, J6): successful payments (1602) x the order detail fact.
    Stream form: ``streaming.facts.payment_stream``."""
    pay = fx.status_filter(payment_info(spark, sf_dir), "payment_status", ["1602"])
    od = order_detail_fact(spark, sf_dir)
    return fx.payment_rows(pay.join(od.drop("ts_ms"), "order_id"))


query("payment_fact", f"""
SELECT d.id AS order_detail_id, d.order_id, d.user_id, d.sku_id, d.sku_name, d.province_id, d.activity_id, d.activity_rule_id,
  d.coupon_id, CAST(o_orderkey % 3 + 1101 AS VARCHAR) AS payment_type_code,
  CAST(epoch_ms(o_orderdate) + o_orderkey % 1800 * 1000 AS VARCHAR) AS callback_time, d.sku_num, d.split_original_amount,
  d.split_activity_amount, d.split_coupon_amount, d.split_total_amount AS split_payment_amount,
  epoch_ms(o_orderdate) + o_orderkey % 1800 * 1000 AS ts_ms
FROM orders JOIN ({ORDER_DETAIL_FACT_SQL}) d ON d.order_id = o_orderkey WHERE o_orderstatus = 'F'
""")(payment_fact)


def refund_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refunds (J7): refund rows (details with return flag 'R') x order_info in refund status ('O')."""
    det = detail_table(spark, sf_dir).filter(F.col("l_returnflag") == "R")
    oi = fx.status_filter(order_info(spark, sf_dir), "order_status", ["O"])
    return det.join(oi, "order_id").select(
        "id", "order_id", "user_id", "sku_id", "province_id",
        F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd").alias("date_id"),
        F.col("create_time"), F.col("sku_num").alias("refund_num"),
        F.col("split_total_amount").alias("refund_amount"), "ts_ms")


query("refund_fact", f"""
SELECT d.id, d.order_id, o.user_id, d.sku_id, o.province_id,
  strftime(make_timestamp(d.ts_ms * 1000), '%Y-%m-%d') AS date_id, d.create_time,
  d.sku_num AS refund_num, d.split_total_amount AS refund_amount, d.ts_ms
FROM ({DETAIL_SQL}) d JOIN ({ORDER_INFO_SQL}) o ON d.order_id = o.order_id
WHERE d.l_returnflag = 'R' AND o.order_status = 'O'
""")(refund_fact)


def refund_payment_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refund payments (J8): refund payment x refund on (order_id, sku_id), then x order_info.

    Stand-ins: refunds are the details with return flag 'R' (quantities summed per order and
    sku), successful refund payments those with line status 'F', orders refunded those in
    status 'F'.  Both sides come from the details, so the first join is a sum over the lines
    of one order and sku.  Stream form, with two joins: ``streaming.facts.refund_payment_stream``.
    """
    det = detail_table(spark, sf_dir).filter(F.col("l_returnflag") == "R")
    summed = F.sum(F.col("sku_num").cast("bigint")).over(Window.partitionBy("order_id", "sku_id"))
    pay = det.select("id", "order_id", "sku_id", "l_linestatus", F.col("split_total_amount").alias("total_amount"),
                     F.col("ts_ms").cast("string").alias("callback_time"), "ts_ms", summed.alias("refund_num"),
                     (F.col("order_id") % 3 + 1101).cast("string").alias("payment_type")).filter(F.col("l_linestatus") == "F")
    oi = fx.status_filter(order_info(spark, sf_dir), "order_status", ["F"]).select("order_id", "user_id", "province_id")
    return fx.refund_payment_rows(pay.join(oi, "order_id"))


query("refund_payment_fact", f"""
WITH d AS ({DETAIL_SQL}),
pay AS (SELECT id, order_id, sku_id, split_total_amount AS total_amount, ts_ms FROM d WHERE l_returnflag = 'R' AND l_linestatus = 'F'),
ref AS (SELECT order_id, sku_id, CAST(sum(CAST(sku_num AS BIGINT)) AS BIGINT) AS refund_num FROM d WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT p.id, o.user_id, p.order_id, p.sku_id, o.province_id, CAST(p.order_id % 3 + 1101 AS VARCHAR) AS payment_type,
  strftime(make_timestamp(p.ts_ms * 1000), '%Y-%m-%d') AS date_id, CAST(p.ts_ms AS VARCHAR) AS callback_time,
  r.refund_num, p.total_amount, p.ts_ms
FROM pay p JOIN ref r ON p.order_id = r.order_id AND p.sku_id = r.sku_id
JOIN ({ORDER_INFO_SQL}) o ON p.order_id = o.order_id WHERE o.order_status = 'F'
""")(refund_payment_fact)


# ---- cart adds -----------------------------------------------------------------------------

def cart_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cart_info change stream stand-in: versions of one order detail are the cart row's
    insert ('c', first version) and updates ('u', later versions, before = previous quantity).

    The position and previous quantity come from a two-level scan over ship-month
    chunks (``operators/scan.seq_and_previous``): a row with very many versions is
    spread over many tasks instead of one.
    """
    from strata.operators.scan import seq_and_previous
    d = t.order_detail(spark, sf_dir).select(*t.DETAIL_KEY, *t.DETAIL_ORDER, "sku_id", "sku_num")
    s = seq_and_previous(d, t.DETAIL_KEY, t.DETAIL_ORDER, F.date_trunc("month", "l_shipdate"), ["sku_num"])
    return s.select(
        fx.detail_id().alias("id"), "l_orderkey", F.col("sku_id").cast("string").alias("sku_id"),
        F.when(F.col("seq") == 1, "c").otherwise("u").alias("op"),
        F.col("sku_num").alias("sku_num_after"),
        F.col("prev_sku_num").alias("sku_num_before"),
        ts_to_ms("l_shipdate").alias("ts_ms"),
        F.struct(*[F.col(c) for c in t.DETAIL_ORDER]).alias("version"),
    )


def cart_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart adds (P7, P8, F12, S7): adds from inserts and grown updates, upserted by id (last wins)."""
    adds = fx.cart_add(cart_changes(spark, sf_dir))
    last = latest_per_entity(adds.select("id", "l_orderkey", "sku_id", "sku_num", "ts_ms", "version"),
                             ["l_orderkey", "id"], ["version"]).drop("version")
    users = t.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias("user_id"))
    return last.join(users, "l_orderkey").select(
        "id", "user_id", "sku_id", F.col("sku_num").cast("string").alias("sku_num"), "ts_ms")


query("cart_fact", """
WITH v AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id, l_orderkey,
    CAST(l_partkey AS VARCHAR) AS sku_id, epoch_ms(l_shipdate) AS ts_ms,
    CAST(l_quantity AS BIGINT) AS after_num,
    lag(CAST(l_quantity AS BIGINT)) OVER w AS before_num,
    row_number() OVER w AS rn,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
      l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rdesc
  FROM lineitem
  WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity,
               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus)),
a AS (SELECT *, CASE WHEN rn = 1 THEN after_num ELSE after_num - before_num END AS sku_num
      FROM v WHERE rn = 1 OR after_num > before_num)
SELECT a.id, CAST(o.o_custkey AS VARCHAR) AS user_id, a.sku_id, CAST(a.sku_num AS VARCHAR) AS sku_num, a.ts_ms
FROM a JOIN orders o ON a.l_orderkey = o.o_orderkey
QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY a.rdesc) = 1
""")(cart_fact)


# ---- comments and the dictionary lookup -----------------------------------------------------

# The appraisal dictionary (base_dic rows of parent code 12).
APPRAISE_DIC = [("1201", "好评"), ("1202", "中评"), ("1203", "差评"), ("1204", "自动")]
DIC_SQL = "(VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in APPRAISE_DIC) + ") AS dic(dic_code, dic_name)"


def dictionary(spark: SparkSession) -> DataFrame:
    return t.literal_table(spark, APPRAISE_DIC, "dic_code string, dic_name string")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """comment_info stand-in: documents, appraisal code from ``labels``.

    quality 1 -> 1201, quality 0 -> 1203, toxic -> 1205 (not in the dictionary);
    unlabelled documents have no code.
    """
    docs = t.read(spark, sf_dir, "documents")
    lab = t.read(spark, sf_dir, "labels")
    code = (F.when(F.col("toxic") == 1, "1205").when(F.col("quality") == 1, "1201")
            .when(F.col("quality") == 0, "1203"))
    return (docs.join(lab, "doc_id", "left")
            .select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("user_id"),
                    "lang", code.alias("appraise"), F.col("text").alias("comment_txt")))


COMMENTS_SQL = """
SELECT CAST(d.doc_id AS VARCHAR) AS id, d.source AS user_id, d.lang,
  CASE WHEN l.toxic = 1 THEN '1205' WHEN l.quality = 1 THEN '1201' WHEN l.quality = 0 THEN '1203' END AS appraise,
  d.text AS comment_txt
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def comment_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment fact (P8, J3): comments inner-joined to the appraisal dictionary (broadcast literal)."""
    c = comments(spark, sf_dir)
    dic = literal_broadcast(dictionary(spark))
    return c.join(dic, c.appraise == dic.dic_code, "inner").select(
        "id", "user_id", "lang", "appraise", F.col("dic_name").alias("appraise_name"), "comment_txt")


query("comment_fact", f"""
SELECT c.id, c.user_id, c.lang, c.appraise, dic.dic_name AS appraise_name, c.comment_txt
FROM ({COMMENTS_SQL}) c JOIN {DIC_SQL} ON c.appraise = dic.dic_code
""")(comment_fact)


def dict_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left dictionary lookup with default 'N/A' for a missing code."""
    c = comments(spark, sf_dir)
    return enrich(c, dictionary(spark), "appraise", "dic_code", {"dic_name": "appraise_name"},
                  default={"appraise_name": "N/A"}, literal=True).select(
        "id", "user_id", "lang", "appraise", "appraise_name", "comment_txt")


query("dict_lookup_default", f"""
SELECT c.id, c.user_id, c.lang, c.appraise, coalesce(dic.dic_name, 'N/A') AS appraise_name, c.comment_txt
FROM ({COMMENTS_SQL}) c LEFT JOIN {DIC_SQL} ON c.appraise = dic.dic_code
""")(dict_lookup_default)


# ---- snowflake lookups (J19, J21, J22) --------------------------------------------------------

def category_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A three-level hierarchy joined level by level (inner, as the batch SQL does):
    customer -> nation -> region."""
    from strata.operators.joins import lookup_chain
    c = t.read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = t.read(spark, sf_dir, "nation")
    r = t.read(spark, sf_dir, "region")
    out = lookup_chain(c, [(n, "c_nationkey", "n_nationkey", {"n_name": "nation_name", "n_regionkey": "region_key"}),
                           (r, "region_key", "r_regionkey", {"r_name": "region_name"})], how="inner")
    return out.select("c_custkey", "nation_name", "region_name")


query("category_chain", """
SELECT c.c_custkey, n.n_name AS nation_name, r.r_name AS region_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")(category_chain)


def sku_snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every net order detail with its sku (part) name, brand and category, its
    supplier and the supplier's nation and region, by left lookups (missing dims -> null).
    Part and supplier grow with the data: each is broadcast only when its size check passes."""
    from strata.operators.joins import lookup_chain
    det = detail_table(spark, sf_dir).select("id", "l_partkey", "l_suppkey")
    steps = [
        (t.read(spark, sf_dir, "part"), "l_partkey", "p_partkey",
         {"p_name": "sku_name", "p_brand": "tm_name", "p_type": "category_name"}),
        (t.read(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", {"s_name": "supplier_name", "s_nationkey": "s_nation"}),
        (t.read(spark, sf_dir, "nation"), "s_nation", "n_nationkey", {"n_name": "supplier_nation", "n_regionkey": "s_region"}),
        (t.read(spark, sf_dir, "region"), "s_region", "r_regionkey", {"r_name": "supplier_region"}),
    ]
    out = lookup_chain(det, steps, how="left")
    return out.select("id", "sku_name", "tm_name", "category_name", "supplier_name", "supplier_nation", "supplier_region")


query("sku_snowflake", f"""
SELECT d.id, p.p_name AS sku_name, p.p_brand AS tm_name, p.p_type AS category_name, s.s_name AS supplier_name,
  n.n_name AS supplier_nation, r.r_name AS supplier_region
FROM ({DETAIL_SQL}) d LEFT JOIN part p ON d.l_partkey = p.p_partkey LEFT JOIN supplier s ON d.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")(sku_snowflake)
