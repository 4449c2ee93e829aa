"""DWS layer: windowed summaries (province, sku, traffic, home/detail, login, cart, keyword)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.bursts import with_bursts
from strata.operators.dedupe import first_per_key, latest_per_entity
from strata.operators.windows import tumbling
from strata.plans.registry import query
from strata.sources import tables as t
from strata.sources.applog import APPLOG_SQL, PAGE_SQL, app_log, login_rows, page_rows, search_rows

# Latest version of each order detail, as DuckDB sees it (shared by several oracles).
LATEST_DETAIL_SQL = """
SELECT *,
  CAST(l_extendedprice AS DECIMAL(16,2)) AS split_original_amount,
  CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2)) AS split_activity_amount,
  CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(4,2)) AS split_coupon_amount,
  CAST(l_extendedprice AS DECIMAL(16,2))
    - CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2))
    - CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(4,2)) AS split_total_amount
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
           l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1
"""


def latest_details(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Net state of the order-detail changelog: the last version of each detail.

    Ranked with ``row_number() = 1``: Spark keeps only each map task's top row per
    detail before the shuffle (partial window group limit), so a detail with very
    many versions is reduced map-side like a partial aggregate."""
    d = t.order_detail(spark, sf_dir).select(*t.DETAIL_KEY, *t.DETAIL_ORDER,
                                             *[c for c in columns if c not in t.DETAIL_KEY + t.DETAIL_ORDER])
    return latest_per_entity(d, t.DETAIL_KEY, t.DETAIL_ORDER)


def province_order_window(spark: SparkSession, sf_dir: str, size: str = "1 day") -> DataFrame:
    """Orders per province per event-time window (P3, D6 net form, W2, W5, A2, J18).

    Retractions net out to the last version of each detail, so the amount is the
    sum over latest versions (intent; the reference also kept retracted orders in
    the distinct count).  Details are pre-aggregated per order before the join,
    which makes the distinct order count a plain count and shrinks the shuffle
    to one row per order.  Which dimension is broadcast is left to Spark's byte
    threshold; customers are joined by key (they grow with the data).
    """
    det = latest_details(spark, sf_dir, ["split_total_amount"])
    per_order = det.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum("split_total_amount").alias("order_amount"))
    orders = t.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey"), F.col("o_orderdate").alias("create_time"))
    cust = t.read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("province_id"))
    prov = t.read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("province_id"), F.col("n_name").alias("province_name"))
    facts = (per_order.join(orders, "order_id")
             .join(cust, orders.o_custkey == cust.c_custkey)
             .select("order_id", "province_id", "create_time", "order_amount"))
    win = tumbling(facts, "create_time", size, ["province_id"], [
        F.sum("order_amount").cast("decimal(38,4)").alias("order_amount"),
        F.count("*").alias("order_count"),
    ])
    return win.join(prov, "province_id", "left").select(
        "stt", "edt", "cur_date", "province_id", "province_name", "order_amount", "order_count")


query("province_order_window", f"""
WITH d AS ({LATEST_DETAIL_SQL}),
per_order AS (SELECT l_orderkey AS order_id, sum(split_total_amount) AS amt FROM d GROUP BY 1),
f AS (
  SELECT o.o_orderdate AS ts, c.c_nationkey AS province_id, p.amt
  FROM per_order p JOIN orders o ON p.order_id = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT strftime(time_bucket(INTERVAL '1 day', ts), '%Y-%m-%d %H:%M:%S') AS stt,
       strftime(time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day', '%Y-%m-%d %H:%M:%S') AS edt,
       strftime(time_bucket(INTERVAL '1 day', ts), '%Y-%m-%d') AS cur_date,
       f.province_id, n.n_name AS province_name,
       CAST(sum(amt) AS DECIMAL(38,4)) AS order_amount, count(*) AS order_count
FROM f LEFT JOIN nation n ON f.province_id = n.n_nationkey
GROUP BY ALL
""")(province_order_window)


# ---- helpers shared by the event-log windows ---------------------------------------------


def _sql_window(size: str, ts: str = "ts") -> str:
    b = f"time_bucket(INTERVAL '{size}', {ts})"
    return (f"strftime({b}, '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime({b} + INTERVAL '{size}', '%Y-%m-%d %H:%M:%S') AS edt, "
            f"strftime({b}, '%Y-%m-%d') AS cur_date")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app_log(t.events(spark, sf_dir))


def traffic_dim_window(spark: SparkSession, sf_dir: str, size: str = "1 hour") -> DataFrame:
    """Page views by (vc, ch, ar, is_new) per window.

    uv: 1 on the first page row of a mid per calendar day (D3); sv: rows with an
    empty last page (a new session); pv: rows; dur: sum of during_time (null as 0).

    The uv flag is never joined back to the rows: the first row per (mid, day) is a
    combining aggregate that keeps the row's own window and dimensions, those firsts
    are counted per group, and the two small per-group results are joined.
    """
    dims = ["vc", "ch", "ar", "is_new"]
    pages = page_rows(logs(spark, sf_dir)).withColumn("d", F.to_date("ts"))
    firsts = first_per_key(pages.select("mid", "d", "ts", "event_id", *dims), ["mid", "d"], ["ts", "event_id"])
    uv = tumbling(firsts, "ts", size, dims, [F.count("*").alias("uv_ct")])
    rest = tumbling(pages, "ts", size, dims, [
        F.sum(F.when(F.coalesce(F.col("last_page_id"), F.lit("")) == "", 1).otherwise(0)).alias("sv_ct"),
        F.count("*").alias("pv_ct"),
        F.sum(F.coalesce(F.col("during_time"), F.lit(0))).alias("dur_sum"),
    ])
    keys = ["stt", "edt", "cur_date", *dims]
    out = rest.join(uv, keys, "left").withColumn("uv_ct", F.coalesce(F.col("uv_ct"), F.lit(0)).cast("bigint"))
    return out.select(*keys, "uv_ct", "sv_ct", "pv_ct", "dur_sum")


query("traffic_dim_window", f"""
WITH l AS ({PAGE_SQL}),
f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts, event_id) = 1
                     THEN 1 ELSE 0 END AS uv FROM l)
SELECT {_sql_window('1 hour')}, vc, ch, ar, is_new,
  CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct,
  count(*) AS pv_ct, CAST(sum(coalesce(during_time, 0)) AS BIGINT) AS dur_sum
FROM f GROUP BY ALL
""")(traffic_dim_window)


def home_detail_uv_window(spark: SparkSession, sf_dir: str, size: str = "1 hour") -> DataFrame:
    """Daily unique home / detail visitors per window.

    Each page type is de-duplicated on its own (mid, page, day); rows that are
    neither first home nor first detail view of the day are dropped.
    """
    pages = (logs(spark, sf_dir).filter(F.col("page_id").isin("home", "good_detail"))
             .withColumn("d", F.to_date("ts")))
    firsts = first_per_key(pages.select("mid", "page_id", "d", "ts", "event_id"),
                           ["mid", "page_id", "d"], ["ts", "event_id"])
    return tumbling(firsts, "ts", size, [], [
        F.sum(F.when(F.col("page_id") == "home", 1).otherwise(0)).alias("home_uv_ct"),
        F.sum(F.when(F.col("page_id") == "good_detail", 1).otherwise(0)).alias("good_detail_uv_ct"),
    ])


query("home_detail_uv_window", f"""
WITH l AS (SELECT * FROM ({APPLOG_SQL}) WHERE page_id IN ('home', 'good_detail')),
f AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY mid, page_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1)
SELECT {_sql_window('1 hour')},
  CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_ct,
  CAST(sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS BIGINT) AS good_detail_uv_ct
FROM f GROUP BY ALL
""")(home_detail_uv_window)


def user_login_window(spark: SparkSession, sf_dir: str, size: str = "1 day", back_days: int = 8) -> DataFrame:
    """Unique and returning users per window.

    A login is a page row with a non-empty uid whose last page is 'login' or
    empty.  Per user and day the first login counts once
    (uu); it is a return (back) when the previous login day is ``back_days`` or
    more days earlier.  The previous day comes from a window over the user's
    distinct login days, a set bounded by the calendar, not by traffic.
    """
    from pyspark.sql import Window as W
    lg = login_rows(logs(spark, sf_dir)).withColumn("d", F.to_date("ts"))
    days = first_per_key(lg.select("uid", "d", "ts", "event_id"), ["uid", "d"], ["ts", "event_id"])
    prev = F.lag("d").over(W.partitionBy("uid").orderBy("d"))
    days = days.withColumn("back", F.when(F.datediff("d", prev) >= back_days, 1).otherwise(0))
    return tumbling(days, "ts", size, [], [
        F.sum("back").alias("back_ct"),
        F.count("*").alias("uu_ct"),
    ])


query("user_login_window", f"""
WITH l AS (SELECT *, CAST(ts AS DATE) AS d FROM ({APPLOG_SQL})
  WHERE event_type <> 'signup' AND uid IS NOT NULL AND uid <> '' AND (last_page_id IS NULL OR last_page_id = '' OR last_page_id = 'login')),
f AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY uid, d ORDER BY ts, event_id) = 1),
b AS (SELECT *, CASE WHEN date_diff('day', lag(d) OVER (PARTITION BY uid ORDER BY d), d) >= 8 THEN 1 ELSE 0 END AS back FROM f)
SELECT {_sql_window('1 day')}, CAST(sum(back) AS BIGINT) AS back_ct, count(*) AS uu_ct
FROM b GROUP BY ALL
""")(user_login_window)


def cart_add_uu_window(spark: SparkSession, sf_dir: str, size: str = "1 hour") -> DataFrame:
    """Users adding to cart for the first time that day, per window."""
    carts = (logs(spark, sf_dir).filter(F.col("event_type") == "purchase")
             .select("uid", F.to_date("ts").alias("d"), "ts", "event_id"))
    firsts = first_per_key(carts, ["uid", "d"], ["ts", "event_id"])
    return tumbling(firsts, "ts", size, [], [F.count("*").alias("cart_add_uu_ct")])


query("cart_add_uu_window", f"""
WITH l AS (SELECT * FROM ({APPLOG_SQL}) WHERE event_type = 'purchase'),
f AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY uid, CAST(ts AS DATE) ORDER BY ts, event_id) = 1)
SELECT {_sql_window('1 hour')}, count(*) AS cart_add_uu_ct FROM f GROUP BY ALL
""")(cart_add_uu_window)


def sku_order_window(spark: SparkSession, sf_dir: str, size: str = "1 day", burst: str = "1 day") -> DataFrame:
    """Order amounts per sku per window with the sku snowflake names.

    D7 batch form: of the versions of one detail inside one burst interval only
    the latest is kept.  Amounts are summed per (window, sku) first; the part
    dimension (sku name, brand as trademark, type as category) is joined after
    the aggregate, so the join sees one row per sku and window.
    """
    det = t.order_detail(spark, sf_dir).select(
        *t.DETAIL_KEY, *t.DETAIL_ORDER, "sku_id", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_total_amount")
    det = det.withColumn("burst", F.window("l_shipdate", burst).start)
    latest = latest_per_entity(det, [*t.DETAIL_KEY, "burst"], t.DETAIL_ORDER)
    return _sku_amounts(spark, sf_dir, latest, size)


def _sku_amounts(spark: SparkSession, sf_dir: str, latest: DataFrame, size: str) -> DataFrame:
    win = tumbling(latest, "l_shipdate", size, ["sku_id"], [
        F.sum("split_original_amount").cast("decimal(38,4)").alias("original_amount"),
        F.sum("split_activity_amount").cast("decimal(38,4)").alias("activity_reduce_amount"),
        F.sum("split_coupon_amount").cast("decimal(38,4)").alias("coupon_reduce_amount"),
        F.sum("split_total_amount").cast("decimal(38,4)").alias("order_amount"),
    ])
    part = t.read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku_id"), F.col("p_name").alias("sku_name"),
        F.col("p_brand").alias("trademark_name"), F.col("p_type").alias("category3_name"))
    return win.join(part, "sku_id", "left")


query("sku_order_window", f"""
WITH d AS ({LATEST_DETAIL_SQL.replace('PARTITION BY l_orderkey, l_linenumber',
                                      "PARTITION BY l_orderkey, l_linenumber, time_bucket(INTERVAL '1 day', l_shipdate)")}),
w AS (
  SELECT {_sql_window('1 day', 'l_shipdate')}, l_partkey AS sku_id,
    CAST(sum(split_original_amount) AS DECIMAL(38,4)) AS original_amount,
    CAST(sum(split_activity_amount) AS DECIMAL(38,4)) AS activity_reduce_amount,
    CAST(sum(split_coupon_amount) AS DECIMAL(38,4)) AS coupon_reduce_amount,
    CAST(sum(split_total_amount) AS DECIMAL(38,4)) AS order_amount
  FROM d GROUP BY ALL)
SELECT w.*, p.p_name AS sku_name, p.p_brand AS trademark_name, p.p_type AS category3_name
FROM w LEFT JOIN part p ON w.sku_id = p.p_partkey
""")(sku_order_window)


def sku_burst_window(spark: SparkSession, sf_dir: str, size: str = "1 day", burst_days: int = 60) -> DataFrame:
    """``sku_order_window`` with the bursts of the stream form (D7): the first version of a detail opens a burst,
    the newest version in it is kept, and the first one after its end opens the next."""
    det = t.order_detail(spark, sf_dir).select(
        *t.DETAIL_KEY, *t.DETAIL_ORDER, "sku_id", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_total_amount")
    det = with_bursts(det, t.DETAIL_KEY, "l_shipdate", burst_days * 86_400, "burst")
    return _sku_amounts(spark, sf_dir, latest_per_entity(det, [*t.DETAIL_KEY, "burst"], t.DETAIL_ORDER), size)


query("sku_burst_window", f"""
WITH RECURSIVE p AS (SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate AS t FROM lineitem),
s AS (
  SELECT l_orderkey, l_linenumber, min(t) AS t FROM p GROUP BY ALL
  UNION ALL
  SELECT s.l_orderkey, s.l_linenumber, min(p.t) FROM s JOIN p ON s.l_orderkey = p.l_orderkey AND s.l_linenumber = p.l_linenumber
    AND p.t > s.t + INTERVAL 60 DAY GROUP BY ALL),
b AS (SELECT p.l_orderkey, p.l_linenumber, p.t, max(s.t) AS burst FROM p JOIN s ON p.l_orderkey = s.l_orderkey
        AND p.l_linenumber = s.l_linenumber AND s.t <= p.t GROUP BY ALL),
m AS (SELECT lineitem.*, burst FROM lineitem JOIN b ON lineitem.l_orderkey = b.l_orderkey AND lineitem.l_linenumber = b.l_linenumber AND l_shipdate = t),
d AS ({LATEST_DETAIL_SQL.replace('PARTITION BY l_orderkey, l_linenumber', "PARTITION BY l_orderkey, l_linenumber, burst").replace('FROM lineitem', 'FROM m')}),
w AS (
  SELECT {_sql_window("1 day", "l_shipdate")}, l_partkey AS sku_id,
    CAST(sum(split_original_amount) AS DECIMAL(38,4)) AS original_amount,
    CAST(sum(split_activity_amount) AS DECIMAL(38,4)) AS activity_reduce_amount,
    CAST(sum(split_coupon_amount) AS DECIMAL(38,4)) AS coupon_reduce_amount,
    CAST(sum(split_total_amount) AS DECIMAL(38,4)) AS order_amount
  FROM d GROUP BY ALL)
SELECT w.*, p.p_name AS sku_name, p.p_brand AS trademark_name, p.p_type AS category3_name
FROM w LEFT JOIN part p ON w.sku_id = p.p_partkey
""")(sku_burst_window)


WORD_SPLIT = r"[^\p{L}]+"


def search_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_rows(logs(spark, sf_dir)).select("ts", "item")


def keyword_window(spark: SparkSession, sf_dir: str, size: str = "10 minutes") -> DataFrame:
    """Search keywords per window.

    U1 (lateral word split, inner: an entry without words yields no row) is the
    built-in ``split`` on non-letters + ``explode`` over the whole text.
    """
    from strata.operators.keywords import keywords
    words = keywords(search_entries(spark, sf_dir), "item", "keyword")
    return tumbling(words, "ts", size, ["keyword"], [F.count("*").alias("keyword_count")])


query("keyword_window", rf"""
WITH s AS (SELECT ts, item FROM ({APPLOG_SQL})
           WHERE event_type <> 'signup' AND last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL),
w AS (SELECT ts, unnest(regexp_split_to_array(lower(item), '{WORD_SPLIT}')) AS keyword FROM s)
SELECT {_sql_window('10 minutes')}, keyword, count(*) AS keyword_count
FROM w WHERE keyword <> '' GROUP BY ALL
""")(keyword_window)
