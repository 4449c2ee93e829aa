"""User profile: base labels, device/search label, order label, band totals, age label,
the combined profile, and the interval joins that connect label streams (J9-J14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import profile as pf
from strata.operators import labels as lb
from strata.operators.dedupe import latest_per_key
from strata.operators.joins import enrich, interval_join, later_of
from strata.plans import label_values as lv
from strata.plans.dws import latest_details, logs
from strata.plans.registry import query
from strata.sources import tables as t
from strata.sources.applog import PAGE_SQL, page_rows

ASOF = "2025-06-01"
USER_TS0_MS = 1_706_529_600_000
HALF_DAY_MS = 43_200_000
USER_ORDER_BOUND_S = 10 * 86_400   # J12: user label x order label
USER_PAGE_BOUND_S = 86_400         # J13: their join x page label
CHAIN_BOUND_S = 120                # J10/J11


# ---- base user label (X7, P19, P20, F5-F8, J9) ----------------------------------------------

def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as user_info: birthday (epoch day, the CDC form of DATE) and gender derived from
    the key; change time ``USER_TS0_MS`` + key seconds (within the month of the page log)."""
    c = t.read(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("uid"), F.col("c_name").alias("name"),
                    (F.lit(3000) + (F.col("c_custkey") * 37) % 15000).cast("int").alias("birthday_days"),
                    F.when(F.col("c_custkey") % 3 == 0, "M").when(F.col("c_custkey") % 3 == 1, "F").alias("gender"),
                    F.timestamp_millis(F.lit(USER_TS0_MS) + F.col("c_custkey") * 1000).alias("ts"))


def user_sup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_info_sup_msg: height/weight rows written 0-6 s after the user row."""
    c = t.read(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("uid"),
                    (F.lit(150) + F.col("c_custkey") % 40).cast("string").alias("height"),
                    F.lit("cm").alias("unit_height"),
                    (F.lit(45) + F.col("c_custkey") % 50).cast("string").alias("weight"),
                    F.lit("kg").alias("unit_weight"),
                    F.timestamp_millis(F.lit(USER_TS0_MS) + F.col("c_custkey") * 1000
                                       + (F.col("c_custkey") % 7) * 1000).alias("sup_ts"))


def user_base(spark: SparkSession, sf_dir: str, bound_s: int = 5, asof: str = ASOF) -> DataFrame:
    u = user_info(spark, sf_dir)
    b = F.date_from_unix_date("birthday_days")
    u = u.select("uid", "name", F.coalesce("gender", F.lit("home")).alias("gender"), b.alias("birthday"), "ts")
    j = interval_join(u, user_sup(spark, sf_dir), ["uid"], "ts", "sup_ts", -bound_s, bound_s)
    return j.select("uid", "name", "gender", F.col("birthday").cast("string").alias("birthday"),
                    pf.age_years("birthday", asof).alias("age"), pf.decade("birthday").alias("decade"),
                    pf.zodiac("birthday").alias("zodiac_sign"),
                    "height", "unit_height", "weight", "unit_weight",
                    F.unix_millis(later_of("ts", "sup_ts")).alias("ts_ms"))


def user_base_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base labels (X7): gender default 'home', birthday from epoch day, age at the as-of
    date, decade, zodiac; joined to the body supplement within +-5 s (J9)."""
    return user_base(spark, sf_dir)


USER_BASE_SQL = f"""
WITH u AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uid, c_name AS name,
    CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'home' END AS gender,
    DATE '1970-01-01' + CAST(3000 + (c_custkey * 37) % 15000 AS INTEGER) AS b,
    {USER_TS0_MS} + c_custkey * 1000 AS ts_ms
  FROM customer),
s AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uid, CAST(150 + c_custkey % 40 AS VARCHAR) AS height, 'cm' AS unit_height,
    CAST(45 + c_custkey % 50 AS VARCHAR) AS weight, 'kg' AS unit_weight,
    {USER_TS0_MS} + c_custkey * 1000 + (c_custkey % 7) * 1000 AS sup_ts_ms
  FROM customer)
SELECT u.uid, name, gender, CAST(b AS VARCHAR) AS birthday, {pf.age_years_sql('b', ASOF)} AS age,
  CAST(floor(year(b) / 10) * 10 AS INTEGER) AS decade, {pf.zodiac_sql('b')} AS zodiac_sign,
  height, unit_height, weight, unit_weight, greatest(u.ts_ms, s.sup_ts_ms) AS ts_ms
FROM u JOIN s ON u.uid = s.uid AND s.sup_ts_ms BETWEEN u.ts_ms - 5000 AND u.ts_ms + 5000
"""

query("user_base_label", USER_BASE_SQL)(user_base_label)


# ---- page label: device and search (P21, A8 final state, X1, X2, J23) -------------------------

# Fixed values (stand-in config): search word (a category name) -> search theme, the
# composition of the category tree and the category-to-theme dictionary.
SEARCH_THEMES = [("STANDARD", "学习与发展"), ("MEDIUM", "科技与数码"), ("PROMO", "性价比"),
                 ("LARGE", "家庭与育儿"), ("SMALL", "时尚与潮流"), ("ECONOMY", "性价比")]


def _set_text(c: str):
    return F.array_join(F.array_sort(F.collect_set(c)), ",")


def page_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = page_rows(logs(spark, sf_dir)).select(
        F.coalesce("uid", F.lit("-1")).alias("uid"), "ts", F.split("os", " ")[0].alias("os"), "ch", "md", "ba",
        F.col("item").alias("search_item"))
    agg = lg.groupBy("uid").agg(
        F.count("*").alias("pv"), F.unix_millis(F.max("ts")).alias("page_ts_ms"), F.collect_set("os").alias("os_arr"), _set_text("ch").alias("ch"),
        _set_text("md").alias("md"), _set_text("ba").alias("ba"), F.collect_set("search_item").alias("s_arr"))
    judge = (F.when(F.array_contains("os_arr", "iOS"), "iOS").when(F.array_contains("os_arr", "Android"), "Android")
             .otherwise(F.try_element_at(F.array_sort("os_arr"), F.lit(1))))
    agg = agg.select("uid", "pv", "page_ts_ms", F.array_join(F.array_sort("os_arr"), ",").alias("os"), "ch", "md", "ba",
                     F.array_join(F.array_sort("s_arr"), ",").alias("search_item"), judge.alias("judge_os"),
                     F.when(F.size("s_arr") == 1, F.element_at("s_arr", 1)).alias("single_word"))
    themes = t.literal_table(spark, SEARCH_THEMES, "word string, theme string")
    agg = enrich(agg, themes, "single_word", "word", {"theme": "search_theme"}, literal=True)
    agg = lb.apply_scores(agg, "device", "judge_os")
    agg = lb.apply_scores(agg, "search", F.coalesce(F.col("search_theme"), F.lit(lb.OTHER)))
    return agg.select("uid", "pv", "page_ts_ms", "os", "ch", "md", "ba", "search_item", "judge_os",
                      *lb.score_columns("device"), *lb.score_columns("search"))


def device_search_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page label per user (P21, A8 final state, X1, X2): sets of os (first token), channel,
    model, brand and search word; device scores from the judged os (iOS before Android;
    other os: none); search scores from the theme of the single search word (else 0); the
    label's time is that of the user's last page record."""
    return page_label(spark, sf_dir)


def _theme_sql() -> str:
    return "(VALUES " + ", ".join(f"('{w}', '{th}')" for w, th in SEARCH_THEMES) + ") AS th(word, theme)"


def _score_select(family: str) -> str:
    return ", ".join(f"CAST({family}_s.{c} AS DECIMAL(6,3)) AS {c}" for c in lb.score_columns(family))


PAGE_LABEL_SQL = f"""
WITH l AS (SELECT coalesce(uid, '-1') AS uid, ts, split_part(os, ' ', 1) AS os, ch, md, ba, item AS search_item
           FROM ({PAGE_SQL})),
a AS (SELECT uid, count(*) AS pv, epoch_us(max(ts)) // 1000 AS page_ts_ms, list_sort(list_distinct(list(os))) AS os_arr,
        array_to_string(list_sort(list_distinct(list(ch))), ',') AS ch,
        array_to_string(list_sort(list_distinct(list(md))), ',') AS md,
        array_to_string(list_sort(list_distinct(list(ba))), ',') AS ba,
        list_sort(list_distinct(list(search_item))) AS s_arr
      FROM l GROUP BY uid),
b AS (SELECT uid, pv, page_ts_ms, array_to_string(os_arr, ',') AS os, ch, md, ba, array_to_string(s_arr, ',') AS search_item,
        CASE WHEN list_contains(os_arr, 'iOS') THEN 'iOS' WHEN list_contains(os_arr, 'Android') THEN 'Android'
             ELSE os_arr[1] END AS judge_os,
        CASE WHEN len(s_arr) = 1 THEN s_arr[1] END AS single_word FROM a)
SELECT b.uid, b.pv, b.page_ts_ms, b.os, b.ch, b.md, b.ba, b.search_item, b.judge_os,
  {_score_select('device')}, {_score_select('search')}
FROM b LEFT JOIN {_theme_sql()} ON b.single_word = th.word
LEFT JOIN {lv.scores_sql('device')} ON b.judge_os = device_s.k
LEFT JOIN {lv.scores_sql('search')} ON {lv.key_sql('search', "coalesce(th.theme, '*')")} = search_s.k
"""

query("device_search_label", PAGE_LABEL_SQL)(device_search_label)


# ---- order label (P17, P18, J10 batch form, X3-X6, F9, F10) ------------------------------------

# Fixed values (stand-in config): brands and top categories dealt over the parts by key.
BRANDS = ["TCL", "苹果", "联想", "小米", "欧莱雅", "香奈儿", ""]
CATEGORIES = ["数码", "手机", "电脑办公", "个护化妆", "服饰内衣", "家居家装", "图书、音像、电子书刊", "厨具", "鞋靴",
              "母婴", "汽车用品", "珠宝", "家用电器"]


def sku_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as sku_info: prices spread over the three tiers, brands and categories over the
    listed values, the empty brand and values that are not listed (p_brand, p_type)."""
    key = F.col("p_partkey")

    def dealt(values, other):
        arr = F.array(*[F.lit(v) for v in values])
        return F.coalesce(F.get(arr, (key % (len(values) + 1)).cast("int")), F.col(other))
    return t.read(spark, sf_dir, "part").select(
        key.alias("sku_id"), dealt(BRANDS, "p_brand").alias("tm_name"), dealt(CATEGORIES, "p_type").alias("category_name"),
        (F.col("p_retailprice").cast("decimal(16,2)") * (key % 6 + 1)).alias("price"))


SKU_INFO_SQL = f"""
SELECT p_partkey AS sku_id, coalesce({BRANDS}[p_partkey % {len(BRANDS) + 1} + 1], p_brand) AS tm_name,
  coalesce({CATEGORIES}[p_partkey % {len(CATEGORIES) + 1} + 1], p_type) AS category_name,
  CAST(p_retailprice AS DECIMAL(16,2)) * (p_partkey % 6 + 1) AS price
FROM part
"""


def order_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order label per user from the user's latest order detail (labels are upserted by
    user): pay-time slot, price tier of the sku price, brand, top category, each scored.
    The latest detail per user is a combining aggregate; the sku dimension is joined
    to one row per user.  Stand-in: orders are paid at the hour key mod 24, and the label's
    time lies up to 12 days around the users' change times."""
    det = latest_details(spark, sf_dir, ["sku_id"]).select("l_orderkey", "l_linenumber", "sku_id")
    o = t.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    per_user = latest_per_key(det.join(o, "l_orderkey").select("o_custkey", "o_orderdate", "l_orderkey",
                                                               "l_linenumber", "sku_id"),
                              ["o_custkey"], ["o_orderdate", "l_orderkey", "l_linenumber"])
    paid = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    x = per_user.join(sku_info(spark, sf_dir), "sku_id", "left").select(
        F.col("o_custkey").cast("string").alias("user_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        (F.lit(USER_TS0_MS) + (F.col("l_orderkey") % 48 - 24) * HALF_DAY_MS).alias("order_ts_ms"),
        pf.day_slot(paid).alias("pay_time_slot"), pf.price_tier("price").alias("amount_tier"), "tm_name", "category_name")
    x = lb.apply_scores(x, "pay_time", "pay_time_slot")
    x = lb.apply_scores(x, "amount", "amount_tier")
    x = lb.apply_scores(x, "tm", F.when(F.col("tm_name") != "", F.col("tm_name")))
    x = lb.apply_scores(x, "b1name", "category_name")
    return x.select("user_id", "order_date", "order_ts_ms", "pay_time_slot", "amount_tier", "tm_name", "category_name",
                    *[c for f in ("pay_time", "amount", "tm", "b1name") for c in lb.score_columns(f)])


ORDER_LABEL_SQL = f"""
WITH d AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey, o.o_orderdate FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  QUALIFY row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
    l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1),
u AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC) = 1),
x AS (SELECT CAST(u.o_custkey AS VARCHAR) AS user_id, strftime(u.o_orderdate, '%Y-%m-%d') AS order_date,
        {USER_TS0_MS} + (u.l_orderkey % 48 - 24) * {HALF_DAY_MS} AS order_ts_ms,
        CASE WHEN l_orderkey % 24 < 6 THEN '凌晨' WHEN l_orderkey % 24 < 9 THEN '早晨' WHEN l_orderkey % 24 < 12 THEN '上午'
             WHEN l_orderkey % 24 < 14 THEN '中午' WHEN l_orderkey % 24 < 18 THEN '下午' WHEN l_orderkey % 24 < 22 THEN '晚上'
             ELSE '夜间' END AS pay_time_slot,
        CASE WHEN p.price < 1000 THEN '低价商品' WHEN p.price < 4000 THEN '中价商品' ELSE '高价商品' END AS amount_tier,
        p.tm_name, p.category_name
      FROM u LEFT JOIN ({SKU_INFO_SQL}) p ON u.l_partkey = p.sku_id)
SELECT x.*, {_score_select('pay_time')}, {_score_select('amount')},
  {_score_select('tm')}, {_score_select('b1name')}
FROM x LEFT JOIN {lv.scores_sql('pay_time')} ON x.pay_time_slot = pay_time_s.k
LEFT JOIN {lv.scores_sql('amount')} ON x.amount_tier = amount_s.k
LEFT JOIN {lv.scores_sql('tm')} ON {lv.key_sql('tm', "CASE WHEN x.tm_name <> '' THEN x.tm_name END")} = tm_s.k
LEFT JOIN {lv.scores_sql('b1name')} ON {lv.key_sql('b1name', 'x.category_name')} = b1name_s.k
"""

query("order_label", ORDER_LABEL_SQL)(order_label)


# ---- combined: band totals (X8), age label (X9), profile (X10, X11, J12, J13) --------------------

FAMILIES = ["device", "search", "pay_time", "amount", "tm", "b1name"]


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User label x order label within +-10 days (J12), the later time of the two x page label
    within +-24 hours (J13).  A label table holds one row per user, so the bound is a filter on
    the user join; the stream form is ``streaming.facts.profile_stream``."""
    base, ol, pl = user_base(spark, sf_dir), order_label(spark, sf_dir), page_label(spark, sf_dir)
    j = base.join(ol, (base.uid == ol.user_id) & (F.abs(ol.order_ts_ms - base.ts_ms) <= USER_ORDER_BOUND_S * 1000))
    j = j.withColumn("label_ts_ms", F.greatest("ts_ms", "order_ts_ms")).drop("user_id")
    pl = pl.withColumnRenamed("uid", "__uid")
    j = j.join(pl, (j.uid == pl["__uid"]) & (F.abs(pl.page_ts_ms - j.label_ts_ms) <= USER_PAGE_BOUND_S * 1000)).drop("__uid")
    return lb.band_totals(j.withColumn("label_ts_ms", F.greatest("label_ts_ms", "page_ts_ms"))
                          .drop("ts_ms", "order_ts_ms", "page_ts_ms"), FAMILIES)


def band_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X8 (intent): per band the sum of all six families after both joins, missing = 0."""
    return combined(spark, sf_dir).select("uid", *[f"total_{b}" for b in lb.BANDS])


COMBINED_SQL = f"""
SELECT ub.* EXCLUDE (ts_ms), ol.* EXCLUDE (user_id, order_ts_ms), pl.* EXCLUDE (uid, page_ts_ms),
  greatest(ub.ts_ms, ol.order_ts_ms, pl.page_ts_ms) AS label_ts_ms,
  {", ".join("CAST(" + " + ".join(f"coalesce({f}_{b}, 0)" for f in FAMILIES) + f" AS DECIMAL(8,3)) AS total_{b}" for b in lb.BANDS)}
FROM ({USER_BASE_SQL}) ub JOIN ({ORDER_LABEL_SQL}) ol ON ub.uid = ol.user_id AND abs(ol.order_ts_ms - ub.ts_ms) <= 864000000
JOIN ({PAGE_LABEL_SQL}) pl ON ub.uid = pl.uid AND abs(pl.page_ts_ms - greatest(ub.ts_ms, ol.order_ts_ms)) <= 86400000
"""

query("band_totals", f"SELECT uid, {', '.join(f'total_{b}' for b in lb.BANDS)} FROM ({COMBINED_SQL})")(band_totals)


def _age_band_sql() -> str:
    totals = [f"total_{b}" for b in lb.BANDS]
    arr = "[" + ", ".join(totals) + "]"
    names = "[" + ", ".join(f"'{n}'" for n in lb.BAND_NAMES) + "]"
    return f"{names}[list_position({arr}, list_max({arr}))]"


def age_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The band with the largest total (first band wins ties)."""
    return combined(spark, sf_dir).select("uid", lb.age_band().alias("age_band"),
                                          F.array_max(F.array(*[f"total_{b}" for b in lb.BANDS])).alias("age_band_score"))


query("age_label", f"""
SELECT uid, {_age_band_sql()} AS age_band, list_max([{', '.join(f'total_{b}' for b in lb.BANDS)}]) AS age_band_score
FROM ({COMBINED_SQL})
""")(age_label)


def profile_document(df: DataFrame, asof: str = ASOF) -> DataFrame:
    """X11: the nested profile: base / log / device / calculate / supplement groups + ds."""
    return df.select(
        "uid",
        F.struct("name", "gender", "birthday", "age", "decade", "zodiac_sign").alias("base"),
        F.struct("pv", "os", "ch", "md", "ba", "search_item").alias("log"),
        F.struct("judge_os", *lb.score_columns("device"), *lb.score_columns("search")).alias("device"),
        F.struct(*[f"total_{b}" for b in lb.BANDS], lb.max_band_map().alias("max_band")).alias("calculate"),
        F.struct("height", "unit_height", "weight", "unit_weight").alias("supplement"),
        F.date_format(F.to_date(F.lit(asof)), "yyyyMMdd").alias("ds"))


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final profile (J12, J13, X10, X11), its groups flattened for the check: every field of
    base, log, device, calculate (the top band of X10: none when no total is above 0) and
    supplement, and ds."""
    doc = profile_document(combined(spark, sf_dir))
    m = F.col("calculate.max_band")
    return doc.select("uid", "base.*", "log.*", "device.*", *[F.col(f"calculate.total_{b}") for b in lb.BANDS],
                      F.try_element_at(F.map_keys(m), F.lit(1)).alias("max_band"),
                      F.try_element_at(F.map_values(m), F.lit(1)).alias("max_band_score"), "supplement.*", "ds")


query("user_profile", f"""
SELECT uid, name, gender, birthday, age, decade, zodiac_sign, pv, os, ch, md, ba, search_item, judge_os,
  {", ".join(lb.score_columns("device") + lb.score_columns("search"))}, {", ".join(f"total_{b}" for b in lb.BANDS)},
  height, unit_height, weight, unit_weight,
  CASE WHEN m > 0 THEN {_age_band_sql()} END AS max_band, CASE WHEN m > 0 THEN m END AS max_band_score,
  '{ASOF.replace('-', '')}' AS ds
FROM (SELECT *, list_max([{', '.join(f'total_{b}' for b in lb.BANDS)}]) AS m FROM ({COMBINED_SQL}))
""")(user_profile)


# ---- interval joins between event streams (J9, J10/J11 chain, J14 prefix) ------------------------

# Join bound of the registered checks (the reference uses seconds to days; the test
# events are sparse, so hours give non-trivial results).
JOIN_BOUND_S = 3 * 3600


def _typed(spark: SparkSession, sf_dir: str, event_type: str, prefix: str) -> DataFrame:
    ev = t.read(spark, sf_dir, "events").filter(F.col("event_type") == event_type)
    return ev.select("user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))


def _ms(c: str):
    return F.unix_millis(F.col(c))


def interval_join_query(spark: SparkSession, sf_dir: str, bound_s: int = JOIN_BOUND_S) -> DataFrame:
    """Clicks x purchases of the same user with the purchase within +-``bound_s`` of the
    click (both bounds inclusive); the result's event time is the later of the two."""
    j = interval_join(_typed(spark, sf_dir, "click", "click"), _typed(spark, sf_dir, "purchase", "purchase"),
                      ["user_id"], "click_ts", "purchase_ts", -bound_s, bound_s)
    return j.select("user_id", "click_id", "purchase_id", _ms("click_ts").alias("click_ts_ms"),
                    _ms("purchase_ts").alias("purchase_ts_ms"),
                    F.unix_millis(later_of("click_ts", "purchase_ts")).alias("event_ts_ms"))


query("interval_join", f"""
SELECT l.user_id, l.event_id AS click_id, r.event_id AS purchase_id, epoch_us(l.ts) // 1000 AS click_ts_ms,
  epoch_us(r.ts) // 1000 AS purchase_ts_ms, epoch_us(greatest(l.ts, r.ts)) // 1000 AS event_ts_ms
FROM events l JOIN events r ON l.user_id = r.user_id
  AND r.ts BETWEEN l.ts - INTERVAL {JOIN_BOUND_S} SECOND AND l.ts + INTERVAL {JOIN_BOUND_S} SECOND
WHERE l.event_type = 'click' AND r.event_type = 'purchase'
""")(interval_join_query)


def interval_join_chain(spark: SparkSession, sf_dir: str, bound_s: int = JOIN_BOUND_S) -> DataFrame:
    """Views x clicks, then x purchases, each within +-``bound_s``; the second join is
    timed by the first join's event time (the later of view and click)."""
    vc = interval_join(_typed(spark, sf_dir, "view", "view"), _typed(spark, sf_dir, "click", "click"),
                       ["user_id"], "view_ts", "click_ts", -bound_s, bound_s)
    vc = vc.withColumn("vc_ts", later_of("view_ts", "click_ts"))
    j = interval_join(vc, _typed(spark, sf_dir, "purchase", "purchase"), ["user_id"], "vc_ts", "purchase_ts",
                      -bound_s, bound_s)
    return j.select("user_id", "view_id", "click_id", "purchase_id",
                    F.unix_millis(later_of("vc_ts", "purchase_ts")).alias("event_ts_ms"))


query("interval_join_chain", f"""
WITH v AS (SELECT * FROM events WHERE event_type = 'view'),
c AS (SELECT * FROM events WHERE event_type = 'click'),
p AS (SELECT * FROM events WHERE event_type = 'purchase'),
vc AS (SELECT v.user_id, v.event_id AS view_id, c.event_id AS click_id, greatest(v.ts, c.ts) AS t1
       FROM v JOIN c ON v.user_id = c.user_id AND c.ts BETWEEN v.ts - INTERVAL {JOIN_BOUND_S} SECOND AND v.ts + INTERVAL {JOIN_BOUND_S} SECOND)
SELECT vc.user_id, view_id, click_id, p.event_id AS purchase_id, epoch_us(greatest(vc.t1, p.ts)) // 1000 AS event_ts_ms
FROM vc JOIN p ON vc.user_id = p.user_id AND p.ts BETWEEN vc.t1 - INTERVAL {JOIN_BOUND_S} SECOND AND vc.t1 + INTERVAL {JOIN_BOUND_S} SECOND
""")(interval_join_chain)


def interval_prefix_join(spark: SparkSession, sf_dir: str, bound_s: int = JOIN_BOUND_S) -> DataFrame:
    """J14 + F21: error reports (the comment side) x purchases (the order side) within
    +-``bound_s``; every right-side field is prefixed ``info_``."""
    ev = t.read(spark, sf_dir, "events")
    left = ev.filter(F.col("event_type") == "error").select(
        "event_id", "user_id", "ts", F.col("value").cast("decimal(16,2)").alias("value"))
    right = ev.filter(F.col("event_type") == "purchase").select(
        F.col("user_id"), *[F.col(c).alias(f"info_{c}") for c in ("event_id", "ts", "props")],
        F.col("value").cast("decimal(16,2)").alias("info_value"))
    j = interval_join(left, right, ["user_id"], "ts", "info_ts", -bound_s, bound_s)
    return j.select("event_id", "user_id", _ms("ts").alias("ts_ms"), "value", "info_event_id",
                    _ms("info_ts").alias("info_ts_ms"), "info_value", "info_props")


query("interval_prefix_join", f"""
SELECT l.event_id, l.user_id, epoch_us(l.ts) // 1000 AS ts_ms, CAST(l.value AS DECIMAL(16,2)) AS value,
  r.event_id AS info_event_id, epoch_us(r.ts) // 1000 AS info_ts_ms, CAST(r.value AS DECIMAL(16,2)) AS info_value,
  r.props AS info_props
FROM events l JOIN events r ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL {JOIN_BOUND_S} SECOND AND l.ts + INTERVAL {JOIN_BOUND_S} SECOND
WHERE l.event_type = 'error' AND r.event_type = 'purchase'
""")(interval_prefix_join)


# ---- order label chain: order x detail x sku x brand within +-2 min (J10, J11) -------------------

CHAIN_TS0_MS = 1_706_500_000_000
CHAIN_SPAN_S = 1000


def label_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Order, detail, sku and brand changes.  Stand-in change times: key mod 1000 seconds after a
    fixed start for orders and skus, the order's time and 30 s a line for details, the time of
    its first sku for a brand."""
    def at(c):
        return F.timestamp_millis(F.lit(CHAIN_TS0_MS) + c * 1000)
    orders = t.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), at(F.col("o_orderkey") % CHAIN_SPAN_S).alias("o_ts"))
    det = latest_details(spark, sf_dir, ["sku_id"]).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), "sku_id",
        at(F.col("l_orderkey") % CHAIN_SPAN_S + F.col("l_linenumber") * 30).alias("d_ts"))
    sku = sku_info(spark, sf_dir).select("sku_id", "tm_name", "category_name", at(F.col("sku_id") % CHAIN_SPAN_S).alias("s_ts"))
    brand = sku.groupBy("tm_name").agg(F.min("sku_id").alias("first_sku")).select(
        "tm_name", "first_sku", at(F.col("first_sku") % CHAIN_SPAN_S).alias("b_ts"))
    return orders, det, sku, brand


def order_label_interval(spark: SparkSession, sf_dir: str, bound_s: int = CHAIN_BOUND_S) -> DataFrame:
    """Order changes x detail changes (order id), x sku changes (sku id), x brand
    changes (brand name), each within +-``bound_s`` of the event time so far, the later of
    the joined times.  Stream form: ``streaming.facts.order_label_stream``."""
    orders, det, sku, brand = label_changes(spark, sf_dir)
    j = interval_join(orders, det, ["order_id"], "o_ts", "d_ts", -bound_s, bound_s).withColumn("t1", later_of("o_ts", "d_ts"))
    j = interval_join(j, sku, ["sku_id"], "t1", "s_ts", -bound_s, bound_s).withColumn("t2", later_of("t1", "s_ts"))
    j = interval_join(j, brand, ["tm_name"], "t2", "b_ts", -bound_s, bound_s)
    return j.select("order_id", "user_id", "line", "sku_id", "tm_name", "category_name", "first_sku",
                    F.unix_millis(later_of("t2", "b_ts")).alias("event_ts_ms"))


query("order_label_interval", f"""
WITH det AS (SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS sku_id, l_orderkey % 1000 + l_linenumber * 30 AS ts
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
    l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1),
sku AS (SELECT sku_id, tm_name, category_name, sku_id % 1000 AS ts FROM ({SKU_INFO_SQL})),
brand AS (SELECT tm_name, min(sku_id) AS first_sku, min(sku_id) % 1000 AS ts FROM sku GROUP BY tm_name),
a AS (SELECT o_orderkey AS order_id, o_custkey AS user_id, line, sku_id, greatest(o_orderkey % 1000, det.ts) AS ts
      FROM orders JOIN det ON o_orderkey = det.order_id AND abs(det.ts - o_orderkey % 1000) <= 120),
b AS (SELECT a.order_id, a.user_id, a.line, a.sku_id, s.tm_name, s.category_name, greatest(a.ts, s.ts) AS ts
      FROM a JOIN sku s ON a.sku_id = s.sku_id AND abs(s.ts - a.ts) <= 120)
SELECT b.order_id, b.user_id, b.line, b.sku_id, b.tm_name, b.category_name, brand.first_sku,
  {CHAIN_TS0_MS} + greatest(b.ts, brand.ts) * 1000 AS event_ts_ms
FROM b JOIN brand ON b.tm_name = brand.tm_name AND abs(brand.ts - b.ts) <= 120
""")(order_label_interval)
