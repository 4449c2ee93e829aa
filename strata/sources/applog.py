"""App-log stand-in: the ``events`` table read as the reference's page/start/display logs.

Every log field is a pure function of one event row (no lookups, no ordering),
so the mapping costs one projection.  ``APPLOG_SQL`` is the same mapping for
DuckDB; keep the two in step.

Mapping (FIXTURES.md part C): user_id is both mid and uid; event types stand
for the log kinds: view = page, signup = start/login, purchase = cart add,
click = display, error = error.  The numeric ``k`` of ``props`` drives the
device and page attributes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the stand-in mapping (choice lists indexed by k or user_id).
CHANNELS = ["web", "app", "wechat", "oppo"]
OS_NAMES = ["iOS 13.3.1", "Android 11", "HarmonyOS 2"]
MODELS = ["iPhone 14", "Xiaomi 13", "Huawei P50", "vivo X90"]
BRANDS = ["iPhone", "Xiaomi", "Huawei", "vivo"]
LAST_PAGES = [None, "login", "home", "search", "good_detail"]
# Search words are the category names of ``part.p_type``.
SEARCH_WORDS = ["STANDARD", "MEDIUM", "PROMO", "LARGE", "SMALL", "ECONOMY"]


def _pick(values: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def app_log(ev: DataFrame) -> DataFrame:
    """Flatten events (with ``k``) to log columns: mid, uid, ar, ch, vc, os, md, ba, is_new,
    page_id, last_page_id, item, item_type, during_time, ts, ts_ms, event_id, event_type."""
    k = F.col("k")
    uid = F.col("user_id")
    last_page = _pick(LAST_PAGES, k % 5)
    page_id = (F.when(F.col("event_type") == "view", F.when(k % 2 == 0, "home").otherwise("good_detail"))
               .when(F.col("event_type") == "click", "good_detail")
               .when(F.col("event_type") == "signup", "login")
               .when(F.col("event_type") == "purchase", "cart")
               .otherwise("search"))
    keyword = last_page == "search"
    return ev.select(
        "event_id", "event_type", "ts", "user_id", "value", "k",
        F.concat(F.lit("mid_"), uid.cast("string")).alias("mid"),
        uid.cast("string").alias("uid"),
        F.concat(F.lit("ar"), (uid % 5).cast("string")).alias("ar"),
        _pick(CHANNELS, k % 4).alias("ch"),
        F.concat(F.lit("v2.1."), (uid % 3).cast("string")).alias("vc"),
        _pick(OS_NAMES, (uid + k) % 3).alias("os"),
        _pick(MODELS, k % 4).alias("md"),
        _pick(BRANDS, k % 4).alias("ba"),
        F.when(k < 10, "1").otherwise("0").alias("is_new"),
        page_id.alias("page_id"),
        last_page.alias("last_page_id"),
        F.when(keyword, _pick(SEARCH_WORDS, k % 6)).alias("item"),
        F.when(keyword, "keyword").alias("item_type"),
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
        F.unix_millis(F.col("ts")).alias("ts_ms"),
    )


def page_rows(log: DataFrame) -> DataFrame:
    """Page records are all records that are not start records."""
    return log.filter(F.col("event_type") != "signup")


def login_rows(log: DataFrame) -> DataFrame:
    """Page records with a user whose last page is 'login' or empty."""
    last = F.coalesce(F.col("last_page_id"), F.lit(""))
    return page_rows(log).filter((F.coalesce(F.col("uid"), F.lit("")) != "") & last.isin("", "login"))


def search_rows(log: DataFrame) -> DataFrame:
    """Page records reached from the search page by a keyword."""
    return page_rows(log).filter((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword") & F.col("item").isNotNull())


def _sql_pick(values: list, idx: str) -> str:
    items = ", ".join("NULL" if v is None else "'" + v + "'" for v in values)
    return f"[{items}][({idx}) + 1]"


APPLOG_SQL = f"""
SELECT event_id, event_type, ts, user_id, value, k,
  'mid_' || CAST(user_id AS VARCHAR) AS mid,
  CAST(user_id AS VARCHAR) AS uid,
  'ar' || CAST(user_id % 5 AS VARCHAR) AS ar,
  {_sql_pick(CHANNELS, 'k % 4')} AS ch,
  'v2.1.' || CAST(user_id % 3 AS VARCHAR) AS vc,
  {_sql_pick(OS_NAMES, '(user_id + k) % 3')} AS os,
  {_sql_pick(MODELS, 'k % 4')} AS md,
  {_sql_pick(BRANDS, 'k % 4')} AS ba,
  CASE WHEN k < 10 THEN '1' ELSE '0' END AS is_new,
  CASE event_type WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'home' ELSE 'good_detail' END
                  WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'login'
                  WHEN 'purchase' THEN 'cart' ELSE 'search' END AS page_id,
  {_sql_pick(LAST_PAGES, 'k % 5')} AS last_page_id,
  CASE WHEN k % 5 = 3 THEN {_sql_pick(SEARCH_WORDS, 'k % 6')} END AS item,
  CASE WHEN k % 5 = 3 THEN 'keyword' END AS item_type,
  CAST(round(value * 1000) AS BIGINT) AS during_time,
  epoch_us(ts) // 1000 AS ts_ms
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""

PAGE_SQL = f"SELECT * FROM ({APPLOG_SQL}) WHERE event_type <> 'signup'"


def _elems(n: Column, make) -> Column:
    """Array of ``n`` map elements (empty when n is 0), element i built by ``make(i)``."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), make)).otherwise(
        F.array().cast("array<map<string,string>>"))


def raw_log_lines(ev: DataFrame) -> DataFrame:
    """The app-log topic as JSON text lines (one per event), the input of the log split.

    view/click rows carry a page and displays (k % 4 of them), click rows actions
    (k % 3), error rows an ``err`` object, signup rows are start records (no
    page).  Rows with k = 0 stand for records mangled in transit: their line is
    not JSON.  ``pos_id`` of the page and ``ext`` are fields that no column is made of.
    """
    lg = app_log(ev)
    k = F.col("k")
    common = F.struct(*[F.col(c) for c in ("ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc")],
                      F.concat(F.lit("s_"), F.col("event_id").cast("string")).alias("sid"))
    page = F.struct("page_id", "last_page_id", "item", "item_type", "during_time", (k % 9).alias("pos_id"))
    ext = F.struct(F.lit("wifi").alias("net"), F.array(k, k + 1).alias("trace"))
    is_start = F.col("event_type") == "signup"
    has_disp = F.col("event_type").isin("view", "click")
    displays = _elems(k % 4, lambda i: F.create_map(
        F.lit("display_type"), F.lit("query"),
        F.lit("item"), (F.col("user_id") * 100 + i).cast("string"),
        F.lit("item_type"), F.lit("sku_id"),
        F.lit("pos_id"), i.cast("string")))
    actions = _elems(k % 3, lambda i: F.create_map(
        F.lit("action_id"), F.when(i % 2 == 1, F.lit("favor_add")).otherwise(F.lit("cart_add")),
        F.lit("item"), (k + i).cast("string"),
        F.lit("item_type"), F.lit("sku_id"),
        F.lit("ts"), (F.col("ts_ms") + i).cast("string")))
    rec = F.struct(
        common.alias("common"),
        F.when(~is_start, page).alias("page"),
        F.when(is_start, F.create_map(F.lit("entry"), F.lit("icon"),
                                      F.lit("loading_time"), (k * 10).cast("string"))).alias("start"),
        F.when(F.col("event_type") == "error", F.create_map(
            F.lit("error_code"), k.cast("string"), F.lit("msg"), F.concat(F.lit("err_"), k.cast("string")))).alias("err"),
        F.when(has_disp, displays).alias("displays"),
        F.when(F.col("event_type") == "click", actions).alias("actions"),
        F.col("ts_ms").alias("ts"), ext.alias("ext"))
    line = F.when(k == 0, F.concat(F.col("ts_ms").cast("string"), F.lit(" "), F.col("event_type"))).otherwise(F.to_json(rec))
    return lg.select(line.alias("value"))
