"""Scalar functions (F-rows) on hand-written rows, edge values included."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from strata.functions import dates as fd
from strata.functions import keys as fk
from strata.functions import profile as pf
from strata.functions import text as ft


def one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_zodiac_edges(spark):
    days = ["2000-12-21", "2000-12-22", "2000-01-19", "2000-01-20", "2000-02-18", "2000-02-19", "2000-03-20",
            "2000-03-21", "2000-06-21", "2000-06-22", "2000-10-23", "2000-10-24", "2000-11-22", "2000-11-23", "2000-02-29"]
    got = one(spark, pf.zodiac(F.to_date("d")), "d string", [(d,) for d in days])
    assert got == ["射手座", "摩羯座", "摩羯座", "水瓶座", "水瓶座", "双鱼座", "双鱼座", "白羊座", "双子座", "巨蟹座",
                   "天秤座", "天蝎座", "天蝎座", "射手座", "双鱼座"]


def test_zodiac_null(spark):
    assert one(spark, pf.zodiac(F.to_date("d")), "d string", [(None,)]) == [None]


def test_day_slot_hours(spark):
    hours = [5, 6, 8, 9, 11, 12, 13, 14, 17, 18, 21, 22]
    rows = [(dt.datetime(2024, 1, 1, h, 30),) for h in hours]
    got = one(spark, pf.day_slot("ts"), "ts timestamp", rows)
    assert got == ["凌晨", "早晨", "早晨", "上午", "上午", "中午", "中午", "下午", "下午", "晚上", "晚上", "夜间"]


def test_price_tier_bounds(spark):
    got = one(spark, pf.price_tier(F.col("x").cast("decimal(16,2)")), "x string",
              [("999.99",), ("1000",), ("3999.99",), ("4000",)])
    assert got == ["低价商品", "中价商品", "中价商品", "高价商品"]


def test_age_and_decade(spark):
    rows = [("2000-06-01",), ("2000-06-02",), ("2000-02-29",), ("1999-12-31",)]
    ages = one(spark, pf.age_years(F.to_date("b"), "2025-06-01"), "b string", rows)
    assert ages == [25, 24, 25, 25]
    assert one(spark, pf.age_years(F.to_date("b"), "2025-02-28"), "b string", [("2000-02-29",)]) == [24]
    assert one(spark, pf.decade(F.to_date("b")), "b string", rows) == [2000, 2000, 2000, 1990]


def test_epoch_day_and_formats(spark):
    got = spark.createDataFrame([(10957, 946684800123)], "d int, ms long").select(
        fd.epoch_day_to_date("d").cast("string"), fd.ms_to_date_text("ms"), fd.ms_to_datetime_text("ms"),
        fd.ms_to_partition(F.col("ms").cast("string"))).first()
    assert tuple(got) == ("2000-01-01", "2000-01-01", "2000-01-01 00:00:00", "20000101")


def test_normalise_epoch(spark):
    got = one(spark, fd.normalise_epoch("x"), "x long", [(1700000000,), (1700000000123,), (0,)])
    assert got == [1700000000000, 1700000000123, 0]


def test_hash_bucket_matches_python(spark):
    keys = ["a", "customer#1", "0x00", "hot"]
    got = one(spark, fk.hash_bucket("k"), "k string", [(k,) for k in keys])
    want = ["%04d" % (int(hashlib.md5(k.encode()).hexdigest()[-3:], 16) % 128) for k in keys]
    assert got == want


def test_row_key(spark):
    r = spark.createDataFrame([("a", 1)], "x string, y int").select(
        fk.row_key(["x", "y"]), fk.row_key(["x", "y"], md5_whole=True), fk.row_key(["x", "y"], md5_items=True)).first()
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert tuple(r) == ("a_1", md5("a_1"), md5("a") + "_" + md5("1"))


def test_list_append(spark):
    got = one(spark, ft.list_append_text("l", F.lit("c")), "l string", [('["a","b"]',), (None,), ("[]",)])
    assert got == ["[a, b, c]", "[c]", "[c]"]


def test_string_helpers(spark):
    r = spark.createDataFrame([("hello world", "  ")], "a string, b string").select(
        ft.capitalize_first("a"), ft.lower_first(F.lit("ABC")), ft.is_blank("b"), ft.is_blank(F.lit(None)),
        ft.allowed_chars(F.lit("ab#1")), ft.allowed_chars(F.lit("a b")), ft.first_token("a"), ft.last_token("a", " ")).first()
    assert tuple(r) == ("Hello world", "aBC", True, True, True, False, "hello", "world")


def test_map_merge_and_prefix(spark):
    df = spark.sql("SELECT map('a', '1', 'b', '2') l, map('b', '3', 'c', CAST(NULL AS STRING)) r, CAST(NULL AS map<string,string>) n")
    got = df.select(ft.merged("l", "r").alias("m"), ft.merged("n", "l").alias("n"), ft.prefixed("l", "info_").alias("p")).first()
    assert got.m == {"a": "1", "b": "3", "c": None}
    assert got.n == {"a": "1", "b": "2"}
    assert got.p == {"info_a": "1", "info_b": "2"}


def test_date_text_and_day_number(spark):
    got = spark.range(1).select(fd.text_to_ms(F.lit("2024-01-02 03:04:05")).alias("ms"), fd.today_int("2024-01-02").alias("d")).first()
    assert (got.ms, got.d) == (1704164645000, 20240102)
