"""Age-band scoring (X1-X10): one small score table per family, broadcast-joined.

Each family maps a key (device os, search theme, day slot, price tier, brand,
top category) to six coefficients, one per age band; the score written to a
column is ``round(coefficient * weight, 3)``.  Products of a one-decimal
coefficient and a two-decimal weight are exact in DECIMAL, so the scores are
DECIMAL(6,3) literals.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import literal_broadcast

BANDS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]
BAND_NAMES = ["18-24", "25-29", "30-34", "35-39", "40-49", "50+"]
OTHER = "__other__"

# Family weights and per-key coefficients for the six bands in order
# 18-24, 25-29, 30-34, 35-39, 40-49, 50+.  OTHER is the fallback row of a family;
# a family without OTHER writes no score for an unknown key.
WEIGHTS = {"device": "0.10", "search": "0.15", "pay_time": "0.10", "amount": "0.15", "tm": "0.20", "b1name": "0.30"}
COEFFICIENTS = {
    "device": {
        "iOS": [.7, .6, .5, .4, .3, .2],
        "Android": [.8, .7, .6, .5, .4, .3],
    },
    "search": {
        "时尚与潮流": [.9, .7, .5, .3, .2, .1],
        "性价比": [.2, .4, .6, .7, .8, .8],
        "健康与养生": [.1, .2, .4, .6, .8, .7],
        "家庭与育儿": [.1, .2, .4, .6, .8, .7],
        "科技与数码": [.8, .6, .4, .3, .2, .1],
        "学习与发展": [.4, .5, .6, .7, .8, .7],
        OTHER: [0, 0, 0, 0, 0, 0],
    },
    "pay_time": {
        "凌晨": [.2, .1, .1, .1, .1, .1],
        "早晨": [.1, .1, .1, .1, .2, .3],
        "上午": [.2, .2, .2, .2, .3, .4],
        "中午": [.4, .4, .4, .4, .4, .3],
        "下午": [.4, .5, .5, .5, .5, .4],
        "晚上": [.8, .7, .6, .5, .4, .3],
        "夜间": [.9, .7, .5, .3, .2, .1],
    },
    "amount": {
        "低价商品": [.8, .6, .4, .3, .2, .1],
        "中价商品": [.2, .4, .6, .7, .8, .7],
        "高价商品": [.1, .2, .3, .4, .5, .6],
    },
    "tm": {
        "TCL": [.2, .3, .4, .5, .6, .7],
        "苹果": [.9, .8, .7, .7, .7, .5],
        "联想": [.9, .8, .7, .7, .7, .5],
        "小米": [.9, .8, .7, .7, .7, .5],
        "欧莱雅": [.5, .6, .8, .8, .9, .2],
        "香奈儿": [.3, .4, .6, .8, .9, .2],
        OTHER: [.1, .2, .3, .4, .5, .6],
    },
    "b1name": {
        "数码": [.9, .8, .6, .4, .2, .1],
        "手机": [.9, .8, .6, .4, .2, .1],
        "电脑办公": [.9, .8, .6, .4, .2, .1],
        "个护化妆": [.9, .8, .6, .4, .2, .1],
        "服饰内衣": [.9, .8, .6, .4, .2, .1],
        "家居家装": [.2, .4, .6, .8, .9, .7],
        "图书、音像、电子书刊": [.2, .4, .6, .8, .9, .7],
        "厨具": [.2, .4, .6, .8, .9, .7],
        "鞋靴": [.2, .4, .6, .8, .9, .7],
        "母婴": [.2, .4, .6, .8, .9, .7],
        "汽车用品": [.2, .4, .6, .8, .9, .7],
        "珠宝": [.2, .4, .6, .8, .9, .7],
        "家用电器": [.2, .4, .6, .8, .9, .7],
        OTHER: [.1, .2, .4, .5, .8, .9],
    },
}

SCORE_TYPE = "decimal(6,3)"


def score(family: str, coef: float) -> Decimal:
    """round(coefficient * weight, 3), half up, computed exactly."""
    return (Decimal(str(coef)) * Decimal(WEIGHTS[family])).quantize(Decimal("0.001"), rounding=ROUND_HALF_UP)


def score_rows(family: str) -> list[tuple]:
    return [(key, *[score(family, c) for c in coefs]) for key, coefs in COEFFICIENTS[family].items()]


_TABLES: dict[tuple, DataFrame] = {}


def score_table(spark: SparkSession, family: str) -> DataFrame:
    """The family's score table (built once per session; it is a constant)."""
    from strata.sources.tables import literal_table, session_key
    k = (session_key(spark), family)
    if k not in _TABLES:
        cols = ", ".join(f"{family}_{b} {SCORE_TYPE}" for b in BANDS)
        _TABLES[k] = literal_table(spark, score_rows(family), f"__key string, {cols}")
    return _TABLES[k]


def score_columns(family: str) -> list[str]:
    return [f"{family}_{b}" for b in BANDS]


def apply_scores(df: DataFrame, family: str, key: Column | str) -> DataFrame:
    """Add the six ``{family}_{band}`` columns for ``key`` (null key: no scores).

    Unknown keys take the family's OTHER row when it has one, else no scores.
    """
    spark = df.sparkSession
    key = F.col(key) if isinstance(key, str) else key
    known = [k for k in COEFFICIENTS[family] if k != OTHER]
    if OTHER in COEFFICIENTS[family]:
        k2 = F.when(key.isNull(), None).when(key.isin(*known), key).otherwise(F.lit(OTHER))
    else:
        k2 = key
    tbl = literal_broadcast(score_table(spark, family))
    return df.withColumn("__key", k2).join(tbl, "__key", "left").drop("__key")


# Literal reference behaviour of X8: mixed key spellings drop the four order families
# from bands 35-39 and 40-49, and device/search are not joined yet in any band.
LITERAL_DROPPED = {"35_39": {"pay_time", "amount", "tm", "b1name"}, "40_49": {"pay_time", "amount", "tm", "b1name"}}
LITERAL_MISSING = {"device", "search"}


def band_totals(df: DataFrame, families: list[str], out_prefix: str = "total", literal: bool = False) -> DataFrame:
    """Per band, the sum of all families' scores, a missing score counting 0 (intent).

    ``literal=True`` reproduces the reference's totals (see LITERAL_DROPPED)."""
    cols = []
    for b in BANDS:
        s = None
        used = [f for f in families
                if not literal or (f not in LITERAL_MISSING and f not in LITERAL_DROPPED.get(b, set()))]
        if not used:
            cols.append(F.lit(0).cast("decimal(8,3)").alias(f"{out_prefix}_{b}"))
            continue
        for f in used:
            c = F.coalesce(F.col(f"{f}_{b}"), F.lit(0).cast(SCORE_TYPE))
            s = c if s is None else s + c
        cols.append(s.cast("decimal(8,3)").alias(f"{out_prefix}_{b}"))
    return df.select("*", *cols)


def age_band(prefix: str = "total") -> Column:
    """The band with the largest total; the first band wins ties."""
    totals = F.array(*[F.col(f"{prefix}_{b}") for b in BANDS])
    names = F.array(*[F.lit(n) for n in BAND_NAMES])
    return F.try_element_at(names, F.array_position(totals, F.array_max(totals)).cast("int"))


def max_band_map(prefix: str = "total") -> Column:
    """{band: score} of the top band, or an empty map when no total is above 0."""
    totals = F.array(*[F.col(f"{prefix}_{b}") for b in BANDS])
    top = F.array_max(totals)
    return F.when(top > 0, F.create_map(age_band(prefix), top)).otherwise(
        F.create_map().cast(f"map<string,decimal(8,3)>"))
