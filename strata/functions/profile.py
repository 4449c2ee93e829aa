"""User-profile scalar functions (F6-F10) as Column expressions, with SQL twins for the oracle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zodiac signs, first match wins on month*100+day.
# Capricorn spans the year end (12-22 .. 01-19); every other sign ends on the day given.
ZODIAC = [
    ("摩羯座", 119), ("水瓶座", 218), ("双鱼座", 320), ("白羊座", 419), ("金牛座", 520), ("双子座", 621),
    ("巨蟹座", 722), ("狮子座", 822), ("处女座", 922), ("天秤座", 1023), ("天蝎座", 1122), ("射手座", 1221),
]
CAPRICORN_FROM = 1222

# Day slots by hour (upper bounds, exclusive); the rest of the day is 夜间.
DAY_SLOTS = [("凌晨", 6), ("早晨", 9), ("上午", 12), ("中午", 14), ("下午", 18), ("晚上", 22)]
NIGHT = "夜间"

# Price tiers by amount (upper bounds, exclusive).
PRICE_TIERS = [("低价商品", 1000), ("中价商品", 4000)]
TOP_TIER = "高价商品"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def age_years(birthday, asof) -> Column:
    """whole years from ``birthday`` to the as-of date (pass the date in; no clock)."""
    b, a = _c(birthday), F.to_date(F.lit(asof)) if isinstance(asof, str) else _c(asof)
    before = (F.month(a) * 100 + F.dayofmonth(a)) < (F.month(b) * 100 + F.dayofmonth(b))
    return F.year(a) - F.year(b) - F.when(before, 1).otherwise(0)


def decade(birthday) -> Column:
    """year div 10 times 10."""
    return (F.floor(F.year(_c(birthday)) / 10) * 10).cast("int")


def zodiac(birthday) -> Column:
    """F8: zodiac sign of a date."""
    md = F.month(_c(birthday)) * 100 + F.dayofmonth(_c(birthday))
    expr = F.when(md >= CAPRICORN_FROM, F.lit(ZODIAC[0][0]))
    for name, upto in ZODIAC:
        expr = expr.when(md <= upto, F.lit(name))
    return expr


def day_slot(ts) -> Column:
    """slot of the day from the hour."""
    h = F.hour(_c(ts))
    expr = None
    for name, upto in DAY_SLOTS:
        expr = F.when(h < upto, F.lit(name)) if expr is None else expr.when(h < upto, F.lit(name))
    return expr.otherwise(F.lit(NIGHT))


def price_tier(amount) -> Column:
    """price tier of an amount."""
    expr = None
    for name, upto in PRICE_TIERS:
        expr = F.when(_c(amount) < upto, F.lit(name)) if expr is None else expr.when(_c(amount) < upto, F.lit(name))
    return expr.otherwise(F.lit(TOP_TIER))


# ---- SQL twins (DuckDB) ------------------------------------------------------------------------

def age_years_sql(b: str, asof: str) -> str:
    a = f"DATE '{asof}'"
    return (f"CAST(year({a}) - year({b}) - CASE WHEN month({a}) * 100 + day({a}) < month({b}) * 100 + day({b}) "
            f"THEN 1 ELSE 0 END AS INTEGER)")


def zodiac_sql(b: str) -> str:
    md = f"(month({b}) * 100 + day({b}))"
    parts = [f"WHEN {md} >= {CAPRICORN_FROM} THEN '{ZODIAC[0][0]}'"]
    parts += [f"WHEN {md} <= {upto} THEN '{name}'" for name, upto in ZODIAC]
    return "CASE " + " ".join(parts) + " END"


def day_slot_sql(ts: str) -> str:
    return "CASE " + " ".join(f"WHEN hour({ts}) < {u} THEN '{n}'" for n, u in DAY_SLOTS) + f" ELSE '{NIGHT}' END"


def price_tier_sql(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} < {u} THEN '{n}'" for n, u in PRICE_TIERS) + f" ELSE '{TOP_TIER}' END"
