"""Scores of the label queries' SQL (X1-X6), written out: coefficient times weight, to three places.

Kept apart from ``operators/labels.py``, which computes them, so that a wrong coefficient shows.
"""

from __future__ import annotations

from strata.operators.labels import score_columns

# Keys of a family and their scores for 18-24, 25-29, 30-34, 35-39, 40-49, 50+; "*" is any other key.
SCORES = {
    "device": [(["iOS"], "0.070, 0.060, 0.050, 0.040, 0.030, 0.020"),
               (["Android"], "0.080, 0.070, 0.060, 0.050, 0.040, 0.030")],
    "search": [(["时尚与潮流"], "0.135, 0.105, 0.075, 0.045, 0.030, 0.015"),
               (["性价比"], "0.030, 0.060, 0.090, 0.105, 0.120, 0.120"),
               (["健康与养生", "家庭与育儿"], "0.015, 0.030, 0.060, 0.090, 0.120, 0.105"),
               (["科技与数码"], "0.120, 0.090, 0.060, 0.045, 0.030, 0.015"),
               (["学习与发展"], "0.060, 0.075, 0.090, 0.105, 0.120, 0.105"),
               (["*"], "0.000, 0.000, 0.000, 0.000, 0.000, 0.000")],
    "pay_time": [(["凌晨"], "0.020, 0.010, 0.010, 0.010, 0.010, 0.010"),
                 (["早晨"], "0.010, 0.010, 0.010, 0.010, 0.020, 0.030"),
                 (["上午"], "0.020, 0.020, 0.020, 0.020, 0.030, 0.040"),
                 (["中午"], "0.040, 0.040, 0.040, 0.040, 0.040, 0.030"),
                 (["下午"], "0.040, 0.050, 0.050, 0.050, 0.050, 0.040"),
                 (["晚上"], "0.080, 0.070, 0.060, 0.050, 0.040, 0.030"),
                 (["夜间"], "0.090, 0.070, 0.050, 0.030, 0.020, 0.010")],
    "amount": [(["低价商品"], "0.120, 0.090, 0.060, 0.045, 0.030, 0.015"),
               (["中价商品"], "0.030, 0.060, 0.090, 0.105, 0.120, 0.105"),
               (["高价商品"], "0.015, 0.030, 0.045, 0.060, 0.075, 0.090")],
    "tm": [(["TCL"], "0.040, 0.060, 0.080, 0.100, 0.120, 0.140"),
           (["苹果", "联想", "小米"], "0.180, 0.160, 0.140, 0.140, 0.140, 0.100"),
           (["欧莱雅"], "0.100, 0.120, 0.160, 0.160, 0.180, 0.040"),
           (["香奈儿"], "0.060, 0.080, 0.120, 0.160, 0.180, 0.040"),
           (["*"], "0.020, 0.040, 0.060, 0.080, 0.100, 0.120")],
    "b1name": [(["数码", "手机", "电脑办公", "个护化妆", "服饰内衣"], "0.270, 0.240, 0.180, 0.120, 0.060, 0.030"),
               (["家居家装", "图书、音像、电子书刊", "厨具", "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器"],
                "0.060, 0.120, 0.180, 0.240, 0.270, 0.210"),
               (["*"], "0.030, 0.060, 0.120, 0.150, 0.240, 0.270")],
}


def scores_sql(family: str) -> str:
    """The family's scores as a DuckDB VALUES relation named ``{family}_s``."""
    rows = ", ".join(f"('{k}', {vals})" for keys, vals in SCORES[family] for k in keys)
    return f"(VALUES {rows}) AS {family}_s(k, {', '.join(score_columns(family))})"


def key_sql(family: str, expr: str) -> str:
    known = ", ".join(f"'{k}'" for keys, _ in SCORES[family] for k in keys if k != "*")
    return f"CASE WHEN {expr} IN ({known}) THEN {expr} WHEN {expr} IS NOT NULL THEN '*' END"
