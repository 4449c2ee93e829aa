"""Plan shape of every registered query: no cartesian products or nested-loop joins, no
row-at-a-time Python, pruned Parquet reads, filters pushed to the scan where the query
filters a source column."""

import re

import pytest

import __spark_entry__ as entry
from strata.plans.registry import load_all

NAMES = sorted(load_all())  # the warehouse; tests/llm has the others
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def plan_of(spark, sf_small, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = entry.queries()[name](spark, sf_small)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, sf_small, name):
    plan = plan_of(spark, sf_small, name)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_column_pruning_reaches_scans(spark, sf_small):
    plan = plan_of(spark, sf_small, "province_order_window")
    for table, cols in (("orders", 3), ("customer", 2), ("nation", 2)):
        m = re.search(rf"FileScan parquet \[([^\]]*)\][^\n]*{table}\.parquet", plan)
        assert m and len(m.group(1).split(",")) == cols, (table, m and m.group(1))


def test_filters_pushed_to_scan(spark, sf_small):
    plan = plan_of(spark, sf_small, "cart_add_uu_window")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,purchase\)", plan)
    plan = plan_of(spark, sf_small, "interval_join")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,click\)", plan)


USER_KEYS = {"uid", "user_id", "mid", "o_custkey"}
# windows over a user key alone are allowed only where the rows per user are bounded
# (distinct login days of one user, one row per chunk in the two-level scans)
BOUNDED = {"user_login_window", "monotone_filter", "running_user_profile"}


def window_partitions(plan):
    out = []
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", plan):
        parts = [p.strip() for p in spec.split(",")]
        keys = []
        for p in parts:
            if " ASC" in p or " DESC" in p or p.startswith("specifiedwindowframe"):
                break
            keys.append(re.sub(r"#\d+L?$", "", p))
        out.append(keys)
    return out


@pytest.mark.parametrize("name", NAMES)
def test_no_unbounded_window_over_a_user_key(spark, sf_small, name):
    plan = plan_of(spark, sf_small, name)
    for keys in window_partitions(plan):
        if len(keys) == 1 and keys[0] in USER_KEYS:
            assert name in BOUNDED, f"{name}: window partitioned by {keys} alone"


PARSED_ONCE = ["log_dirty", "log_err", "log_start", "log_display", "log_action", "log_page", "log_records", "cdc_normalise", "cdc_valid",
               "cdc_config_route_dim", "cdc_config_route_dwd"]


@pytest.mark.parametrize("name", PARSED_ONCE)
def test_lines_are_parsed_once(spark, sf_small, name):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = entry.queries()[name](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"from_json\(|parseJson\(|parse_json\(", plan)) == 1
    assert plan.count("get_json_object(") <= 1
