"""Property tests: operators agree with brute force on generated inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.dedupe import latest_per_entity, latest_per_key
from strata.operators.joins import interval_join

BASE = dt.datetime(2024, 1, 1)
rows_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 600)), min_size=0, max_size=40)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(left=rows_st, right=rows_st, lo=st.integers(-120, 0), width=st.integers(0, 240))
def test_interval_join_property(spark, left, right, lo, width):
    hi = lo + width
    l = spark.createDataFrame([(k, i, BASE + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(left)],
                              "k int, lid int, lts timestamp")
    r = spark.createDataFrame([(k, i, BASE + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(right)],
                              "k int, rid int, rts timestamp")
    got = sorted((x.lid, x.rid) for x in interval_join(l, r, ["k"], "lts", "rts", lo, hi).collect())
    want = sorted((i, j) for i, (k1, s1) in enumerate(left) for j, (k2, s2) in enumerate(right)
                  if k1 == k2 and s1 + lo <= s2 <= s1 + hi)
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 5), st.integers(0, 99)),
                     min_size=1, max_size=40))
def test_latest_per_key_property(spark, rows):
    df = spark.createDataFrame(rows, "k int, a int, b int, v int")
    want = {}
    for k, a, b, v in rows:
        if k not in want or (a, b, v) > want[k]:
            want[k] = (a, b, v)
    got1 = {r.k: (r.a, r.b, r.v) for r in latest_per_key(df, ["k"], ["a", "b"]).collect()}
    got2 = {r.k: (r.a, r.b) for r in latest_per_entity(df, ["k"], ["a", "b", "v"], ["k"]).collect()}
    assert got1 == want
    assert got2 == {k: v[:2] for k, v in want.items()}
    assert latest_per_key(df, ["k"], ["a", "b"]).filter(F.col("k").isNull()).count() == 0
