"""Bursts opened by the first arrival (D7) in batch form: greedy intervals, by pointer doubling where keys are long.

A key's first row opens a burst; the first row later than the burst's end opens the next one, and so
on.  Each start depends on the one before, but where a burst opened at a row would end does not:
``next`` points from every row's time to the first later than its end.  Starts are what the pointers
reach from a key's first row, and composing the pointers with themselves doubles the reach, so the
starts of n bursts are marked in log2(n) rounds of joins on (key, time), which is unique: no key is
walked by one task.

Keys of at most SHORT rows need none of this: a row finds its start by walking the key's times, at most
SHORT of them, after one shuffle by the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.scan import asof_last
from strata.session import ensure_checkpoint_dir


SHORT = 64      # rows of a key that are walked at once; longer keys go by pointer doubling
HOT_KEYS = 1 << 17      # so many long keys are broadcast, so that none of their rows are shuffled to be told apart
T, NEXT = "__b_t", "__b_next"       # a time and the one it points to, in microseconds


def _next_start(points: DataFrame, key: list[str], length_us: int, chunk_us: int) -> DataFrame:
    """``(key, T, NEXT)``: of every time the key's first one after ``T + length_us``, where there is one.

    Ends and times in one falling order: the last time before an end in it is the next one after it."""
    none = F.lit(None).cast("bigint")
    ends = points.select(*key, (-F.col(T) - length_us).alias("__b_u"), F.lit(0).alias("__b_kind"), T, none.alias("__b_p"))
    times = points.select(*key, (-F.col(T)).alias("__b_u"), F.lit(1).alias("__b_kind"), none.alias(T), F.col(T).alias("__b_p"))
    filled = asof_last(ends.unionByName(times), key, ["__b_u", "__b_kind"], F.floor(F.col("__b_u") / chunk_us), "__b_p", NEXT)
    return filled.where(F.col(T).isNotNull() & F.col(NEXT).isNotNull()).select(*key, T, NEXT)


def burst_starts(points: DataFrame, key: Sequence[str], length_us: int, chunk_us: int) -> DataFrame:
    """The times of ``points`` (key, T; distinct) that open a burst, as ``(key, T)``."""
    key = list(key)
    ensure_checkpoint_dir(points.sparkSession)
    starts = points.groupBy(*key).agg(F.min(T).alias(T))
    jump = _next_start(points, key, length_us, chunk_us).checkpoint(eager=True)
    while not jump.isEmpty():
        reached = starts.join(jump, [*key, T]).select(*key, F.col(NEXT).alias(T))
        starts = starts.unionByName(reached).distinct().checkpoint(eager=True)
        far = jump.select(*key, F.col(T).alias(NEXT), F.col(NEXT).alias("__b_far"))
        jump = jump.join(far, [*key, NEXT]).select(*key, T, F.col("__b_far").alias(NEXT)).checkpoint(eager=True)
    return starts


def with_bursts(df: DataFrame, key: Sequence[str], ts: str | Column, length_s: int, out: str = "burst_start") -> DataFrame:
    """Add ``out``, the start of the row's burst.  A burst holds its start and what is at most ``length_s`` later.

    A row with a null key or time has no burst."""
    key = list(key)
    length_us = length_s * 1_000_000
    rows = df.withColumn(T, F.unix_micros(F.col(ts) if isinstance(ts, str) else ts))
    ensure_checkpoint_dir(df.sparkSession)
    long = rows.groupBy(*key).agg(F.count("*").alias("__b_n")).where(F.col("__b_n") > SHORT).checkpoint(eager=True)
    n = long.count()
    if n == 0:
        return _short_keys(rows, df.columns, key, length_us, out)
    long = long.select(*[F.col(k).alias(f"__b_k{i}") for i, k in enumerate(key)])
    long = F.broadcast(long) if n <= HOT_KEYS else long
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__b_k{i}")) for i, k in enumerate(key)])
    return _short_keys(rows.join(long, same, "left_anti"), df.columns, key, length_us, out) \
        .unionByName(_long_keys(rows.join(long, same, "left_semi"), df.columns, key, length_us, out))


def _short_keys(rows: DataFrame, columns: list[str], key: list[str], length_us: int, out: str) -> DataFrame:
    """Keys of few rows, by one window over the key: the greedy walk over its times up to the row's own."""
    known = reduce(and_, [F.col(k).isNotNull() for k in key])
    times = F.array_sort(F.collect_set(F.when(known, F.col(T))).over(Window.partitionBy(*key)))
    walked = F.aggregate("__b_times", F.lit(None).cast("bigint"), lambda start, t: F.when(
        (t <= F.col(T)) & (start.isNull() | (t > start + length_us)), t).otherwise(start))
    return rows.withColumn("__b_times", times).select(*columns, F.timestamp_micros(walked).alias(out))


def _long_keys(rows: DataFrame, columns: list[str], key: list[str], length_us: int, out: str) -> DataFrame:
    chunk_us = max(1, 64 * length_us)
    points = rows.select(*key, T).dropna().distinct()
    starts = burst_starts(points, key, length_us, chunk_us).withColumn("__b_s", F.col(T))
    marked = points.join(starts, [*key, T], "left")
    placed = asof_last(marked, key, [T], F.floor(F.col(T) / chunk_us), "__b_s", "__b_start").select(*key, T, "__b_start")
    return rows.join(placed, [*key, T], "left").select(*columns, F.timestamp_micros("__b_start").alias(out))
