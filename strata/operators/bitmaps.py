"""Exact distinct counts that merge (A2, A4, A5): bitmaps of ids, stored by the finest window.

An id is a bit: its bucket of 32,768 ids and its place there.  A window keeps one bitmap per bucket, so
the distinct count of any coarser window is the bit count of the united bitmaps, without the rows.  Both
steps are combining aggregates, and a bitmap has a fixed size whatever the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, dims: Sequence[str], value: str) -> DataFrame:
    """``(dims, bucket, bits)``: the integer ids ``value`` of each group (null ids count for nothing)."""
    return df.where(F.col(value).isNotNull()).groupBy(*dims, F.bitmap_bucket_number(value).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))


def united(bitmaps: DataFrame, dims: Sequence[str | Column]) -> DataFrame:
    """Bitmaps of coarser groups from those of finer ones."""
    return bitmaps.groupBy(*dims, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, dims: Sequence[str], out: str) -> DataFrame:
    """The number of distinct ids of each group."""
    return bitmaps.groupBy(*dims).agg(F.sum(F.bitmap_count("bits")).alias(out))
