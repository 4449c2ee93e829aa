"""Keyed de-duplication and per-key state in batch form.

Skew: a single key may hold a large share of the rows.  The "one row per key"
operators are therefore written as aggregates over a packed struct
(``max(struct(order..., payload...))``): Spark combines them map-side, so a hot
key is reduced inside every input task before the shuffle and no task ever
sees a whole key group.  Window functions are only used where the partition
is a (key, bounded-range) pair, e.g. one calendar day of one user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pack(df: DataFrame, keys: Sequence[str], order: Sequence[str]):
    rest = [c for c in df.columns if c not in keys and c not in order]
    return F.struct(*[F.col(c) for c in list(order) + rest])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order`` (lexicographic); ties fall to the other columns.

    This is the batch form of an upsert sink (S7), of retraction-by-negation
    netted out (D6), and of "keep newest" (A10).
    """
    packed = _pack(df, keys, order)
    out = df.groupBy(*keys).agg(F.max(packed).alias("_r")).select(*keys, "_r.*")
    return out.select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order`` (D2: first cart add per user per day)."""
    packed = _pack(df, keys, order)
    out = df.groupBy(*keys).agg(F.min(packed).alias("_r")).select(*keys, "_r.*")
    return out.select(*df.columns)


def first_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str], row_id: str,
               flag: str = "is_first") -> DataFrame:
    """Emit every row with ``flag`` = 1 on the first row of its key, else 0.

    The first row id per key comes from a combining aggregate; it is joined back
    on the unique row id, so no key group is gathered in one task.
    """
    fields = list(order) + ([row_id] if row_id not in order else [])
    firsts = (df.groupBy(*keys)
              .agg(F.min(F.struct(*[F.col(c) for c in fields])).alias("_f"))
              .select(F.col(f"_f.{row_id}").alias(row_id), F.lit(1).alias(flag)))
    return (df.join(firsts, row_id, "left")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(0))))


def exact_dedupe(df: DataFrame) -> DataFrame:
    """Drop rows that repeat a previous row exactly (all columns)."""
    return df.dropDuplicates()


def latest_per_entity(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                      cluster_by: Sequence[str] | None = None) -> DataFrame:
    """Last row per key as ``row_number() = 1`` over the key.

    Without ``cluster_by`` Spark plans a partial window group limit in every map task
    (only each task's top row per key is shuffled) and a final one after the shuffle,
    so a hot key is reduced map-side like a partial aggregate.  ``cluster_by`` (a key
    prefix) instead hash-partitions on the prefix first, which lets later joins and
    aggregates on the prefix reuse the partitioning but gives up the map-side
    reduction; use it only for keys known not to be hot.
    """
    from pyspark.sql import Window as W
    d = df.repartition(*cluster_by) if cluster_by else df
    w = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return d.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
