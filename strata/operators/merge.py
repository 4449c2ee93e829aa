"""Keyed merges: upsert (S7), dimension put/delete (S9), dimension without deletes.

Batch form of a keyed sink: the changes of a key are folded with a combining
aggregate, then applied to the current table with one anti-join (untouched
rows) and one left join (changed rows); no key group is gathered in a task.
The stream form runs the same function inside ``foreachBatch`` and writes the
result as the next table version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_dimension(current: DataFrame, changes: DataFrame, key: str, columns: Sequence[str],
                    ignore_deletes: bool = False, null_text: bool = False) -> DataFrame:
    """Apply all ``changes`` (key, op, ts_ms, one column per value) to ``current`` (key + columns).

    S9: a put skips empty values, op 'd' removes the row.  Every change of a key counts: a
    column is its latest non-empty value after the key's last delete; where there is none, the
    old cell if the key was never deleted, else null.  At one time a delete comes before a
    put, and of two puts the larger value wins.
    S10 (``ignore_deletes=True, null_text=True``): deletes are ignored, every
    column is written, and a null is written as the text 'null'.
    """
    ch = changes if not ignore_deletes else changes.filter(F.col("op") != "d")
    put = F.col("op") != "d"
    aggs = [F.max(F.when(~put, F.col("ts_ms"))).alias("del_ts"), F.max(F.when(put, F.col("ts_ms"))).alias("put_ts"),
            F.max(F.when(put, F.struct("ts_ms", *columns))).alias("last")]
    for i, c in enumerate(columns):
        aggs.append(F.max(F.when(put & (F.col(c) != ""), F.struct("ts_ms", F.col(c).alias("v")))).alias(f"c{i}"))
    state = ch.groupBy(key).agg(*aggs)
    untouched = current.join(state.select(key), key, "left_anti")
    deleted = F.col("del_ts").isNotNull()
    alive = state.filter(F.col("put_ts").isNotNull() & (~deleted | (F.col("put_ts") >= F.col("del_ts"))))
    alive = alive.join(current, key, "left")
    vals = []
    for i, c in enumerate(columns):
        if null_text:
            v = F.coalesce(F.col("last")[c], F.lit("null"))
        else:
            fresh = F.when(~deleted | (F.col(f"c{i}.ts_ms") >= F.col("del_ts")), F.col(f"c{i}.v"))
            v = F.coalesce(fresh, F.when(~deleted, F.col(c)))
        vals.append(v.alias(c))
    return untouched.select(key, *columns).unionByName(alive.select(key, *vals))


def upsert_latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """S7 batch form: last row per primary key wins."""
    from strata.operators.dedupe import latest_per_key
    return latest_per_key(df, key, order)


def partial_update(df: DataFrame, key: Sequence[str], order: str, columns: Sequence[str],
                   extra: Sequence[F.Column] = ()) -> DataFrame:
    """Per key, each column's latest non-null value by ``order`` (deletes are not applied).

    ``max_by`` ignores rows whose ordering value is null, so the ordering is nulled
    where the column is null."""
    aggs = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return df.groupBy(*key).agg(*aggs, *extra)


def point_read(table: DataFrame, key: str, value) -> DataFrame:
    """S12 ``getRow``: the row with the given key (a pushed-down equality filter)."""
    return table.filter(F.col(key) == F.lit(value))


def bounded_scan(table: DataFrame, key: str, n: int) -> DataFrame:
    """S12 ``getAll(limit)``: the first ``n`` rows by key (the limit is the feature)."""
    return table.orderBy(key).limit(n)


def delete_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """S12 ``deleteByRowkeys``: the table without the given keys."""
    return table.join(keys.select(key).distinct(), key, "left_anti")
