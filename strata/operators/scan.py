"""Per-key running state in batch form (A8, D9) as a two-level scan.

A running value per key over an ordering is a prefix scan.  A plain window
partitioned by the key puts a whole key in one task, which breaks when one key
holds a large share of the rows.  Here the ordering is cut into contiguous
chunks (``chunk`` is a monotone function of the order, e.g. an id range or a
time bucket):

1. per (key, chunk): the chunk's own total (a combining aggregate);
2. per key: exclusive prefix of those totals over chunks (a window over one row
   per chunk, bounded by the number of chunks, not by the rows);
3. per (key, chunk): the running value inside the chunk (a window partitioned
   by key and chunk), combined with the prefix of step 2.

A hot key is spread over as many tasks as it has chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_max_before(df: DataFrame, key: Sequence[str], order: Sequence[str], chunk: Column,
                       value: str, out: str = "prev_max") -> DataFrame:
    """Add ``out`` = max(value) over the key's earlier rows (null for the first row)."""
    key = list(key)
    d = df.withColumn("__chunk", chunk)
    per_chunk = d.groupBy(*key, "__chunk").agg(F.max(value).alias("__cmax"))
    wk = W.partitionBy(*key).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    prefix = per_chunk.select(*key, "__chunk", F.max("__cmax").over(wk).alias("__pmax"))
    wc = W.partitionBy(*key, "__chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inner = d.withColumn("__imax", F.max(value).over(wc))
    res = inner.join(prefix, [*key, "__chunk"], "left")
    return res.withColumn(out, F.greatest("__pmax", "__imax")).drop("__chunk", "__pmax", "__imax")


def running_profile(df: DataFrame, key: Sequence[str], order: Sequence[str], chunk: Column,
                    set_cols: Sequence[str], count_out: str = "pv") -> DataFrame:
    """Running row count and running distinct-value sets per key (current row included).

    Sets are returned as sorted, comma-joined text.  A value is in the set of every row from its first
    one on, so only the first row of each (key, value) is kept, by a combining aggregate, and one row
    per key holds them; a row's sets are those whose first row is not later.  Work grows with the rows,
    not with chunks before them; a key's row is bounded by its distinct values, as each set is.
    """
    key = list(key)
    at = F.struct(*order)
    values = F.inline(F.array(*[F.struct(F.lit(i).alias("__c"), F.col(c).cast("string").alias("__v")) for i, c in enumerate(set_cols)]))
    first = df.select(*key, at.alias("__at"), values).where(F.col("__v").isNotNull()) \
        .groupBy(*key, "__c", "__v").agg(F.min("__at").alias("__f"))
    seen = first.groupBy(*key).agg(*[F.array_sort(F.collect_list(F.when(F.col("__c") == i, F.struct("__v", "__f")))).alias(f"__s_{c}")
                                     for i, c in enumerate(set_cols)])
    d = df.withColumn("__chunk", chunk)
    wk = W.partitionBy(*key).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    before = d.groupBy(*key, "__chunk").agg(F.count("*").alias("__n")) \
        .select(*key, "__chunk", F.coalesce(F.sum("__n").over(wk), F.lit(0)).alias("__pn"))
    inner = d.withColumn("__in", F.row_number().over(W.partitionBy(*key, "__chunk").orderBy(*order)))
    res = inner.join(before, [*key, "__chunk"], "left").join(seen, key, "left")
    outs = [(F.col("__pn") + F.col("__in")).alias(count_out)]
    for c in set_cols:
        held = F.filter(F.col(f"__s_{c}"), lambda x: x["__f"] <= at)
        outs.append(F.coalesce(F.array_join(F.transform(held, lambda x: x["__v"]), ","), F.lit("")).alias(f"{c}_set"))
    return res.select(*df.columns, *outs)


def asof_last(df: DataFrame, key: Sequence[str], order: Sequence[str], chunk: Column, value: str, out: str) -> DataFrame:
    """Add ``out``: the last value of ``value`` that is not null, of the key's rows up to this one in ``order``."""
    key = list(key)
    d = df.withColumn("__chunk", chunk)
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
    per_chunk = d.groupBy(*key, "__chunk").agg(last.alias("__last"))
    wk = W.partitionBy(*key).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = per_chunk.select(*key, "__chunk", F.last("__last", ignorenulls=True).over(wk).alias("__carried"))
    wc = W.partitionBy(*key, "__chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    inner = d.withColumn("__own", F.last(value, ignorenulls=True).over(wc))
    res = inner.join(carried, [*key, "__chunk"], "left")
    return res.select(*df.columns, F.coalesce("__own", "__carried").alias(out))


def seq_and_previous(df: DataFrame, key: Sequence[str], order: Sequence[str], chunk: Column,
                     values: Sequence[str], seq: str = "seq", prefix: str = "prev_") -> DataFrame:
    """Changelog position per key: ``seq`` (1-based rank in ``order``) and, for each of
    ``values``, the previous row's value (null on the key's first row).

    Two-level form of ``row_number`` / ``lag`` over the key: ranks and lags inside each
    (key, chunk), then each chunk's row count and last row, carried to the next chunk
    through a window over the key's chunks (one row per chunk).
    """
    key = list(key)
    d = df.withColumn("__chunk", chunk)
    wc = W.partitionBy(*key, "__chunk").orderBy(*order)
    inner = d.select("*", F.row_number().over(wc).alias("__rn"),
                     F.count("*").over(W.partitionBy(*key, "__chunk")).alias("__n"),
                     *[F.lag(v).over(wc).alias(f"__lag_{v}") for v in values])
    # each chunk's last row, taken from the ranked rows (no second pass over the data)
    per_chunk = inner.filter(F.col("__rn") == F.col("__n")).select(
        *key, "__chunk", "__n", F.struct(*[F.col(v) for v in values]).alias("__last"))
    wk = W.partitionBy(*key).orderBy("__chunk")
    carried = per_chunk.select(
        *key, "__chunk",
        F.coalesce(F.sum("__n").over(wk.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.lag("__last").over(wk).alias("__prev_last"))
    res = inner.join(carried, [*key, "__chunk"], "left")
    first_in_chunk = F.col("__rn") == 1
    outs = [(F.col("__before") + F.col("__rn")).alias(seq)]
    outs += [F.when(first_in_chunk, F.col(f"__prev_last.{v}")).otherwise(F.col(f"__lag_{v}")).alias(prefix + v)
             for v in values]
    return res.select(*df.columns, *outs)
