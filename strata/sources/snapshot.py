"""A table's snapshot joined to its change log (S3): read in chunks of the key, reconciled by log positions.

A chunk of the key range is read while the table changes.  Its *low* mark is the log's position
before the read and its *high* mark the position after it.  What the log says between the marks may or
may not be in the rows read, so the last such change of a key replaces the key's row (a delete removes
it).  Changes up to the low mark are in the rows already; those after the high mark follow as changes.
No lock is held, chunks can be read in any order and again after a failure, and no change is lost or
applied twice.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = "chunk bigint, low bigint, high bigint"


def read_chunks(spark: SparkSession, bounds: Iterable[tuple[int, int, int]], read: Callable[[int, int], DataFrame],
                position: Callable[[], int], folder: str) -> tuple[DataFrame, DataFrame]:
    """Read the chunks ``(chunk, first key, key after the last)`` into ``folder``; returns the rows and their marks.

    ``read`` gives the rows of a key range, ``position`` the log's present position.  A chunk's marks are
    written last, so a restarted run goes on with the chunks that have none."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for chunk, first, end in bounds:
        marks = os.path.join(folder, "marks", f"part={chunk}")
        if fs.exists(fs_path(os.path.join(marks, "_SUCCESS"))):
            continue
        low = position()
        read(first, end).withColumn("chunk", F.lit(chunk).cast("bigint")) \
            .write.mode("overwrite").parquet(os.path.join(folder, "rows", f"part={chunk}"))
        spark.createDataFrame([(chunk, low, position())], MARKS).coalesce(1).write.mode("overwrite").parquet(marks)
    return (spark.read.parquet(os.path.join(folder, "rows")).drop("part"),
            spark.read.schema(f"{MARKS}, part bigint").parquet(os.path.join(folder, "marks")).drop("part"))


def snapshot_then_log(rows: DataFrame, marks: DataFrame, log: DataFrame, key: str, chunk_of: Callable[[Column], Column],
                      columns: Sequence[str]) -> DataFrame:
    """Snapshot ``rows`` (key, columns) and ``log`` (key, pos, op, columns) as one stream of changes.

    ``marks`` has a row per chunk (chunk, low, high); ``chunk_of`` gives a key's chunk.  Output: ``(key,
    pos, op, columns)``, op 'r' at the chunk's high mark for every reconciled row, then each later
    change once, however often the log delivered it.  Applied in the order of ``pos`` they give the table as
    the log leaves it.  Changes of keys in no chunk are later changes.

    The chunk of a key joins by equality; the last change between the marks is a combining aggregate per
    key, and only those rows meet the snapshot."""
    placed = log.select(key, "pos", "op", *columns).withColumn("chunk", chunk_of(F.col(key))).join(marks, "chunk", "left")
    inside = placed.where((F.col("pos") > F.col("low")) & (F.col("pos") <= F.col("high"))) \
        .groupBy(key).agg(F.max_by(F.struct("op", "high", *columns), F.col("pos")).alias("l"))
    read = rows.select(key, F.struct(*columns).alias("s")).withColumn("chunk", chunk_of(F.col(key))).join(marks.drop("low"), "chunk")
    both = read.drop("chunk").join(inside, key, "full_outer").where(F.col("l").isNull() | (F.col("l.op") != "d"))
    changed = F.col("l").isNotNull()
    whole = both.select(key, F.coalesce("l.high", "high").alias("pos"), F.lit("r").alias("op"),
                        *[F.when(changed, F.col(f"l.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in columns])
    later = placed.where(F.col("high").isNull() | (F.col("pos") > F.col("high"))) \
        .groupBy(key, "pos").agg(F.max(F.struct("op", *columns)).alias("l")).select(key, "pos", "l.*")
    return whole.unionByName(later)


def table_after(changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The table that a stream of changes leaves: each key's last row, without deleted keys."""
    last = changes.groupBy(key).agg(F.max_by(F.struct("op", *columns), F.struct("pos", (F.col("op") != "r").alias("n"))).alias("l"))
    return last.where(F.col("l.op") != "d").select(key, *[F.col(f"l.{c}").alias(c) for c in columns])
