"""Relational sources and sinks over JDBC (S3 snapshot side, S8, S13).

No JDBC driver ships with this repository; these functions run wherever the
cluster provides one (``spark.jars``).  Reads are split into parallel ranges
when a numeric partition column is given, so a large snapshot is not pulled
through one connection.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_camel(name: str) -> str:
    """underscore_name -> underscoreName (the optional column naming of S13)."""
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def read_query(spark: SparkSession, url: str, query: str, props: dict | None = None, camel: bool = False,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int = 64) -> DataFrame:
    """A SQL query to rows (aliases in the query name the columns)."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions))
    else:
        r = r.option("query", query)
    df = r.load()
    return rename_camel(df) if camel else df


def rename_camel(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: to_camel(c) for c in df.columns if "_" in c})


def snapshot(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """S3 snapshot phase: the current rows of a table as 'r' change records."""
    if not re.fullmatch(r"[A-Za-z0-9_.]+", table):
        raise ValueError(f"bad table name {table!r}")
    df = read_query(spark, url, f"SELECT * FROM {table}", **kw)
    after = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))])
    return df.select(F.lit("r").alias("op"), F.lit(None).cast("map<string,string>").alias("before"),
                     after.alias("after"), F.lit(table).alias("table_name"))


def jdbc_sink(url: str, table: str, props: dict | None = None, batch_size: int = 10_000):
    """S8 ``foreachBatch`` function: append each micro-batch to a table (at-least-once, like the
    reference's stream load without two-phase commit; make the target keyed to absorb replays)."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        w = batch.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
        for k, v in (props or {}).items():
            w = w.option(k, v)
        w.mode("append").save()
    return write
