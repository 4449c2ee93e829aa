"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir
from strata.sources.tables import table_path

# A null id takes part in comparisons as the largest long and is given back as null.
NULL_ID = 2 ** 63 - 1
HOT_SHARE = 1000      # a key with more than one row in so many is hot; there are fewer such keys than this


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def id_key(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("bigint"), F.lit(NULL_ID))


def id_back(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c != NULL_ID, c)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, read again: a lineage cut in columns."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name = "_" + name
    return name


def sized_broadcast(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """Hint a broadcast where the counted ``rows`` prove the side small; else leave the join to Spark."""
    return F.broadcast(df) if rows <= max_rows else df


def join_unique(rows: DataFrame, unique: DataFrame, key: list[str], count: str, total: int) -> DataFrame:
    """``rows`` joined with ``unique``, which has one row per ``key`` and, in the column
    ``count``, the number of ``rows`` of that key; ``total`` is their sum or more.

    Rows of hot keys stay where they are: fewer than HOT_SHARE keys can be hot, so their side is
    broadcast.  The others are shuffled, at most one row in HOT_SHARE for each key."""
    hot = F.col(count) * HOT_SHARE > F.lit(total)
    head, tail = F.broadcast(unique.where(hot).drop(count)), unique.where(~hot).drop(count)
    rest = rows.join(F.broadcast(unique.where(hot).select(*key)), key, "left_anti")
    return rows.join(head, key).unionByName(rest.join(tail, key))
