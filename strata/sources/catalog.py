"""Named catalogs and table lifecycle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _check(name: str) -> str:
    for part in name.split("."):
        if not _NAME.fullmatch(part):
            raise ValueError(f"bad identifier {name!r}")
    return name


def ensure_database(spark: SparkSession, db: str) -> None:
    """Create the database if it does not exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_check(db)}")


def save_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Write ``df`` as a catalog table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(_check(name))


def topic_view(spark: SparkSession, lines: DataFrame, schema, name: str, line_col: str = "value") -> DataFrame:
    """A JSON topic (batch or stream) exposed as a SQL view with a declared schema."""
    df = lines.select(F.from_json(F.col(line_col), schema).alias("r")).select("r.*")
    df.createOrReplaceTempView(_check(name))
    return df


def apply_table_lifecycle(spark: SparkSession, config_changes: DataFrame, db: str,
                          columns_field: str = "sink_columns", table_field: str = "sink_table") -> list[str]:
    """DDL from config changes: 'd' drops the sink table, 'r'/'c' create it if absent,
    'u' drops and re-creates it with the new column list.

    Runs on the driver inside ``foreachBatch`` of the config stream; config
    batches are a few rows (one per configured table), never data rows.
    Returns the statements executed."""
    ensure_database(spark, db)
    done = []
    rows = config_changes.select("op", "before", "after").collect()
    for r in rows:
        cfg = r["before"] if r["op"] == "d" else r["after"]
        table = f"{db}.{_check(cfg[table_field])}"
        cols = ", ".join(f"{_check(c.strip())} STRING" for c in cfg[columns_field].split(",") if c.strip())
        stmts = []
        if r["op"] in ("d", "u"):
            stmts.append(f"DROP TABLE IF EXISTS {table}")
        if r["op"] in ("r", "c", "u"):
            stmts.append(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet")
        for s in stmts:
            spark.sql(s)
            done.append(s)
    return done
