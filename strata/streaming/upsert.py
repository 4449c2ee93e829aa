"""Keyed table sinks for streams (S7, S9, S10): micro-batch merge into a Parquet table.

The table is partitioned by a bucket of the key (or by a given partition column
such as ``ds``).  Each micro-batch: last change per key (combining aggregate),
read only the partitions the batch touches, merge, cut lineage with
``checkpoint()`` (the shared checkpoint folder), and overwrite just those
partitions (dynamic partition overwrite).  Re-running a batch after a failure
rewrites the same partitions with the same content, so the sink is idempotent.
``keyed_table.py`` has the sink that writes its changes alone.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import hash_bucket
from strata.operators.merge import merge_dimension
from strata.session import ensure_checkpoint_dir

BUCKET = "_bucket"


def _table_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a sink table with its declared schema (partition values keep their text type)."""
    return spark.read.schema(schema).parquet(path)


def _overwrite_partitions(df: DataFrame, path: str, part_col: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(path))


def merge_batch(batch: DataFrame, path: str, key: str, columns: Sequence[str], buckets: int = 128,
                ignore_deletes: bool = False, null_text: bool = False) -> None:
    """Apply one batch of changes (key, op, ts_ms, columns) to the dimension table at ``path``."""
    spark = batch.sparkSession
    ensure_checkpoint_dir(spark)
    changes = batch.withColumn(BUCKET, hash_bucket(key, buckets))
    touched = changes.select(BUCKET).distinct()
    schema = ", ".join([f"{key} string"] + [f"{c} string" for c in columns])
    if _table_exists(spark, path):
        current = (read_table(spark, path, f"{schema}, {BUCKET} string")
                   .join(F.broadcast(touched), BUCKET, "left_semi").drop(BUCKET))
    else:
        current = spark.createDataFrame([], schema)
    merged = merge_dimension(current, changes.drop(BUCKET), key, columns, ignore_deletes, null_text)
    merged = merged.withColumn(BUCKET, hash_bucket(key, buckets)).checkpoint(eager=True)
    # Buckets whose rows were all deleted must still be rewritten (emptied).
    _overwrite_partitions(merged, path, BUCKET)
    emptied = touched.join(merged.select(BUCKET).distinct(), BUCKET, "left_anti").collect()
    for r in emptied:  # at most ``buckets`` small names: folder removal, not data
        p = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, f"{BUCKET}={r[BUCKET]}"))
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def dimension_sink(path: str, key: str, columns: Sequence[str], **kw) -> Callable[[DataFrame, int], None]:
    """S9/S10 ``foreachBatch`` function."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        merge_batch(batch, path, key, columns, **kw)
    return write


def upsert_sink(path: str, keys: Sequence[str], order: Sequence[str], part_col: str) -> Callable[[DataFrame, int], None]:
    """S7 ``foreachBatch`` function: last row per primary key wins, by ``order``.

    ``part_col`` (e.g. ``ds``) must be part of the key so a key lives in one partition.  Partial
    updates (S14, A9), where each column has a time of its own, go to ``keyed_table.keyed_sink``."""
    from strata.operators.dedupe import latest_per_key

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        ensure_checkpoint_dir(spark)
        new = latest_per_key(batch, keys, order)
        touched = new.select(part_col).distinct()
        if _table_exists(spark, path):
            cur = (read_table(spark, path, new.schema).join(touched, part_col, "left_semi")
                   .select(*new.columns))
            merged = latest_per_key(cur.unionByName(new), keys, order)
        else:
            merged = new
        _overwrite_partitions(merged.checkpoint(eager=True), path, part_col)
    return write


def dim_build_sink(config_changes: DataFrame, table_root: str, db: str, keep_deletes: bool = True,
                   buckets: int = 128) -> Callable[[DataFrame, int], None]:
    """DIM build (P4, P9, J1, P11, S9) as a ``foreachBatch`` function over change-topic lines.

    Each micro-batch: parse and normalise the envelopes, keep valid changes, read the
    *current* config (latest row per source table, so tables configured later are
    picked up), route and prune columns, then merge each sink table's changes into
    ``table_root/<sink_table>``.  The config has one row per configured table; its rows
    are read on the driver to name the sink tables."""
    from strata.operators import cdc

    def write(batch: DataFrame, epoch_id: int) -> None:
        changes = cdc.normalise(cdc.parse_envelopes(batch))
        valid = cdc.valid_changes(changes, db, keep_deletes=keep_deletes, drop_bootstrap=False)
        cfg = cdc.latest_config(config_changes, ["source_table"])
        # parsed and routed once for all sink tables
        routed = cdc.route_by_config(valid, cfg, [("table_name", "source_table")]).persist()
        for c in cfg.select("config").collect():
            conf = c["config"]
            key = conf["sink_row_key"]
            cols = [x for x in conf["sink_columns"].split(",") if x and x != key]
            row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
            sub = routed.filter(F.col("config")["sink_table"] == conf["sink_table"]).select(
                row[key].alias(key), "op", "ts_ms", *[row[x].alias(x) for x in cols])
            merge_batch(sub, os.path.join(table_root, conf["sink_table"]), key, cols, buckets=buckets)
        routed.unpersist()
    return write
