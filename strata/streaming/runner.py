"""Running transformations as streams.

``run_stream`` is the one job template: source frame -> transform -> sink, with
the checkpoint kept under the cluster's shared ``spark.checkpoint.dir``.  The
message-queue source/sink use Spark's ``kafka`` format when its jar is on the
classpath; the file source with the same contract (one record per line or row,
read from the earliest file, tombstones dropped) stands in for it otherwise.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.session import checkpoint_root


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), "streams", name)


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Value-only topic reader (UTF-8 text), null payloads (tombstones) dropped."""
    df = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
          .option("subscribe", topic).option("startingOffsets", starting).load())
    return df.select(F.col("value").cast("string").alias("value")).filter(F.col("value").isNotNull())


def read_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1/S17 file stand-in: every new file under ``path`` is read once, one record per line.

    The stream checkpoint plays the role of the saved file position of S17."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).filter(F.col("value").isNotNull())


def write_kafka(df: DataFrame, servers: str, topic: str | None, checkpoint: str) -> StreamingQuery:
    """JSON text sink; with ``topic=None`` each row's ``topic`` column chooses it."""
    w = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)
    if topic:
        w = w.option("topic", topic)
    return w.start()


def run_stream(df: DataFrame, sink: str | Callable, name: str, output_mode: str = "append",
               trigger: dict | None = None, fmt: str = "parquet", partition_by: list[str] | None = None,
               options: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """U4: start ``df`` into ``sink`` (a path, or a ``foreachBatch`` function).

    Default trigger ``availableNow``: process what is there, then stop (the file
    stand-in's equivalent of a bounded catch-up); pass ``{"processingTime": "5 seconds"}``
    for a long-running job.  The checkpoint defaults to ``<spark.checkpoint.dir>/streams/<name>``,
    so a restarted job resumes where it stopped."""
    spark = df.sparkSession
    w = (df.writeStream.queryName(name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, name)))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if callable(sink):
        return w.foreachBatch(sink).start()
    w = w.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(sink)


def fan_out(outputs: dict[str, tuple[Callable[[DataFrame], DataFrame], str]], fmt: str = "parquet"):
    """A ``foreachBatch`` function writing several outputs of one micro-batch.

    The batch is persisted once so the parse above it runs once for all outputs; each
    output goes to ``path/epoch=<id>``, overwritten, so a replayed batch leaves the same rows."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            for _, (transform, path) in outputs.items():
                transform(batch).write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/epoch={epoch_id}")
        finally:
            batch.unpersist()
    return write


def day_bucket_stream(lines: DataFrame, line_col: str, field: str, path: str, name: str,
                      roll: str = "10 minutes", max_records_per_file: int = 1_000_000,
                      checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """S16 stream form: text files under ``path/day=yyyyMMdd`` (or ``day=error_bucket``).

    Files roll once per trigger (``roll``, the reference's 10-minute rollover) and at
    ``max_records_per_file`` records (the size bound)."""
    from strata.sources.sinks import ERROR_BUCKET, day_bucket
    b = day_bucket(line_col, field)
    out = lines.select(F.col(line_col).alias("value"),
                       F.when(b == ERROR_BUCKET, F.lit(ERROR_BUCKET)).otherwise(F.regexp_extract(b, r"^day=(\d+)$", 1)).alias("day"))
    return run_stream(out, path, name, fmt="text", partition_by=["day"],
                      trigger=trigger or {"processingTime": roll},
                      options={"maxRecordsPerFile": max_records_per_file}, checkpoint=checkpoint)


def log_split_stream(lines: DataFrame, root: str, name: str, checkpoint: str | None = None,
                     trigger: dict | None = None) -> StreamingQuery:
    """The app-log split job (P1, D1, R1-R6) as one stream: parse, repair ``is_new`` per mid
    (stateful, the record travels through the state step as JSON text), then write the
    dirty / err / start / display / action / page outputs of each micro-batch under
    ``root/<output>`` (fan-out, the batch persisted once).  Records that are not JSON go to
    ``dirty`` as they are; a record without ``ts`` has time 0 (W6)."""
    from strata.operators import logs as lg
    from strata.streaming.stateful import new_visitor_records_stream

    every = lg.parse_logs(lines)
    parsed = lg.clean(every)
    keyed = parsed.select(F.col("common.mid").alias("mid"), F.coalesce("ts", F.lit(0).cast("bigint")).alias("ts_ms"),
                          F.col("common.is_new").alias("is_new"), F.to_json("record").alias("line"))
    fixed = new_visitor_records_stream(keyed).withColumn("is_dirty", F.lit(False))
    fixed = fixed.unionByName(lg.dirty(every).withColumn("is_dirty", F.lit(True)), allowMissingColumns=True)
    outputs = {out: ((lambda b, out=out: lg.split_logs(repaired_records(b.filter(~F.col("is_dirty"))))[out]
                      .select(F.to_json("record").alias("value"))), f"{root}/{out}")
               for out in ("err", "start", "display", "action", "page")}
    outputs["dirty"] = (lambda b: b.filter("is_dirty").select(F.col("line").alias("value")), f"{root}/dirty")
    return run_stream(fixed, fan_out(outputs), name, checkpoint=checkpoint, trigger=trigger)


def repaired_records(batch: DataFrame) -> DataFrame:
    """Records (line, is_new_fixed) back to log rows, whole, with the repaired ``common.is_new``."""
    from strata.operators import logs as lg
    rec = batch.select(F.inline(F.array(F.struct(lg.record_of("line").alias("r"), F.col("is_new_fixed")))))
    fixed = F.when(F.col("is_new_fixed").isNotNull(), lg.with_is_new(F.col("r"), F.col("is_new_fixed"))).otherwise(F.col("r"))
    return lg.clean(lg.parse_logs(rec.select(F.to_json(fixed).alias("value"))))
