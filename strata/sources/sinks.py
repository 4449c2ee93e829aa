"""Sinks: upsert, day-bucketed files, JSON text, fan-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import normalise_epoch

ERROR_BUCKET = "error_bucket"


def day_bucket(line: str | Column, field: str) -> Column:
    """S16 bucket of a JSON record: ``day=yyyyMMdd`` of its epoch field (seconds or millis).

    Not JSON or a non-numeric field -> 'error_bucket'; a missing field counts as 0
    (-> day=19700101), as the reference's lenient reader does."""
    ln = F.col(line) if isinstance(line, str) else line
    raw = F.get_json_object(ln, f"$.{field}")
    num = raw.try_cast("bigint")
    ms = normalise_epoch(num)
    day = F.concat(F.lit("day="), F.date_format(F.timestamp_millis(ms), "yyyyMMdd"))
    valid_json = F.get_json_object(ln, "$").isNotNull()
    return (F.when(~valid_json, F.lit(ERROR_BUCKET)).when(raw.isNull(), F.lit("day=19700101"))
            .when(num.isNull(), F.lit(ERROR_BUCKET)).otherwise(day))


def write_day_buckets(df: DataFrame, line: str, field: str, path: str, partitioned: bool = True,
                      max_records_per_file: int = 1_000_000) -> None:
    """S16 batch write: text lines under ``path/day=yyyyMMdd`` (or one folder when not partitioned)."""
    w = df.select(F.col(line).alias("value"), day_bucket(line, field).alias("bucket"))
    w = w.withColumn("day", F.regexp_extract("bucket", r"^day=(\d+)$", 1))
    w = w.withColumn("day", F.when(F.col("day") == "", F.lit(ERROR_BUCKET)).otherwise(F.col("day")))
    writer = w.select("value", "day").write.mode("append").option("maxRecordsPerFile", max_records_per_file)
    if partitioned:
        writer.partitionBy("day").text(path)
    else:
        w.select("value").write.mode("append").option("maxRecordsPerFile", max_records_per_file).text(path)


def to_json_lines(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One JSON text per row (the value of a topic record); nulls omitted."""
    cols = list(columns or df.columns)
    return df.select(F.to_json(F.struct(*cols)).alias("value"))
