"""De-duplication over batches (D10) with a bucketed Bloom filter as stored state.

A key's hash names its bucket and ``HASHES`` bits there; the filter is one bitmap of 32,768 bits per
bucket, stored as binary and united with each batch's bits.  A key whose bits are not all set is new,
for certain; only the others are compared with the stored keys, so false positives cost a lookup and drop no
row.  State is read by bucket and bits are tested by built-in functions.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 32_768               # of a bucket's bitmap
HASHES = 7
BUCKET_KEYS = 3_000         # keys a bucket should hold: one false positive in about 100


class BloomState:
    """The filter and the keys seen, in ``path``.  ``buckets`` is the number of keys expected / ``BUCKET_KEYS``;
    more keys make more false positives, not wrong results.

    Each batch number has its own bits and keys, made from those of smaller numbers and overwritten when
    the batch is run again, so a replayed batch gives the same rows."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 1024):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._hadoop, self._fs = hadoop, hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _epochs(self, kind: str, before: int) -> list[int]:
        folder = self._hadoop(os.path.join(self.path, kind))
        if not self._fs.exists(folder):
            return []
        found = [int(s.getPath().getName()[6:]) for s in self._fs.listStatus(folder)]
        return sorted(e for e in found if e < before)

    def _at(self, kind: str, epoch: int) -> str:
        return os.path.join(self.path, kind, f"epoch-{epoch}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).alias("bucket")

    def _places(self) -> Column:
        a, b = F.xxhash64(F.lit(1), *self.keys), F.xxhash64(F.lit(2), *self.keys)
        # 31 bits of each, so that no sum overflows
        a, b = F.shiftrightunsigned(a, 33), F.shiftrightunsigned(b, 33)
        return F.array(*[F.pmod(a + b * i, F.lit(BITS)) for i in range(HASHES)])

    def bits(self, epoch: int) -> DataFrame:
        """The filter as it is before batch ``epoch``: ``(bucket, bits)``."""
        found = self._epochs("bits", epoch)
        if not found:
            return self.spark.createDataFrame([], "bucket bigint, bits binary")
        return self.spark.read.parquet(self._at("bits", found[-1]))

    def seen(self, epoch: int) -> DataFrame | None:
        """The keys of the batches before ``epoch``."""
        found = self._epochs("keys", epoch)
        return self.spark.read.parquet(*[self._at("keys", e) for e in found]) if found else None

    def _may_be_seen(self, rows: DataFrame, epoch: int) -> DataFrame:
        byte = lambda p: F.conv(F.hex(F.substring(F.col("bits"), (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        held = F.forall(F.col("_places"), lambda p: F.getbit(byte(p), (p % 8).cast("int")) == 1)
        joined = rows.withColumn("_places", self._places()).withColumn("bucket", self._bucket()).join(self.bits(epoch), "bucket", "left")
        return joined.withColumn("_maybe", F.coalesce(F.col("bits").isNotNull() & held, F.lit(False))).drop("bits", "_places", "bucket")

    def new_rows(self, batch: DataFrame, epoch: int, order: Sequence[str]) -> DataFrame:
        """The batch's first row (by ``order``) of every key that no earlier batch held; the state is advanced.

        Keys may not be null.  The result is a stored table, so reading it again does no work again."""
        rest = [c for c in batch.columns if c not in self.keys]
        by = [*order, *[c for c in rest if c not in order]]
        first = batch.groupBy(*self.keys).agg(F.min(F.struct(*by)).alias("_f")).select(*self.keys, *[F.col(f"_f.{c}").alias(c) for c in rest])
        marked = self._may_be_seen(first, epoch)
        seen = self.seen(epoch)
        if seen is not None:
            old = marked.where("_maybe").join(seen, self.keys, "left_anti")      # exact, on positives alone
            marked = marked.where("not _maybe").unionByName(old)
        marked.drop("_maybe").select(*batch.columns).write.mode("overwrite").parquet(self._at("new", epoch))
        new = self.spark.read.parquet(self._at("new", epoch))
        new.select(*self.keys).write.mode("overwrite").parquet(self._at("keys", epoch))
        own = new.select(self._bucket(), F.explode(self._places()).alias("p")).groupBy("bucket").agg(F.bitmap_construct_agg("p").alias("bits"))
        self.bits(epoch).unionByName(own).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")) \
            .write.mode("overwrite").parquet(self._at("bits", epoch))
        return new.select(*batch.columns)
