"""A keyed table whose sink costs what its changes cost (S7, S9, S14): change files, merged on read.

A batch writes one *run*: its changes folded to one row per key, sorted by key bucket and key.
Every column is a cell ``(t, v)``, its value and the time of the change that carried it, so the
newest cell wins whatever the order in which batches arrive; a delete is a time too, and hides what
is older.  The newest cell is a maximum, so runs merge in any order and any number of times.

A *manifest*, one small file per version, names the runs that make up the table, each with its
level.  Writing adds a run of level 0; compaction, a job of its own, replaces the runs of a level by
one run of the next.  A reader keeps the runs of the manifest it opened: they stay until ``vacuum``.
A batch number that a writer has committed before is skipped, so a replayed batch changes nothing.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import hash_bucket

BUCKET = "_bucket"


class KeyedTable:
    """A table at ``path`` with ``keys`` and ``columns`` (name -> type); ``time_type`` is that of the change time."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], columns: dict[str, str],
                 time_type: str = "bigint", buckets: int = 128, fan_in: int = 4):
        self.spark, self.path, self.keys, self.columns = spark, path.rstrip("/"), keys, columns
        self.buckets, self.fan_in = buckets, fan_in
        cells = [f"`{c}` struct<t: {time_type}, v: {kind}>" for c, kind in columns.items()]
        self.schema = ", ".join([f"{BUCKET} string", *(f"`{k}` {kind}" for k, kind in keys.items()),
                                 f"_put {time_type}", f"_del {time_type}", *cells])
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._path = lambda *names: hadoop(os.path.join(self.path, *names))
        self._fs = hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- manifest ----

    def _versions(self) -> list[int]:
        folder = self._path("_manifest")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted((int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")), reverse=True)

    def _read(self, version: int) -> dict | None:
        """A manifest; None if its writer was lost before it ended."""
        stream = self._fs.open(self._path("_manifest", f"v{version:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text.endswith("}\n") else None

    def manifest(self, version: int | None = None) -> dict:
        """The newest manifest, or that of ``version``: ``runs`` (name, level) and each writer's last batch."""
        for v in self._versions() if version is None else [version]:
            found = self._read(v)
            if found is not None:
                return found
        return {"runs": [], "batches": {}}

    def _commit(self, change: Callable[[dict], dict | None]) -> bool:
        """Write ``change(newest manifest)`` as the next version; again if another writer was faster.

        Creating a file that exists fails, so each version has one writer.  False if ``change`` gives None."""
        while True:
            version = max(self._versions(), default=0) + 1
            new = change(self.manifest())
            if new is None:
                return False
            try:
                out = self._fs.create(self._path("_manifest", f"v{version:012d}.json"), False)
            except Exception:
                if version in self._versions():
                    continue
                raise
            try:
                out.write(bytearray((json.dumps(new) + "\n").encode()))
            finally:
                out.close()
            return True

    # ---- rows ----

    def _folded(self, cells: DataFrame) -> DataFrame:
        """One row per key: the newest cell of every column.  A combining aggregate."""
        return cells.groupBy(BUCKET, *self.keys).agg(
            F.max("_put").alias("_put"), F.max("_del").alias("_del"), *[F.max(c).alias(c) for c in self.columns])

    def cells(self, changes: DataFrame, time: str | Column, op: str | None = None, skip_empty: bool = False) -> DataFrame:
        """Change rows as cells.  A null (with ``skip_empty`` also an empty text) carries nothing; ``op`` 'd' deletes the key."""
        t = F.col(time) if isinstance(time, str) else time
        put = F.coalesce(F.col(op) != "d", F.lit(True)) if op else F.lit(True)
        text = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in self.keys])
        out = []
        for c in self.columns:
            has = put & F.col(c).isNotNull()
            if skip_empty:
                has = has & (F.col(c).cast("string") != "")
            out.append(F.when(has, F.struct(t.alias("t"), F.col(c).alias("v"))).alias(c))
        return changes.select(hash_bucket(text, self.buckets).alias(BUCKET), *self.keys,
                              F.when(put, t).alias("_put"), F.when(~put, t).alias("_del"), *out)

    def _write_run(self, cells: DataFrame) -> str:
        """Folded cells as files sorted by bucket and key; a small batch makes few files (adaptive partitions)."""
        name = f"run-{uuid.uuid4().hex}"
        cells.repartition(BUCKET, *self.keys).sortWithinPartitions(BUCKET, *self.keys) \
            .write.parquet(os.path.join(self.path, name))
        return name

    def write(self, changes: DataFrame, batch_id: int, time: str | Column, op: str | None = None,
              skip_empty: bool = False, writer: str = "main") -> bool:
        """Add a batch of changes; False if this writer has committed the batch (or a later one) before."""
        if batch_id <= self.manifest()["batches"].get(writer, -1):
            return False
        name = self._write_run(self._folded(self.cells(changes, time, op, skip_empty)))

        def add(m: dict) -> dict | None:
            if batch_id <= m["batches"].get(writer, -1):
                return None
            return {"runs": [*m["runs"], {"name": name, "level": 0}], "batches": {**m["batches"], writer: batch_id}}
        return self._commit(add)

    def _runs(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[os.path.join(self.path, n) for n in names])

    def read(self, version: int | None = None, where: Column | None = None) -> DataFrame:
        """The table: of every key that lives, the newest cell of every column, merged over the runs.

        ``where`` may hold conditions on keys; they reach the files, which are sorted by key.  A column
        is null if no change since the key's last delete carried it; at one time a put outlives a delete."""
        cells = self._runs([r["name"] for r in self.manifest(version)["runs"]])
        if where is not None:
            cells = cells.where(where)
        rows = self._folded(cells).where(F.col("_put").isNotNull() & (F.col("_del").isNull() | (F.col("_put") >= F.col("_del"))))
        fresh = lambda c: F.when(F.col("_del").isNull() | (F.col(f"{c}.t") >= F.col("_del")), F.col(f"{c}.v"))
        return rows.select(*self.keys, *[fresh(c).alias(c) for c in self.columns])

    # ---- upkeep ----

    def compact(self, level: int | None = None) -> int:
        """Merge the runs of ``level`` into one of the next; of every level that has ``fan_in`` runs if it is None.

        Returns the number of runs merged.  Runs written meanwhile stay as they are."""
        merged = 0
        at = [level] if level is not None else sorted({r["level"] for r in self.manifest()["runs"]})
        for lv in at:
            old = [r["name"] for r in self.manifest()["runs"] if r["level"] == lv]
            if len(old) < (2 if level is not None else self.fan_in):
                continue
            new = self._write_run(self._folded(self._runs(old)))

            def swap(m: dict) -> dict | None:
                if not set(old) <= {r["name"] for r in m["runs"]}:
                    return None         # another compaction took some of them
                kept = [r for r in m["runs"] if r["name"] not in old]
                return {**m, "runs": [*kept, {"name": new, "level": lv + 1}]}
            if self._commit(swap):
                merged += len(old)
        return merged

    def vacuum(self, keep: int = 10) -> int:
        """Delete manifests but the newest ``keep``, and runs that none of these names.

        Call it when no reader of an older version and no writer is under way; returns the runs deleted."""
        versions = self._versions()
        used = {r["name"] for v in versions[:keep] for r in (self._read(v) or {"runs": []})["runs"]}
        for v in versions[keep:]:
            self._fs.delete(self._path("_manifest", f"v{v:012d}.json"), False)
        gone = [n for n in (s.getPath().getName() for s in self._fs.listStatus(self._path())) if n.startswith("run-") and n not in used]
        for n in gone:
            self._fs.delete(self._path(n), True)
        return len(gone)


def keyed_sink(table: KeyedTable, time: str, op: str | None = None, skip_empty: bool = False, writer: str = "main",
               compact_every: int = 16) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: a batch adds its changes; each ``compact_every`` batches full levels are merged."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        table.write(batch, epoch_id, time, op, skip_empty, writer)
        if compact_every and epoch_id % compact_every == compact_every - 1:
            table.compact()
    return write
