"""URL filter: a sorted array of 64-bit digests, memory-mapped and probed by binary search.

A rule is (host, path prefix, verdict).  Rules are stored by the XXH64 of host length, host and
path in a sorted array with the full strings behind it.  A url probes every suffix of its host
with every prefix of its path that is as long as some rule's path; a hit counts only if the
stored string is equal, so digest collisions do no harm.

A list of at most MAX_LIST_BYTES is one array that every executor maps.  A longer one is cut by
ranges of the digest into arrays of about that size; the candidates travel to their array.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import free_name, written
from strata.session import ensure_checkpoint_dir

MAX_LIST_BYTES = 64 << 20   # of one array
ASKED_ROWS = 1 << 18        # candidates that about meet in one task with one array of many
SEED = 42                   # the seed of Spark's xxhash64
RULES = "host string, path string, verdict string"
JUDGED = "rule string, verdict string"


def host_of(url: str) -> Column:
    """What follows the first ``://`` up to ``/ ? #`` or the end, A-Z lowered; else empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), upper, upper.lower())


def path_of(url: str) -> Column:
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: str) -> Column:
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")), F.lit(""))


# ---- the array ----------------------------------------------------------------------------

def entry(host: str, path: str) -> bytes:
    """The stored string; the length tells where the host ends, so no two rules share one."""
    return f"{len(host)}:{host}{path}".encode()


def entry_column(host: str = "host", path: str = "path") -> Column:
    return F.concat(F.length(host).cast("string"), F.lit(":"), F.col(host), F.col(path))


def digest(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text, SEED)


def pack_array(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """Layout: count, sorted digests, ends of the strings, verdict numbers, the strings, the verdicts.
    Of one rule with several verdicts the largest (``block`` before ``allow``) counts."""
    said: dict[bytes, str] = {}
    for h, p, v in rules:
        k = entry(h, p)
        said[k] = max(said.get(k, v), v)
    rows = sorted((digest(k), k, v) for k, v in said.items())
    names = sorted({r[2] for r in rows})
    keys = np.array([r[0] for r in rows], np.uint64)
    ends = np.cumsum([0, *(len(r[1]) for r in rows)]).astype(np.int64)
    meta = np.searchsorted(np.array(names, object), np.array([r[2] for r in rows], object)).astype(np.int64) if rows else np.zeros(0, np.int64)
    return struct.pack("<q", len(rows)) + keys.tobytes() + ends.tobytes() + meta.tobytes() + b"".join(r[1] for r in rows) \
        + json.dumps(names).encode()


class DigestArray:
    """The packed array, mapped from a file or held in memory."""

    def __init__(self, source: str | bytes):
        raw = np.memmap(source, np.uint8, "r") if isinstance(source, str) else np.frombuffer(source, np.uint8)
        self.n = n = int(raw[:8].view(np.int64)[0])
        self.keys = raw[8:8 + 8 * n].view(np.uint64)
        self.ends = raw[8 + 8 * n:16 + 16 * n].view(np.int64)
        self.meta = raw[16 + 16 * n:16 + 24 * n].view(np.int64)
        at = 16 + 24 * n
        self.text = raw[at:at + int(self.ends[n])]
        self.verdicts = json.loads(raw[at + int(self.ends[n]):].tobytes())

    def find(self, texts: list[bytes]) -> np.ndarray:
        """Place of each text in the array, -1 where it is not in it."""
        out = np.full(len(texts), -1, np.int64)
        if not self.n or not texts:
            return out
        want = np.array([digest(t) for t in texts], np.uint64)
        at = np.searchsorted(self.keys, want)
        hit = np.flatnonzero((at < self.n) & (self.keys[np.minimum(at, self.n - 1)] == want))
        for i in hit:
            j = int(at[i])
            while j < self.n and self.keys[j] == want[i]:
                if self.text[self.ends[j]:self.ends[j + 1]].tobytes() == texts[i]:
                    out[i] = j
                    break
                j += 1
        return out


def candidates(host: str, path: str, lengths: list[int]) -> list[tuple[str, str]]:
    """All (host suffix, path prefix) that a rule could be."""
    tails, at = [host], host.find(".")
    while at >= 0:
        tails.append(host[at + 1:])
        at = host.find(".", at + 1)
    heads = [path[:n] for n in lengths if n <= len(path)]
    return [(t, p) for t in tails for p in heads]


def publish(spark: SparkSession, payload: bytes) -> str:
    """Write ``payload`` into the shared folder and have Spark hand it to every executor; its file name."""
    name = f"digests-{uuid.uuid4().hex}.bin"
    folder = ensure_checkpoint_dir(spark)
    jvm, path = spark._jvm, f"{folder.rstrip('/')}/{name}"
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(payload))
    finally:
        stream.close()
    spark.sparkContext.addFile(path if "://" in path else f"file://{path}")
    return name


# ---- judging ------------------------------------------------------------------------------

def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url",
          max_list_bytes: int = MAX_LIST_BYTES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of the longest rule that fits.

    A rule fits its host and all subdomains if the path starts with the rule's.  Of the rules that
    fit the longest in bytes wins, then the one with the longer host.  A null url, or one without
    ``://``, has empty host and path and gets the ``default`` verdict, as does every url that no
    rule fits; ``rule`` is then null.  Rules with a null in host, path or verdict are ignored; of
    rules with equal host and path the largest verdict counts.  ``max_list_bytes`` is the size of
    one array and does not change any row.  Columns of ``pages`` with the names of the added ones
    are replaced; other columns may have any name."""
    spark = pages.sparkSession
    base = pages.select(*[F.col(c) for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")],
                        host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    rules = rules.select("host", "path", "verdict").where("host is not null and path is not null and verdict is not null") \
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    size = F.octet_length("host") + F.octet_length("path") + 44     # digest, end, verdict number, host length
    said = rules.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"]
    lengths = sorted(r["n"] for r in rules.select(F.length("path").alias("n")).distinct().toLocalIterator())
    if said > max_list_bytes:
        return _judge_by_ranges(base, rules, lengths, default, -(-said // max(max_list_bytes, 1)))
    name = publish(spark, pack_array((r["host"], r["path"], r["verdict"]) for r in rules.collect()))

    def probe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        array = DigestArray(SparkFiles.get(name))
        for hosts, paths in batches:
            asked = [(i, t, q) for i, (h, p) in enumerate(zip(hosts, paths)) for t, q in candidates(h, p, lengths)]
            best: dict[int, tuple[int, int, int]] = {}
            places = array.find([entry(t, q) for _, t, q in asked])
            for k in np.flatnonzero(places >= 0):
                i, t, q = asked[k]
                host = len(t.encode())
                best[i] = max(best.get(i, (-1, 0, 0)), (host + len(q.encode()), host, k))
            rule, verdict = [None] * len(hosts), [default] * len(hosts)
            for i, (_, _, k) in best.items():
                rule[i] = asked[k][1] + asked[k][2]
                verdict[i] = array.verdicts[array.meta[places[k]]]
            yield pd.DataFrame({"rule": rule, "verdict": verdict})

    judged = free_name(base, "_judged")
    out = base.withColumn(judged, F.pandas_udf(probe, JUDGED)("host", "path"))
    return out.select(*base.columns, F.col(judged)["rule"].alias("rule"), F.col(judged)["verdict"].alias("verdict"))


def _judge_by_ranges(base: DataFrame, rules: DataFrame, lengths: list[int], default: str, arrays: int) -> DataFrame:
    """The list as ``arrays`` digest ranges.  Candidates go to the array of their digest, dealt over
    several tasks by their row where there are many, so a host that many rows share is split."""
    row = free_name(base, "_row")
    rows = written(base.withColumn(row, F.monotonically_increasing_id()), "urls")
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    heads = F.filter(F.transform(F.array(*[F.lit(n) for n in lengths]),
                                 lambda n: F.when(F.length("path") >= n, F.substring(F.col("path"), F.lit(1), n))),
                     lambda h: h.isNotNull())

    def ranged(df: DataFrame) -> DataFrame:
        high = F.shiftrightunsigned(F.xxhash64(entry_column()), 33)      # 31 bits, so the product is a long
        return df.withColumn("at", F.shiftright(high * F.lit(arrays).cast("bigint"), 31))
    asked = rows.select(F.col(row).alias("row"), F.explode(tails).alias("host"), F.col("path")) \
        .select("row", "host", F.explode(heads).alias("path"))
    asked = ranged(asked)
    # One row an array: how many tasks its candidates are dealt over.
    deals = written(asked.groupBy("at").agg(F.ceil(F.count("*") / ASKED_ROWS).alias("deals")), "deals")
    asked = asked.join(F.broadcast(deals.toDF("at", "ways")), "at").select(
        "at", F.pmod(F.xxhash64("row"), F.col("ways")).alias("deal"), "row", "host", "path")
    listed = ranged(rules).join(F.broadcast(deals.toDF("at", "times")), "at").select(
        "at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1)).alias("deal"), "host", "path", "verdict")

    def probe(asks: pa.Table, own: pa.Table) -> pa.Table:
        array = DigestArray(pack_array(zip(*(own.column(c).to_pylist() for c in ("host", "path", "verdict")))))
        hosts, paths = asks.column("host").to_pylist(), asks.column("path").to_pylist()
        places = array.find([entry(t, q) for t, q in zip(hosts, paths)])
        said = pa.array([array.verdicts[array.meta[j]] for j in places[places >= 0]], pa.string())
        return asks.select(["row", "host", "path"]).filter(pa.array(places >= 0)).append_column("verdict", said)

    found = asked.groupBy("at", "deal").cogroup(listed.groupBy("at", "deal")).applyInArrow(
        probe, "row bigint, host string, path string, verdict string")
    best = found.groupBy(F.col("row").alias(row)).agg(F.max_by(
        F.struct(F.concat("host", "path").alias("rule"), "verdict"),
        F.struct((F.octet_length("host") + F.octet_length("path")).alias("n"), F.octet_length("host").alias("h"))).alias("best"))
    best = best.select(row, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    return rows.join(best, row, "left").select(*base.columns, "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
