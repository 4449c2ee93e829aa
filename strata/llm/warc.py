"""WARC archives of pages, with a two-level capture index.

Archives are gzip-compressed WARC files, a member (or more, for very long records) for each
record, written and read by Spark's own file sources, so they can lie on any file system that
Spark reaches.  The index sorts reversed-host URL keys into compressed blocks; a directory names
the first key of each block and is itself cut into pages, of which the first keys are the root.
A lookup searches the root, a directory page and a block by bisection, then reads the range.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import id_back, id_key
from strata.session import ensure_checkpoint_dir

MEMBER_BYTES = 8 << 20      # of a record in one gzip member; below 16 MiB its last byte is zero
FILE_RECORDS = 10_000       # records of an archive file at most
BLOCK_KEYS = 512            # captures of an index block
PAGE_BLOCKS = 1024          # blocks of a directory page
ROOT_KEYS = 1 << 16         # pages the root may hold before pages grow
ASK = 4096                  # keys looked up in a block at once
DATE = "2000-01-01T00:00:00Z"


# ---- records ------------------------------------------------------------------------------

def _safe(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def record_bytes(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit without payload if ``refers_to`` is given."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _safe(url)))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def members(record: bytes) -> bytes:
    """The record as gzip members.  The last byte, the top of the member's size, is always zero."""
    out = []
    for at in range(0, len(record), MEMBER_BYTES):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        out.append(z.compress(record[at:at + MEMBER_BYTES]) + z.flush())
    return b"".join(out)


def parse_record(record: bytes) -> dict:
    """Headers (lower-case names) and the payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(out["content-length"])]
    out["payload"] = block.partition(b"\r\n\r\n")[2]
    return out


def _page_of(urn: str) -> int:
    return int(urn[len("<urn:page:"):-1])


def split_members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of every record of an archive file."""
    at, begun, parts, need = 0, 0, [], None
    view = memoryview(content)
    while at < len(view):
        z = zlib.decompressobj(31)
        while not z.eof:      # small bites: what is left over of the last one is copied
            bite = view[at:at + 4096]
            if not bite:
                raise ValueError("the archive ends within a record")
            parts.append(z.decompress(bite))
            at += len(bite)
        at -= len(z.unused_data)
        if need is None:
            parts = [b"".join(parts)]
            head = parts[0].partition(b"\r\n\r\n")[0]
            need = len(head) + 4 + int(re.search(rb"\r\nContent-Length: (\d+)", head).group(1)) + 4
        if sum(map(len, parts)) >= need:
            yield begun, at - begun, b"".join(parts)
            begun, parts, need = at, [], None


def surt(url: str | None) -> str:
    """Reversed-host key of a url: ``http://a.b.org/x`` becomes ``org,b,a)/x``; null is empty."""
    if url is None:
        return ""
    _, mark, after = url.partition("://")
    if not mark:
        return _safe(url)
    host = re.match(r"[^/?#]*", after).group()
    return ",".join(reversed(host.lower().split("."))) + ")" + _safe(after[len(host):])


def capture_key(url: str | None, page_id: int) -> str:
    return f"{surt(url)} {page_id:020d}"


# ---- writing and scanning -----------------------------------------------------------------

def payload_of(html: str) -> Column:
    return F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8")


def write_archive(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) into ``folder``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is
    the response; the others are revisits of it.  A null html is an empty payload, a null id the
    largest id; rows that repeat an id and payload are responses both."""
    rows = pages.select(id_key("page_id").alias("id"), F.col("url").cast("string").alias("url"), payload_of("html").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    shared = F.octet_length("payload") >= min_bytes
    first = rows.where(shared).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    rows = rows.join(first, "digest", "left").select(
        "id", "url", "payload", "digest", F.when(shared & (F.col("first") != F.col("id")), F.col("first")).alias("refers"))

    def written(batches):
        for batch in batches:
            c = [batch.column(n).to_pylist() for n in ("id", "url", "payload", "digest", "refers")]
            out = [members(record_bytes(i, u, p, base64.b32encode(bytes.fromhex(d)).decode(), r))[:-1]
                   for i, u, p, d, r in zip(*c)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])
    # The text sink writes bytes as they are; its line end is the zero byte that each member ends in.
    rows.mapInArrow(written, "member binary").select(F.col("member").cast("string").alias("value")) \
        .write.option("lineSep", "\0").option("maxRecordsPerFile", FILE_RECORDS).text(folder)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")


def scan_archive(spark: SparkSession, folder: str) -> DataFrame:
    """``(key, path, offset, length)`` of every record in the archive files."""
    def scanned(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = []
                for offset, length, record in split_members(content):
                    head = parse_record(record)
                    rows.append((capture_key(head.get("warc-target-uri"), _page_of(head["warc-record-id"])), path, offset, length))
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
                columns = list(zip(*rows)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "path", "offset", "length"])
    return archive_files(spark, folder).mapInArrow(scanned, "key string, path string, offset bigint, length bigint")


# ---- the two-level index ------------------------------------------------------------------

def write_index(entries: DataFrame, folder: str) -> None:
    """Captures in the order of their keys as compressed blocks, written to ``folder``.

    Rows: block (ascending with the keys), first_key, n, data.  A range task makes its blocks as a
    stream; keys hold the page id, so one very common url spreads over blocks and tasks."""
    def blocked(batches):
        part, made, held = TaskContext.get().partitionId(), 0, []

        def block(rows):
            data = zlib.compress("\n".join(json.dumps(r) for r in rows).encode())
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) | made]), pa.array([rows[0][0]]),
                                               pa.array([len(rows)], pa.int32()), pa.array([data], pa.binary())],
                                              ["block", "first_key", "n", "data"])
        for batch in batches:
            held += zip(*[batch.column(c).to_pylist() for c in ("key", "path", "offset", "length")])
            while len(held) >= BLOCK_KEYS:
                yield block(held[:BLOCK_KEYS])
                held, made = held[BLOCK_KEYS:], made + 1
        if held:
            yield block(held)
    entries.repartitionByRange("key", "path", "offset").sortWithinPartitions("key", "path", "offset") \
        .mapInArrow(blocked, "block bigint, first_key string, n int, data binary").write.parquet(folder)


def _chunked(df: DataFrame, by: str) -> DataFrame:
    """``(by, keys)``: the keys of each value of ``by`` in lists of at most ASK, made as a stream over
    rebalanced partitions, so that any number of keys of one value is no burden."""
    def chunked(batches):
        held, keys = None, []
        for batch in batches:
            out = []
            for v, k in zip(batch.column(by).to_pylist(), batch.column("key").to_pylist()):
                if keys and (v != held or len(keys) >= ASK):
                    out.append((held, keys))
                    keys = []
                held = v
                keys.append(k)
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                              pa.array([o[1] for o in out], pa.list_(pa.string()))], [by, "keys"])
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), pa.array([keys], pa.list_(pa.string()))], [by, "keys"])
    return df.select(by, "key").hint("rebalance", by).sortWithinPartitions(by, "key").mapInArrow(
        chunked, f"{by} bigint, keys array<string>")


def _span(first: list[str], key: str) -> range:
    """Places of the parts, by their first keys, in which ``key`` can be."""
    return range(max(bisect_left(first, key) - 1, 0), max(bisect_right(first, key), 1))


class CaptureIndex:
    """An index folder, open for lookups: the root is held, pages and blocks are joined."""

    def __init__(self, spark: SparkSession, folder: str):
        self.blocks = spark.read.parquet(folder)
        names = self.blocks.select("block", "first_key")
        per_page = max(PAGE_BLOCKS, -(-names.count() // ROOT_KEYS))
        place = F.col("block").bitwiseAND(F.lit((1 << 32) - 1))
        paged = names.withColumn("page", F.col("block") - place + F.floor(place / per_page))
        # A page holds at most per_page blocks of one range task.
        self.pages = paged.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("first_key", "block"))).alias("names"))
        root = sorted((r["k"], r["page"]) for r in paged.groupBy("page").agg(F.min("first_key").alias("k")).collect())
        self.root = spark.sparkContext.broadcast(([r[0] for r in root], [r[1] for r in root]))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """``(key, path, offset, length)`` of the captures of the distinct ``keys`` (column ``key``);
        a key that is not in the index gives nothing."""
        root = self.root

        def to_pages(batches):
            first, pages = root.value
            for batch in batches:
                found = [(k, pages[i]) for k in batch.column("key").to_pylist() for i in _span(first, k) if pages]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()),
                                                  pa.array([f[1] for f in found], pa.int64())], ["key", "page"])

        def to_blocks(batches):
            for batch in batches:
                found = []
                for asked, names in zip(batch.column("keys").to_pylist(), batch.column("names").to_pylist()):
                    first = [n["first_key"] for n in names]
                    found += [(k, names[i]["block"]) for k in asked for i in _span(first, k)]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()),
                                                  pa.array([f[1] for f in found], pa.int64())], ["key", "block"])

        def to_captures(batches):
            for batch in batches:
                found = []
                for asked, data in zip(batch.column("keys").to_pylist(), batch.column("data").to_pylist()):
                    wanted = set(asked)
                    rows = (json.loads(x) for x in zlib.decompress(data).decode().split("\n"))
                    found += [r for r in rows if r[0] in wanted]
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
                columns = list(zip(*found)) if found else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "path", "offset", "length"])
        asked = keys.select("key").where("key is not null").distinct()
        paged = _chunked(asked.mapInArrow(to_pages, "key string, page bigint"), "page")
        blocked = paged.join(self.pages, "page").select("keys", "names").mapInArrow(to_blocks, "key string, block bigint")
        chunks = _chunked(blocked, "block").join(self.blocks.select("block", "data"), "block").select("keys", "data")
        return chunks.mapInArrow(to_captures, "key string, path string, offset bigint, length bigint")


def read_records(spark: SparkSession, folder: str, captures: DataFrame) -> DataFrame:
    """The records of ``captures`` (path, offset, length), each read from its range of its file.

    ``(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload)``; length and
    digest of a response are those of the payload as read, of a revisit those it names."""
    ranges = captures.groupBy("path").agg(F.collect_list(F.struct("offset", "length")).alias("ranges"))
    schema = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
              "payload_digest string, payload binary")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def read(batches):
        for batch in batches:
            for content, wanted in zip(batch.column("content"), batch.column("ranges").to_pylist()):
                view, rows = memoryview(content.as_buffer()), []
                for r in wanted:
                    part = view[r["offset"]:r["offset"] + r["length"]]
                    record = parse_record(b"".join(x for _, _, x in split_members(part)))
                    payload, kind = record["payload"], record["warc-type"]
                    if kind == "response":
                        size, digest, refers = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), None
                    else:
                        size, digest = int(record["x-payload-length"]), record["warc-payload-digest"][5:]
                        refers = _page_of(record["warc-refers-to"])
                    rows.append((_page_of(record["warc-record-id"]), record.get("warc-target-uri"), kind, refers, size, digest, payload))
                for at in range(0, len(rows), 1000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at:at + 1000]), kinds)], names)
    files = archive_files(spark, folder)
    return files.join(ranges, "path").select("content", "ranges").mapInArrow(read, schema)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as WARC files, index them, look every page up and read its record back.

    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``, a row per page.  A null
    html is an empty payload, a null or odd url is kept as it can be; a null page_id is the largest
    id and given back as null; rows that repeat are records each; an empty table gives an empty
    result.  The files stay in the shared checkpoint folder."""
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archive(pages, f"{folder}/records")
    write_index(scan_archive(spark, f"{folder}/records"), f"{folder}/index")
    index = CaptureIndex(spark, f"{folder}/index")

    def keyed(ids: pa.Array, urls: pa.Array) -> pa.Array:
        return pa.array([capture_key(None if u is None else _safe(u), i)
                         for i, u in zip(ids.to_pylist(), urls.to_pylist())], pa.string())
    keys = pages.select(F.arrow_udf(keyed, "string")(id_key("page_id"), F.col("url").cast("string")).alias("key"))
    read = read_records(spark, f"{folder}/records", index.lookup(keys))
    return read.select(id_back("page_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       id_back("refers_to").alias("refers_to"))
