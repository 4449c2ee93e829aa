"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 r`` bits share a variant that is at most ``r``
bits from each, and two that share such a variant differ in at most ``2 r`` bits.  So every
fingerprint emits its ball of radius ``r``, variants meet by shuffle, and a collision is a
link (it is verified all the same).

A ball of radius 2 has 2081 variants of 8 bytes.  Written one by one they would be many times
the corpus, so they travel in a compact form: variants are dealt to cells by an XOR-linear
hash ``g``; ``g(f ^ m) = g(f) ^ g(m)``, so a cell that receives the fingerprint ``f`` knows
exactly which masks ``m`` bring ``f`` into it and makes those variants itself.  Every variant
is made once, in its cell; only (cell, fingerprint) is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_name, id_back, id_key, join_unique, written
from strata.llm.components import components

SEGMENT_BYTES = 1 << 20       # long texts are cut into segments of words, joined by their last words
CELL_FINGERPRINTS = 1 << 22   # fingerprints a cell may hold before there are more cells
PASS_VARIANTS = 1 << 21       # variants sorted at once within a cell


# ---- fingerprints -------------------------------------------------------------------------

def _segments(raw: bytes) -> Iterator[bytes]:
    """``raw`` in segments that end between words."""
    at = 0
    while len(raw) - at > SEGMENT_BYTES:
        end = at + SEGMENT_BYTES
        while end < len(raw) and raw[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield raw[at:end]
        at = end
    yield raw[at:]


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of the shingles of ``words`` words (A-Z lowered, ASCII white space between words).

    Every shingle counts as often as it occurs; a text with fewer words is one shingle; a text
    without words (null, empty) has fingerprint zero."""
    digest, ones, n, tail = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, []
    for part in _segments((text or "").encode().lower()):
        run = tail + part.split()
        if len(run) >= words:
            hashes = [digest(b" ".join(run[i:i + words]), seed) for i in range(len(run) - words + 1)]
            bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            n += len(hashes)
            tail = run[len(run) - words + 1:]
        else:
            tail = run
    if n == 0:
        return digest(b" ".join(tail), seed) if tail else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest, fp)`` for every row: ``id`` a null-safe key, ``digest`` a hash of the text that
    tells rows of one id apart, ``fp`` the fingerprint as a signed long."""
    text = F.col(text_col).cast("string")
    rows = docs.select(id_key(id_col).alias("id"), F.xxhash64(text).alias("digest"), text.alias("text"))

    def hashed(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, words, seed) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), pa.array(fp.view(np.int64))],
                                             ["id", "digest", "fp"])
    return rows.mapInArrow(hashed, "id bigint, digest bigint, fp bigint")


# ---- ball hashing -------------------------------------------------------------------------

def _columns(bits: int) -> np.ndarray:
    """The XOR-linear hash: bit i of a fingerprint adds ``columns[i]``, a value below ``2**bits``.

    The low six bits are i itself, which spreads the pairs of one fingerprint evenly over 64
    cells; further bits are pseudo-random."""
    i = np.arange(64, dtype=np.uint64)
    z = (i + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = z ^ (z >> np.uint64(27))
    mixed = (z << np.uint64(6)) | i if bits > 6 else i
    return (mixed & np.uint64((1 << bits) - 1)).astype(np.uint64)


def linear_hash(x: np.ndarray, bits: int) -> np.ndarray:
    out, cols = np.zeros(len(x), np.uint64), _columns(bits)
    for i in range(64):
        out ^= ((x >> np.uint64(i)) & np.uint64(1)) * cols[i]
    return out


def masks(radius: int) -> np.ndarray:
    """All 64-bit values with at most ``radius`` bits set."""
    return np.array([sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(64), r)], np.uint64)


def _masks_by_hash(radius: int, bits: int) -> dict[int, np.ndarray]:
    all_masks = masks(radius)
    h = linear_hash(all_masks, bits)
    order = np.argsort(h, kind="stable")
    values, starts = np.unique(h[order], return_index=True)
    return dict(zip(values.tolist(), np.split(all_masks[order], starts[1:])))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component, for edges ``a[i] - b[i]`` among ``n`` points."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new


def cell_links(cell: int, fps: np.ndarray, radius: int, bits: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among ``fps`` (distinct) by the variants that fall into ``cell``: a spanning forest.

    The cell is worked through in parts of about PASS_VARIANTS variants (more hash bits)."""
    made = len(fps) * max(1, len(masks(radius)) >> bits)
    extra = max(0, int(np.ceil(np.log2(max(1, made / PASS_VARIANTS)))))
    by_hash, h = _masks_by_hash(radius, bits + extra), linear_hash(fps, bits + extra)
    order = np.argsort(h, kind="stable")
    classes, starts = np.unique(h[order], return_index=True)
    members = np.split(order, starts[1:])
    left, right = [], []
    for part in range(1 << extra):
        target = (part << bits) | cell
        variants, owners = [], []
        for value, own in zip(classes.tolist(), members):
            m = by_hash.get(value ^ target)
            if m is not None:
                variants.append((fps[own][:, None] ^ m).ravel())
                owners.append(np.repeat(own, len(m)))
        if not variants:
            continue
        v, o = np.concatenate(variants), np.concatenate(owners)
        by = np.argsort(v, kind="stable")
        v, o = v[by], o[by]
        same = np.flatnonzero(v[1:] == v[:-1])
        left.append(o[same])
        right.append(o[same + 1])
    if not left or not sum(map(len, left)):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
    apart = np.bitwise_count(fps[pairs[0]] ^ fps[pairs[1]])
    pairs = pairs[:, apart <= limit]
    roots = local_roots(len(fps), pairs[0], pairs[1])
    linked = np.flatnonzero(roots != np.arange(len(fps)))
    return fps[linked], fps[roots[linked]]


def links(classes: DataFrame, count: int, max_bits: int = 4, fp: str = "fp") -> DataFrame:
    """``(a, b)``: links between distinct fingerprints that differ in at most ``max_bits`` bits.

    Every collision of every pair is found; from one cell only a spanning forest of its links
    leaves, so a large group of near copies never becomes all its pairs (fingerprints that share
    a variant are all within ``max_bits`` of each other, so a chain through them loses nothing)."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: the balls have half of it as radius")
    radius = max_bits // 2
    ball = len(masks(radius))
    bits = 6
    while count * min(1.0, ball / (1 << bits)) > CELL_FINGERPRINTS:
        bits += 1

    def dealt(batches):
        by_hash = _masks_by_hash(radius, bits)
        reach = np.array(sorted(by_hash), np.uint64)
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(x):
                continue
            cells = (linear_hash(x, bits)[:, None] ^ reach).ravel()
            owner = np.repeat(np.arange(len(x)), len(reach))
            order = np.argsort(cells, kind="stable")
            values, starts = np.unique(cells[order], return_index=True)
            blobs = [x[g].tobytes() for g in np.split(owner[order], starts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(blobs, pa.binary())], ["cell", "fps"])

    def joined(key, pdf):
        fps = np.unique(np.frombuffer(b"".join(pdf["fps"]), np.uint64))
        a, b = cell_links(int(key[0]), fps, radius, bits, max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    cells = classes.select(F.col(fp).alias("fp")).mapInArrow(dealt, "cell bigint, fps binary")
    return cells.groupBy("cell").applyInPandas(joined, "a bigint, b bigint")


def _grouped(docs: DataFrame, words: int, max_bits: int, seed: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(id, digest, fp)`` of every row, and of every distinct fingerprint ``(fp, copies, first)``:
    the number of its rows, and the smallest (id, digest) of its component."""
    fps = written(fingerprints(docs, words, seed, id_col, text_col), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min(F.struct("id", "digest")).alias("first"), F.count("*").alias("copies")), "classes")
    n = classes.count()
    # Written first: else each task of the component search has two Python workers, and executors keep all of them.
    comps = components(written(links(classes, n, max_bits), "links"))
    named = written(classes.join(comps, F.col("fp") == F.col("node"), "left").select(
        "fp", "copies", F.col("first").alias("own"), F.coalesce("comp", "fp").alias("comp")), "named")
    smallest = named.groupBy("comp").agg(F.min("own").alias("first"), F.count("*").alias("n"))
    return fps, join_unique(named, smallest, ["comp"], "n", n).select("fp", "copies", "first")


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest id reachable by links of at most ``max_bits`` bits, itself
    included.  Equal fingerprints link at distance zero, also the zero of texts without words
    (null or empty).  A null id is the largest id, given back as null; repeated rows are in one
    group; an empty table gives an empty result; other columns are not read."""
    fps, classes = _grouped(docs, words, max_bits, seed, id_col, text_col)
    return join_unique(fps, written(classes, "groups"), ["fp"], "copies", fps.count()).select(
        id_back("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        id_back("first.id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 4, max_bits: int = 4, seed: int = 42) -> DataFrame:
    """The documents with one row of each near-duplicate group left: the one with the smallest
    id (of rows that repeat this id in the group, one).  Rows of one id with different texts are
    documents each, so each of their groups keeps one."""
    key, text = free_name(docs, "_key"), F.xxhash64(F.col("text").cast("string"))
    _, classes = _grouped(docs, words, max_bits, seed, "doc_id", "text")
    kept = classes.select(F.col("first").alias(key)).distinct()
    marked = docs.withColumn(key, F.struct(id_key("doc_id").alias("id"), text.alias("digest")))
    return marked.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
