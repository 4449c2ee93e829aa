"""Vector codes: every part of a vector becomes the index of its nearest codebook entry.

Lloyd rounds over integer vectors, with adaptive bounds (Drake and Hamerly).  Each part of each row
keeps its nearest entry with an upper bound of the distance, its next b nearest entries with lower
bounds in order, and one outer bound below the distances of all others.  When the codebook has moved,
bounds move by as much; a part whose bounds still tell the nearest entry is not compared at all, one
whose outer bound does is compared with the entries kept, and only the rest with the whole codebook.
b is adapted to how many entries were needed.  Bounds are floating numbers with a margin; what they
don't settle is decided by integer distances, so codes equal those of a full search, ties included.

Rows and their bounds are written between rounds; the driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, id_back, id_key, join_unique

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = 2 ** 28             # an integer beyond would leave the exact range of summed squares
MARGIN = 1e-9               # relative; bounds nearer than that are decided by integers


def integer_vectors(rows: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """``rows`` whose vector has finite components alone, as integers ``x = floor(scale * component)``."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint"))
    fit = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double") * F.lit(float(scale))) < LIMIT, F.lit(False)))
    return rows.where(F.col(vector).isNotNull()).where(fit).withColumn("x", x)


def part_ends(dims: int, parts: int) -> list[int]:
    """Where the parts end: equal parts where ``parts`` divides ``dims``, else as equal as can be."""
    return [(i + 1) * dims // parts for i in range(parts)]


class Codebooks:
    """The entries of all part positions for vectors of one length, and how far each moved last."""

    def __init__(self, first: np.ndarray, parts: int):
        ends = part_ends(first.shape[1], parts)
        self.spans = list(zip([0, *ends[:-1]], ends))
        self.entries = [first[:, a:b].copy() for a, b in self.spans]
        self.moved = [np.zeros(len(e)) for e in self.entries]

    def renewed(self, sums: np.ndarray, counts: np.ndarray) -> Codebooks:
        """Entries become the floor of their parts' mean; unused ones stay.  ``sums`` (entry, dimension)
        has each part's sums in its span; ``counts`` is (part, entry)."""
        out = object.__new__(Codebooks)
        out.spans, out.entries, out.moved = self.spans, [], []
        for (a, b), old, n in zip(self.spans, self.entries, counts):
            new = np.where(n[:, None] > 0, np.floor_divide(sums[:, a:b], np.maximum(n, 1)[:, None]), old)
            out.entries.append(new)
            out.moved.append(np.sqrt(((new - old) ** 2).sum(1).astype(np.float64)))
        return out

    def digest(self) -> str:
        numbers = (str(int(v)) for part in self.entries for entry in part for v in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _all(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Integer squared distances of every row to every entry."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - entries[None, :, j]) ** 2
    return out


def _some(x: np.ndarray, entries: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Integer squared distances of every row to its own list of entries."""
    out = np.zeros(which.shape, np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - entries[which, j]) ** 2
    return out


class Bounds:
    """The persisted bounds of one part position for the rows of a batch: ``near`` has the nearest entry and the b
    next ones, ``low`` their distances (the first an upper bound, the others lower ones), ``outer`` the rest's bound."""

    def __init__(self, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
        self.near, self.low, self.outer = near, low, outer

    @staticmethod
    def full(x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
        """By distances to the whole codebook; ties go to the smaller index."""
        k = len(entries)
        squares = _all(x, entries)
        # distance and index in one number, so that sorting breaks ties
        b = min(b, k - 1)
        order = np.argsort(squares, axis=1, kind="stable")[:, :b + 2]
        low = np.sqrt(np.take_along_axis(squares, order, 1).astype(np.float64))
        outer = low[:, b + 1].copy() if k > b + 1 else np.full(len(x), np.inf)
        return Bounds(order[:, :b + 1].astype(np.int64), low[:, :b + 1], outer)

    def move(self, moved: np.ndarray) -> None:
        """The entries moved: the nearest may be farther, all others nearer, each by as much."""
        pad = MARGIN * (1.0 + self.low)
        steps = moved[self.near]
        self.low = np.concatenate([(self.low + steps + pad)[:, :1], (self.low - steps - pad)[:, 1:]], 1)
        self.outer = self.outer - moved.max(initial=0.0) - MARGIN * (1.0 + np.where(np.isfinite(self.outer), self.outer, 0.0))

    def settle(self, x: np.ndarray, entries: np.ndarray) -> int:
        """Makes the first entry the nearest again; returns the longest list of entries that a row needed.

        Rows whose upper bound lies below every lower bound stay untouched.  For the others the integer
        distances of the kept entries are taken; if the least is not surely below the outer bound, all are."""
        rest = np.minimum(self.low[:, 1:].min(1, initial=np.inf), self.outer)
        unsure = np.flatnonzero(~(self.low[:, 0] < rest))
        if not len(unsure):
            return 0
        near = self.near[unsure]
        squares = _some(x[unsure], entries, near)
        order = np.lexsort([near, squares], axis=1)
        near, squares = np.take_along_axis(near, order, 1), np.take_along_axis(squares, order, 1)
        low = np.sqrt(squares.astype(np.float64))
        sure = low[:, 0] * (1 + MARGIN) < self.outer[unsure]
        # how far down the old list the new nearest was: what b must hold
        depth = int(np.argmax(order[sure, 0:1] == np.arange(order.shape[1])[None, :], axis=1).max(initial=0)) if sure.any() else 0
        self.near[unsure[sure]], self.low[unsure[sure]] = near[sure], low[sure]
        lost = unsure[~sure]
        if len(lost):
            fresh = Bounds.full(x[lost], entries, self.near.shape[1] - 1)
            self.near[lost], self.low[lost], self.outer[lost] = fresh.near, fresh.low, fresh.outer
            depth = self.near.shape[1] - 1
        return depth

    def narrow(self, b: int) -> None:
        """Keep b entries beside the nearest; the outer bound covers those let go."""
        if self.near.shape[1] > b + 1:
            self.outer = np.minimum(self.outer, self.low[:, b + 1:].min(1))
            self.near, self.low = self.near[:, :b + 1], self.low[:, :b + 1]


# ---- blocks of rows -----------------------------------------------------------------------

BLOCK = "dims int, ids binary, labels array<string>, x binary, state binary"


def _narrow_type(k: int) -> str:
    return "<u1" if k <= 256 else "<u2"


def _pack(bounds: list[Bounds], k: int) -> bytes:
    """Bounds as 32-bit numbers, upper ones rounded up and lower ones down."""
    out = []
    for b in bounds:
        down = b.low.astype("<f4")
        down = np.where(down > b.low, np.nextafter(down, np.float32(-np.inf)), down)
        up = b.low[:, 0].astype("<f4")
        down[:, 0] = np.where(up < b.low[:, 0], np.nextafter(up, np.float32(np.inf)), up)
        outer = b.outer.astype("<f4")
        outer = np.where(outer > b.outer, np.nextafter(outer, np.float32(-np.inf)), outer)
        out += [np.array(b.near.shape, "<u4").tobytes(), b.near.astype(_narrow_type(k)).tobytes(), down.astype("<f4").tobytes(), outer.astype("<f4").tobytes()]
    return b"".join(out)


def _unpack(state: bytes, k: int) -> list[Bounds]:
    out, at = [], 0
    while at < len(state):
        n, width = np.frombuffer(state, "<u4", 2, at).tolist()
        at += 8
        near = np.frombuffer(state, _narrow_type(k), n * width, at)
        at += near.nbytes
        low = np.frombuffer(state, "<f4", n * width, at)
        at += low.nbytes
        outer = np.frombuffer(state, "<f4", n, at)
        at += outer.nbytes
        out.append(Bounds(near.astype(np.int64).reshape(n, width), low.astype(np.float64).reshape(n, width), outer.astype(np.float64)))
    return out


def _settled(x: np.ndarray, state: bytes, books: Codebooks) -> list[Bounds]:
    """The bounds of a block's rows, part by part, for the present codebooks; b shrinks to what was needed."""
    k, out = len(books.entries[0]), []
    old = _unpack(state, k) if state else []
    for p, ((a, b), entries) in enumerate(zip(books.spans, books.entries)):
        if not old:
            out.append(Bounds.full(x[:, a:b], entries, max(1, k // 8)))
            continue
        bounds = old[p]
        bounds.move(books.moved[p])
        bounds.narrow(max(k // 32, 1, bounds.settle(x[:, a:b], entries)))
        out.append(bounds)
    return out


def _block_rows(dims: int) -> int:
    return max(1, (1 << 22) // (8 * max(1, dims)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["dims", "ids", "labels", "x", "state"])


def _blocks(rows: DataFrame, books: Broadcast) -> DataFrame:
    """``(id, label, x)`` rows as blocks with the bounds of a first, full assignment."""
    def built(batches):
        for batch in batches:
            dims = pc.list_value_length(batch.column("x"))
            for d in pc.unique(dims).to_pylist():
                part = batch.filter(pc.equal(dims, d))
                for at in range(0, part.num_rows, _block_rows(d)):
                    cut_ = part.slice(at, _block_rows(d))
                    x = cut_.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(cut_.num_rows, d)
                    own = books.value[d]
                    state = _pack(_settled(x.astype(np.int64), b"", own), len(own.entries[0]))
                    yield _batch([(d, cut_.column("id").to_numpy().astype("<i8").tobytes(), cut_.column("label").to_pylist(), x.tobytes(), state)])
    return rows.mapInArrow(built, BLOCK)


def _each_block(batch: pa.RecordBatch):
    for d, ids, labels, x, state in zip(*(batch.column(c).to_pylist() for c in ("dims", "ids", "labels", "x", "state"))):
        yield d, ids, labels, x, state, np.frombuffer(x, "<i4").reshape(len(ids) // 8, d).astype(np.int64)


def _reassigned(blocks: DataFrame, books: Broadcast) -> DataFrame:
    def moved(batches):
        for batch in batches:
            for d, ids, labels, raw, state, x in _each_block(batch):
                own = books.value[d]
                yield _batch([(d, ids, labels, raw, _pack(_settled(x, state, own), len(own.entries[0])))])
    return blocks.mapInArrow(moved, BLOCK)


def _renewed(blocks: DataFrame, books: dict[int, Codebooks]) -> dict[int, Codebooks]:
    """The codebooks of the next round.  Tasks add up sums and counts; per length the driver gets one number for
    each entry and dimension and one for each entry and part."""
    sizes = {d: (len(b.entries[0]), b.spans) for d, b in books.items()}

    def added(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, _, _, state, x in _each_block(batch):
                k, spans = sizes[d]
                out = total.setdefault(d, np.zeros((k, d + len(spans)), np.int64))
                for p, ((a, b), bounds) in enumerate(zip(spans, _unpack(state, k))):
                    np.add.at(out[:, a:b], bounds.near[:, 0], x[:, a:b])
                    out[:, d + p] += np.bincount(bounds.near[:, 0], minlength=k)
        for d, out in total.items():
            entry, place = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(entry), d, np.int32)), pa.array(entry.astype(np.int32)),
                                              pa.array(place.astype(np.int32)), pa.array(out[entry, place])], ["dims", "entry", "place", "n"])
    sums = blocks.mapInArrow(added, "dims int, entry int, place int, n bigint").groupBy("dims", "entry", "place").agg(F.sum("n").alias("n"))
    found = {d: np.zeros((len(b.entries[0]), d + len(b.spans)), np.int64) for d, b in books.items()}
    for r in sums.toLocalIterator():
        found[r["dims"]][r["entry"], r["place"]] = r["n"]
    return {d: b.renewed(found[d][:, :d], found[d][:, d:].T) for d, b in books.items()}


def _first_books(rows: DataFrame, parts: int, entries: int) -> dict[int, Codebooks]:
    first = rows.withColumn("_d", F.size("x")) \
        .withColumn("_n", F.row_number().over(Window.partitionBy("_d").orderBy("id", "x"))).where(F.col("_n") <= entries)
    found: dict[int, list] = {}
    for r in first.select("_d", "_n", "x").collect():
        found.setdefault(r["_d"], []).append((r["_n"], r["x"]))
    return {d: Codebooks(np.array([x for _, x in sorted(xs)], np.int64).reshape(len(xs), d), min(parts, max(d, 1))) for d, xs in found.items()}


def _codes(blocks: DataFrame, books: Broadcast, digests: dict[int, str]) -> DataFrame:
    """``(id, label, dims, code, error, codebooks_sha256)`` of every row, by a last assignment."""
    names = ["id", "label", "dims", "code", "error", "codebooks_sha256"]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string()]

    def coded(batches):
        for batch in batches:
            for d, ids, labels, _, state, x in _each_block(batch):
                own = books.value[d]
                codes, error = np.zeros((len(x), len(own.spans)), np.int64), np.zeros(len(x), np.int64)
                for p, ((a, b), bounds) in enumerate(zip(own.spans, _settled(x, state, own))):
                    codes[:, p] = bounds.near[:, 0]
                    error += ((x[:, a:b] - own.entries[p][codes[:, p]]) ** 2).sum(1)
                digits = 2 if len(own.entries[0]) <= 256 else 4
                texts = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
                columns = [np.frombuffer(ids, "<i8"), labels, np.full(len(x), d), texts, error, [digests[d]] * len(x)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)
    return blocks.mapInArrow(coded, "id bigint, label string, dims int, code string, error bigint, codebooks_sha256 string")


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
                 id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every row whose vector is fit.

    Vectors that are null or hold a null, non-finite or huge component (2**28 or more when scaled) are
    dropped.  Vectors of each length have codebooks, and label sums, of their own; the parts of a length
    that ``parts`` doesn't divide differ by one; fewer components than parts make as many parts (an empty vector one).
    A codebook starts with the vectors of the ``entries`` smallest ids (null ids last, ties by vector),
    fewer if there are fewer rows; equal entries are entries each, of which the first is used.  Rows
    that repeat an id are vectors each.  Null labels are one label.  An empty table gives an empty result.
    The driver and each task hold one set of codebooks per length."""
    spark = vectors.sparkSession
    vectors = vectors.select(id_key(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("_v"))
    rows = integer_vectors(vectors, "_v", scale).select("id", "label", "x")
    books = _first_books(rows, parts, entries)
    blocks = cut(_blocks(rows, spark.sparkContext.broadcast(books)))
    for i in range(rounds):
        books = _renewed(blocks, books)
        if i < rounds - 1:
            blocks = cut(_reassigned(blocks, spark.sparkContext.broadcast(books)))
    out = cut(_codes(blocks, spark.sparkContext.broadcast(books), {d: b.digest() for d, b in books.items()}))
    # A null label is a label: it is told apart by a key of its own.
    key = ["dims", "_null", "_label"]
    out = out.withColumn("_null", F.col("label").isNull()).withColumn("_label", F.coalesce("label", F.lit("")))
    sums = out.groupBy(*key).agg(F.sum("error").alias("label_error"), F.count("*").alias("_n"))
    return join_unique(out, sums, key, "_n", out.count()) \
        .select(id_back("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")
