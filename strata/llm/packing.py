"""Packing documents into sequences: first-fit decreasing on a tournament tree of bin capacities.

A document's ids are cut into full sequences and a rest.  Rests go to randomised groups; a group
packs its rests by decreasing length, each into the first bin with room, which a tournament tree
of the bins' free capacities finds in logarithmic time.  Groups are independent tasks.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, id_back, id_key

SEQUENCE = 1024
GROUP_ITEMS = 2000        # rests of a group, in expectation
PART_TEXTS = 256          # texts of a batch that a task holds as strings at once
TOKENIZER = os.environ.get("STRATA_TOKENIZER", "byte_bpe_50k.json")


# Fixed value: the split pattern of this kind of tokenizer file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_signs() -> dict[str, int]:
    """The sign that a byte-level vocabulary writes for each byte: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteTokenizer:
    """Ids of a byte-level BPE file, as little-endian unsigned 32-bit bytes.

    The file's vocabulary is ranked in the order of its merges, so a rank encoder gives the same ids
    faster; texts that hold a special token's string, or that the encoder can't take, go through the
    file's own tokenizer."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.own = Tokenizer.from_file(path)
        self.special = {t.content for t in self.own.get_added_tokens_decoder().values()}
        signs = _byte_signs()
        ranks = {bytes(signs[c] for c in w): i for w, i in self.own.get_vocab(with_added_tokens=False).items() if w not in self.special}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
            except BaseException as e:   # the encoder's panic is not an Exception
                if isinstance(e, (KeyboardInterrupt, SystemExit, GeneratorExit, MemoryError)):
                    raise
        return np.array(self.own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_loaded: dict[str, ByteTokenizer] = {}


def tokenizer(name: str) -> ByteTokenizer:
    """The tokenizer of a worker, loaded once; ``name`` is a path or a file of the public tokenizers."""
    if name not in _loaded:
        path = name
        if not os.path.isabs(name):
            import public_tokenizers
            path = public_tokenizers.path(name)
        _loaded[name] = ByteTokenizer(path)
    return _loaded[name]


def pieces(docs: DataFrame, length: int = SEQUENCE, name: str = TOKENIZER, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ids, ending in id 0, cut into pieces of at most ``length``.

    ``(doc_id, start, length, ids_crc32, doc_tokens, row)`` and ``ids`` if asked for; ``doc_id`` is a
    null-safe key and ``row`` a number for the document's row (the checksum of its ids)."""
    rows = docs.select(id_key(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, row bigint" + ", ids binary" * with_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"] + ["ids"] * with_ids

    def cut_up(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = tokenizer(name)
        for batch in batches:
            for at in range(0, batch.num_rows, PART_TEXTS):
                out, few = [], batch.slice(at, PART_TEXTS)
                for doc, text in zip(few.column("doc_id").to_pylist(), few.column("text").to_pylist()):
                    ids = encode.ids(text) + b"\0\0\0\0"
                    n, whole = len(ids) // 4, zlib.crc32(ids)
                    for start in range(0, n, length):
                        part = ids[4 * start:4 * (start + length)]
                        out.append((doc, start, len(part) // 4, zlib.crc32(part), n, whole, part))
                columns = list(zip(*out)) if out else [[]] * 7
                kinds = [pa.int64()] * 6 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:len(names)], kinds)], names)
    return rows.mapInArrow(cut_up, schema)


class Bins:
    """Free capacities of bins in order, as a tournament tree: a node holds the larger of its two."""

    def __init__(self, n: int, capacity: int):
        self.half = 1 << max(0, (n - 1).bit_length())
        self.tree = [capacity] * (2 * self.half)

    def put(self, size: int) -> tuple[int, int]:
        """The first bin with room for ``size`` and the free capacity it had."""
        tree, at = self.tree, 1
        while at < self.half:
            at *= 2
            if tree[at] < size:
                at += 1
        had = tree[at]
        tree[at] = had - size
        place = at - self.half
        while at > 1:
            at //= 2
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
        return place, had


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of every size, in the order given."""
    bins, out = Bins(len(sizes), capacity), [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        place, had = bins.put(sizes[i])
        out[i] = (place, capacity - had)
    return out


def pack(cut_docs: DataFrame, length: int = SEQUENCE, group_items: int = GROUP_ITEMS, seed: int = 7) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Full pieces are sequences of their own.  The groups of the rests are drawn by a seeded hash of
    the piece and its document, and there are as many as make about ``group_items`` rests each, so
    a group stays small at any size of the corpus; equal rows may fall into one group and are
    packed each."""
    cut_docs = cut_docs.withColumn("_n", F.xxhash64("doc_id", "row", "start", F.lit(seed)))
    full = cut_docs.where(F.col("length") == length) \
        .withColumn("sequence_id", F.concat_ws("-", F.lit("d"), "doc_id", "start", F.hex(F.monotonically_increasing_id()))) \
        .withColumn("offset", F.lit(0).cast("bigint")).drop("_n")
    rests = cut_docs.where(F.col("length") < length)
    groups = max(1, -(-rests.count() // group_items))
    rests = rests.withColumn("_g", F.pmod(F.col("_n"), F.lit(groups)))
    columns = [c for c in cut_docs.columns if c != "_n"]
    schema = ", ".join(f"{c} {t}" for c, t in cut_docs.select(*columns).dtypes) + ", sequence_id string, offset bigint"

    def packed(key, pdf):
        order = ["_n", "doc_id", "start", "length", "ids_crc32"]
        pdf = pdf.sort_values(order, na_position="last", kind="stable").reset_index(drop=True)
        places = first_fit_decreasing(pdf["length"].tolist(), length)
        pdf["sequence_id"] = [f"g-{key[0]}-{p}" for p, _ in places]
        pdf["offset"] = np.array([o for _, o in places], np.int64)
        return pdf[[*columns, "sequence_id", "offset"]]
    return full.unionByName(rests.groupBy("_g").applyInPandas(packed, schema))


def packed_documents(docs: DataFrame, length: int = SEQUENCE, name: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents, packed (see ``pieces`` and ``pack``).

    A null or empty text is the one id 0.  A null doc_id stays null.  Rows that repeat are
    documents each.  A sequence counts as padded to ``length`` unless its fill is a power of two.
    An empty table gives an empty result; other columns are not read."""
    made = pieces(docs, length, name, with_ids)
    out = pack(made if with_ids else cut(made), length)
    return out.withColumn("doc_id", id_back("doc_id")).drop("row")
