"""Token ids in binary files, compressed shard by shard with Re-Pair grammars.

Documents are sorted by id, encoded, and laid out as one stream of ids.  The stream of each file is
cut into shards; a shard's frequent id pairs are replaced by nonterminals again and again, until no
pair is frequent.  A shard stores its rules (two symbols and the length they expand to) and what is
left of its ids, so any range of ids is decoded from the symbols that cover it alone.

A file is a run of shards, each ended by a line feed, in little-endian numbers::

    "RPR1"; width, docs, base, rules, symbols, more (u4 each); ids (u8)
    docs x doc id (i8), docs x ids of the document in this shard (u4)
    base x id (u4): the alphabet
    rules x left, rules x right (u2 or u4 by width), rules x expansion length (u4)
    symbols x symbol (u2 or u4)

A symbol s below ``base`` is the alphabet's id s, ``base + i`` is rule i, whose symbols are below it.
``more`` is 1 if the last document goes on in the next shard.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import id_back, id_key
from strata.session import ensure_checkpoint_dir

TOKENIZER = os.environ.get("STRATA_WORD_TOKENIZER", "word_bpe_49k.json")
END = 2                     # the id appended to every document
SHARD_IDS = 1 << 20         # ids of a shard
FILE_BYTES = 64 << 20       # text of a file, on average
MIN_PAIRS = 8               # a pair seen less often saves little beyond its rule
BAND = 64                   # pairs of a round occur about 1/BAND as often as its most frequent one, or more
WORDS = 3 << 17             # words whose ids a worker remembers, twice
PIECE = 1 << 20             # characters split at once
HEAD = struct.Struct("<4sIIIIIIQ")


# ---- ids ----------------------------------------------------------------------------------

def _gather(store: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``store[start:start + length]`` one after another."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return store[np.arange(total) + np.repeat(starts - before, lengths)] if total else store[:0]

SPACE, LETTER, DIGIT, SIGN, ODD = range(5)
PLAIN = 0x250               # texts of characters below are split here


def _kinds() -> np.ndarray:
    """The kind of every character below ``PLAIN``, as the tokenizer's split pattern sees it; the last entry stands for all others.

    Odd are characters whose lower case or kind may be read in two ways."""
    out = np.full(PLAIN + 1, SIGN, np.uint8)
    for c in range(PLAIN):
        out[c] = {"L": LETTER, "N": DIGIT}.get(unicodedata.category(chr(c))[0], SIGN)
    out[[*range(0x09, 0x0E), 0x20, 0xA0]] = SPACE
    out[[*range(0x1C, 0x20), 0x85, 0x130, PLAIN]] = ODD
    return out


class WordTokenizer:
    """Ids of a word-end BPE file by the tokenizers library, a batch of texts at a time.

    Such a tokenizer lower-cases, splits into words, and encodes each word by itself.  Plain texts are split
    here, all texts of a batch at once, and only words that the worker doesn't remember go to the
    library, many in one call; other texts go to the library whole.  Ids are the same (tested)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.own = Tokenizer.from_file(path)
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]
        vocab = self.own.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.kinds = _kinds()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        new = []
        for w in words:
            known = b"" if w.isspace() else self.old.get(w)
            if known is None:
                new.append(w)
            else:
                self.young[w] = known
        parts = [new[at:at + 1000] for at in range(0, len(new), 1000)]
        for part, found in zip(parts, self.own.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):       # a word without a word end: one by one
                self.young.update((w, self._whole(w)) for w in part)
                continue
            raw, last = ids.tobytes(), 0
            for w, stop in zip(part, (4 * stops).tolist()):
                self.young[w], last = raw[last:stop], stop

    def _split(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray] | list[int]:
        """The words and blanks of lower-cased texts, and how many there are up to each text's end; or the texts
        that hold odd characters, if any does."""
        joined = "\n".join(texts) + "\n"
        code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kind = self.kinds[np.minimum(code, PLAIN)]
        ends = np.cumsum([len(t) + 1 for t in texts])
        odd = np.flatnonzero(kind == ODD)
        if len(odd):
            return np.unique(np.searchsorted(ends, odd, "right")).tolist()
        starts = np.ones(len(code), bool)
        starts[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        at = np.flatnonzero((code == ord("'")) & starts)[:]
        at = at[at + 2 < len(code)]
        one = np.isin(code[at + 1], [ord(c) for c in "stmd"])
        two = np.zeros(len(at), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (code[at + 1] == ord(a)) & (code[at + 2] == ord(b))
        starts[at[one | two] + 1] = False
        starts[at[one] + 2] = True
        starts[at[two] + 3] = True
        begin = np.flatnonzero(starts)
        places = begin if joined.isascii() else (np.cumsum(1 + (code >= 0x80)) - 1 - (code >= 0x80))[begin]
        data = joined.encode()
        offsets = np.append(places, len(data)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))
        return words.dictionary_encode(), np.searchsorted(begin, ends)

    def _plain(self, texts: list[str]) -> list[bytes | None]:
        """The ids of texts without special tokens; None for those that must go to the library whole."""
        out: list[bytes | None] = [None] * len(texts)
        lower, own = [t.lower() for t in texts], list(range(len(texts)))
        split = self._split(lower)
        if isinstance(split, list):
            odd = set(split)
            own = [i for i in own if i not in odd]
            if not own:
                return out
            split = self._split([lower[i] for i in own])
        found, stops = split
        words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.young) > WORDS:
            self.young, self.old = {}, self.young
        self._learn(list(set(words).difference(self.young)))
        raw = list(map(self.young.__getitem__, words))
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        place = found.indices.to_numpy()
        ids = _gather(np.frombuffer(b"".join(raw), "<u4"), (np.cumsum(lengths) - lengths)[place], lengths[place]).tobytes()
        last = 0
        for i, stop in zip(own, (4 * np.append(0, np.cumsum(lengths[place]))[stops]).tolist()):
            out[i], last = ids[last:stop], stop
        return out

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as little-endian unsigned 32-bit integers."""
        out: list[bytes | None] = [None] * len(texts)
        group, size = [], 0
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                continue
            if len(t) > PIECE:
                out[i] = self._long(t)
                continue
            group.append(i)
            size += len(t)
            if size >= PIECE or len(group) >= 1 << 14:
                for j, ids in zip(group, self._plain([texts[j] for j in group])):
                    out[j] = ids
                group, size = [], 0
        if group:
            for j, ids in zip(group, self._plain([texts[j] for j in group])):
                out[j] = ids
        return [self._whole(t) if ids is None else ids for t, ids in zip(texts, out)]

    def _long(self, text: str) -> bytes | None:
        """A very long text piece by piece, cut at spaces; None if it must go to the library whole."""
        parts, at = [], 0
        while at < len(text):
            stop = len(text) if len(text) - at <= PIECE else text.rfind(" ", at, at + PIECE) + 1
            if not stop:
                return None
            ids = self._plain([text[at:stop]])[0]
            if ids is None:
                return None
            parts.append(ids)
            at = stop
        return b"".join(parts)


_loaded: dict[str, WordTokenizer] = {}


def tokenizer(name: str) -> WordTokenizer:
    """The tokenizer of a worker, loaded once; ``name`` is a path or a file of the public tokenizers."""
    if name not in _loaded:
        path = name
        if not os.path.isabs(name):
            import public_tokenizers
            path = public_tokenizers.path(name)
        _loaded[name] = WordTokenizer(path)
    return _loaded[name]


# ---- the grammar --------------------------------------------------------------------------

def _pairs(left: np.ndarray, right: np.ndarray, symbols: int) -> np.ndarray:
    """Each pair as one number, of 32 bits if symbols have 16."""
    if symbols <= 1 << 16:
        return left.astype(np.uint32) << np.uint32(16) | right.astype(np.uint32)
    return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)


def _frequent(pairs: np.ndarray, least: int, band: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs seen ``least`` times or more, and at least 1/``band`` as often as the fullest hash bucket, with
    their counts, most frequent first.  If there is none so frequent, all that are seen ``least`` times."""
    # A pair is at most as frequent as its bucket, so only pairs of full buckets are sorted.
    kind = pairs.dtype.type
    bucket = (pairs * kind(0x9E3779B97F4A7C15 >> (64 - 8 * pairs.itemsize)) >> kind(8 * pairs.itemsize - 18)).astype(np.int64)
    sizes = np.bincount(bucket, minlength=1 << 18)
    for floor in dict.fromkeys((max(least, int(sizes.max()) // band), least)):
        found = np.sort(pairs[(sizes >= floor)[bucket]])
        starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
        counts = np.diff(np.append(starts, len(found)))
        keep = counts >= floor
        if keep.any():
            break
    found, counts = found[starts[keep]], counts[keep]
    order = np.lexsort([found, -counts])
    return found[order], counts[order]


def _choose(pairs: list[int], bits: int) -> list[int]:
    """Pairs to replace at once, by falling count: no symbol is the left one of some and the right one of
    others, so two chosen pairs never overlap (a pair of equal symbols only overlaps itself)."""
    role: dict[int, int] = {}
    chosen, low = [], (1 << bits) - 1
    for p in pairs:
        a, b = p >> bits, p & low
        if a == b:
            if a not in role:
                role[a] = 3
                chosen.append(p)
        elif role.get(a, 1) == 1 and role.get(b, 2) == 2:
            role[a], role[b] = 1, 2
            chosen.append(p)
    return chosen


def repair(ids: np.ndarray, min_pairs: int = MIN_PAIRS, band: int = BAND) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(alphabet, left, right, symbols)``: the ids in use, the rules and what is left of ``ids``.

    Symbol s is the id ``alphabet[s]``, or rule ``s - len(alphabet)``.  A round replaces the most frequent
    pairs and those about 1/``band`` as frequent that can't overlap them, each from left to right; rounds
    end when no pair occurs ``min_pairs`` times."""
    alphabet, seq = np.unique(ids), np.zeros(0, np.uint32)
    if len(ids):
        place = np.zeros(int(alphabet[-1]) + 1, np.uint32)      # as long as the vocabulary
        place[alphabet] = np.arange(len(alphabet), dtype=np.uint32)
        seq = place[ids]
    lefts, rights, top = [], [], len(alphabet)
    while len(seq) > 1:
        pairs = _pairs(seq[:-1], seq[1:], top)
        bits = 8 * pairs.itemsize // 2
        found, _ = _frequent(pairs, max(2, min_pairs), band)
        if not len(found):
            break
        order = np.sort(np.array(_choose(found.tolist(), bits), pairs.dtype))
        left, right = order >> pairs.dtype.type(bits), order & pairs.dtype.type((1 << bits) - 1)
        begins, ends = np.zeros(top, bool), np.zeros(top, bool)
        begins[left], ends[right] = True, True
        at = np.flatnonzero(begins[seq[:-1]] & ends[seq[1:]])
        place = np.minimum(np.searchsorted(order, pairs[at]), len(order) - 1)
        hit = order[place] == pairs[at]
        at, place = at[hit], place[hit]
        same = seq[at] == seq[at + 1]
        if same.any():                      # a run of one symbol: every second place of it
            idx = np.arange(len(at))
            head = np.ones(len(at), bool)
            head[1:] = (at[1:] != at[:-1] + 1) | ~same[1:] | ~same[:-1] | (seq[at[1:]] != seq[at[:-1]])
            first = np.maximum.accumulate(np.where(head, idx, 0))
            keep = ~same | ((idx - first) % 2 == 0)
            at, place = at[keep], place[keep]
        lefts.append(left.astype(np.uint32))
        rights.append(right.astype(np.uint32))
        seq[at] = (top + place).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        top += len(order)
    none = np.zeros(0, np.uint32)
    return alphabet.astype(np.uint32), np.concatenate([none, *lefts]), np.concatenate([none, *rights]), seq


class Shard:
    """A shard read from bytes; ids are expanded on demand."""

    def __init__(self, raw: memoryview, at: int = 0):
        magic, width, docs, self.base, rules, symbols, self.more, self.ids = HEAD.unpack_from(raw, at)
        if magic != b"RPR1":
            raise ValueError("not a shard of token ids")
        at += HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out
        symbol = f"<u{width}"
        self.doc_ids, self.doc_lengths = take("<i8", docs), take("<u4", docs)
        self.alphabet = take("<u4", self.base)
        self.left, self.right, self.lengths = take(symbol, rules), take(symbol, rules), take("<u4", rules)
        self.symbols = take(symbol, symbols)
        self.end = at + 1                   # the line feed
        self._made: tuple | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expansions of all ids in use and rules in one array, with the start and length of each."""
        if self._made is None:
            lengths = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
            starts = np.cumsum(lengths) - lengths
            store = np.zeros(int(lengths.sum()), np.uint32)
            store[:self.base] = self.alphabet
            left, right = self.left.astype(np.int64), self.right.astype(np.int64)
            done, rules = 0, len(left)
            highest = np.maximum.accumulate(np.maximum(left, right)) if rules else left
            while done < rules:             # rules whose symbols are all made, at once
                upto = max(int(np.searchsorted(highest, self.base + done, "left")), done + 1)
                part = slice(done, upto)
                both = np.stack([left[part], right[part]], 1).ravel()
                out = _gather(store, starts[both], lengths[both])
                store[starts[self.base + done]:starts[self.base + done] + len(out)] = out
                done = upto
            self._made = store, starts, lengths
        return self._made

    def decode(self) -> np.ndarray:
        """All ids of the shard."""
        store, starts, lengths = self._expansions()
        symbols = self.symbols.astype(np.int64)
        return _gather(store, starts[symbols], lengths[symbols])

    def decode_range(self, begin: int, end: int) -> np.ndarray:
        """The ids from ``begin`` to ``end`` (exclusive): only symbols that cover them are expanded, down the rules."""
        size = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
        pair = np.stack([self.left, self.right], 1).astype(np.int64)
        stops = np.cumsum(size[self.symbols])
        first, last = np.searchsorted(stops, begin, "right"), np.searchsorted(stops, end, "left")
        part = self.symbols[first:last + 1].astype(np.int64)
        skip = begin - (int(stops[first - 1]) if first else 0)
        while (part >= self.base).any():
            both = np.stack([part, np.full(len(part), -1)], 1)
            rule = part >= self.base
            both[rule] = pair[part[rule] - self.base]
            part = both[both >= 0]
            before = np.cumsum(size[part]) - size[part]
            keep = (before + size[part] > skip) & (before < skip + end - begin)
            part, skip = part[keep], skip - int(before[np.argmax(keep)])
        return self.alphabet[part[skip:skip + end - begin]]


def shard_bytes(ids: np.ndarray, doc_ids: list[int], doc_lengths: list[int], more: bool) -> bytes:
    """A shard without its line feed."""
    alphabet, left, right, symbols = repair(ids)
    base = len(alphabet)
    lengths = np.ones(base + len(left), np.int64)
    done, rules = 0, len(left)
    highest = np.maximum.accumulate(np.maximum(left, right)) if rules else left
    while done < rules:
        upto = max(int(np.searchsorted(highest, base + done, "left")), done + 1)
        lengths[base + done:base + upto] = lengths[left[done:upto]] + lengths[right[done:upto]]
        done = upto
    width = 2 if base + rules <= 1 << 16 else 4
    kind = f"<u{width}"
    return b"".join([HEAD.pack(b"RPR1", width, len(doc_ids), base, rules, len(symbols), int(more), len(ids)),
                     np.array(doc_ids, "<i8").tobytes(), np.array(doc_lengths, "<u4").tobytes(), alphabet.astype("<u4").tobytes(),
                     left.astype(kind).tobytes(), right.astype(kind).tobytes(), lengths[base:].astype("<u4").tobytes(), symbols.astype(kind).tobytes()])


class Shards:
    """Cuts a stream of documents into shards of ``size`` ids; a document may go on in the next shard."""

    def __init__(self, size: int):
        self.size, self.parts, self.docs, self.lengths, self.n = size, [], [], [], 0

    def _close(self, more: bool) -> bytes:
        out = shard_bytes(np.frombuffer(b"".join(self.parts), "<u4"), self.docs, self.lengths, more)
        self.parts, self.docs, self.lengths, self.n = [], [], [], 0
        return out

    def add(self, doc: int, ids: bytes) -> Iterator[bytes]:
        at, view = 0, memoryview(ids)
        while at < len(ids):
            part = view[at:at + 4 * (self.size - self.n)]
            at += len(part)
            self.parts.append(part)
            self.docs.append(doc)
            self.lengths.append(len(part) // 4)
            self.n += len(part) // 4
            if self.n == self.size:
                yield self._close(at < len(ids))

    def rest(self) -> Iterator[bytes]:
        if self.n:
            yield self._close(False)


# ---- files --------------------------------------------------------------------------------

def write_ids(docs: DataFrame, folder: str, name: str = TOKENIZER, end: int = END, shard_ids: int = SHARD_IDS,
              file_bytes: int = FILE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text, each ended by ``end``, into files of ``folder`` in the order of ``doc_id``.

    A null text is empty; a null id comes last; rows that repeat an id follow one another (by a hash of
    their text), documents each.  A row of any id may go to any of several files, so a hot id is split."""
    rows = docs.select(id_key(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    files = max(-(-int(total) // file_bytes), docs.sparkSession.sparkContext.defaultParallelism)
    order = ["doc_id", "_hash", "_row"]
    rows = rows.select("*", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))

    def written(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, out, tail = tokenizer(name), Shards(shard_ids), np.array([end], "<u4").tobytes()
        wrap = lambda shard: pa.RecordBatch.from_arrays([pa.array([shard], pa.binary())], ["shard"])
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(ids), 2048):
                for doc, found in zip(ids[at:at + 2048], encode.batch(texts[at:at + 2048].to_pylist())):
                    yield from map(wrap, out.add(doc, found + tail))
        yield from map(wrap, out.rest())
    # The text sink writes bytes as they are, each shard ended by a line feed, on any file system of Spark.
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text") \
        .mapInArrow(written, "shard binary").select(F.col("shard").cast("string").alias("value")).write.text(folder)


def shards(content: bytes) -> Iterator[Shard]:
    """The shards of a file, one after another."""
    at, view = 0, memoryview(content)
    while at < len(view):
        shard = Shard(view, at)
        yield shard
        at = shard.end


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")


def file_starts(spark: SparkSession, folder: str) -> dict[str, int]:
    """The place of every file's first id in the order of all ids, from the shards' heads.

    One number per file (of ``FILE_BYTES`` text) is held by the driver, as is the list of files."""
    def counted(batches):
        for batch in batches:
            n = [sum(s.ids for s in shards(c.as_buffer())) for c in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("path").cast(pa.string()), pa.array(n, pa.int64())], ["path", "ids"])
    part = lambda path: int(re.search(r"part-(\d+)", path.rsplit("/", 1)[1]).group(1))
    starts, at = {}, 0
    for path, n in sorted(((r["path"], r["ids"]) for r in _files(spark, folder).mapInArrow(counted, "path string, ids bigint").collect()),
                          key=lambda r: part(r[0])):
        starts[path], at = at, at + n
    return starts


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files, and ``ids`` if asked for."""
    starts = spark.sparkContext.broadcast(file_starts(spark, folder))
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 4 + [pa.binary()] * with_ids

    def table(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(names), kinds)], names)

    def decoded(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                at, crc, n, parts = starts.value[path], 0, 0, []
                for shard in shards(content.as_buffer()):
                    ids, stop, out = shard.decode().astype("<u4").tobytes(), 0, []
                    last = len(shard.doc_ids) - 1
                    for i, (doc, length) in enumerate(zip(shard.doc_ids.tolist(), shard.doc_lengths.tolist())):
                        part, stop = ids[stop:stop + 4 * length], stop + 4 * length
                        crc, n = zlib.crc32(part, crc), n + length
                        if with_ids:
                            parts.append(part)
                        if i < last or not shard.more:
                            out.append((doc, at, n, crc, b"".join(parts))[:len(names)])
                            at, crc, n, parts = at + n, 0, 0, []
                    yield table(out)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return _files(spark, folder).mapInArrow(decoded, schema).withColumn("doc_id", id_back("doc_id"))


def encoded_documents(docs: DataFrame, name: str = TOKENIZER, end: int = END) -> DataFrame:
    """Write the ids of all documents (see ``write_ids``) into the shared checkpoint folder and read them back.

    One row per row of ``docs``; an empty table gives an empty result.  Other columns are not read."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    write_ids(docs, folder, name, end)
    return read_ids(spark, folder)
