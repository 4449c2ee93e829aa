"""Comment moderation (X12, X13, J24): a word list checked against whole comment texts.

One list serves both passes.  Pass 1 looks the last comma-separated token up in it; pass 2
finds every listed word anywhere in the text.  A list in code is a literal of the plan; a table of words
of any length is joined by k-grams: the k-grams of each text, where k is the length of the shortest
word, meet the words' beginnings, and what meets is verified against the text.  Tables of up to
SHARED_BYTES go to every task, where texts meet them as they are read; for longer ones the distinct
k-grams of the texts are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARED_BYTES = 8 << 20      # of the words (and 16 for each) that are sent to every task
SLOT_BITS, PLACES = 20, 1 << 18     # of the table of codes; places of a batch's texts that are looked up at once
SALTS = 8       # tasks that share a frequent k-gram; the word table is copied as often


def last_token(text) -> Column:
    """last comma-separated token, trimmed."""
    t = F.col(text) if isinstance(text, str) else text
    return F.trim(F.element_at(F.split(t, ","), -1))


def find_words(text: Column, words: Sequence[str]) -> Column:
    """The words that ``text`` contains, in list order."""
    arr = F.array(*[F.lit(w) for w in words]).cast("array<string>")
    return F.coalesce(F.filter(arr, lambda w: F.contains(text, w)), F.array().cast("array<string>"))


def word_list(words: Sequence[str]) -> list[str]:
    """The distinct non-empty words in list order."""
    return list(dict.fromkeys(w for w in words if w))


def words_met(texts: DataFrame, words: Sequence[str]) -> Callable[[Column], Column]:
    """The words that a text contains, in text order (null: none).

    The first k bytes of every word, at most eight, are a number, and so are those from every place of a batch of texts on;
    where these are equal within a text, the text is searched for the words that begin so."""
    listed = [w.encode("utf-8") for w in words]
    k = min([8, *map(len, listed)])
    begin = {}
    for w in listed:
        begin.setdefault(int.from_bytes(w[:k], "big"), []).append(w)
    codes = np.array(sorted(begin), np.uint64)
    held = texts.sparkSession.sparkContext.broadcast((k, codes, [begin[int(c)] for c in codes]))
    slot = lambda code: (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)

    def pairs(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of a text times the count of codes, plus the place of a code that occurs in it: each once."""
        k, codes, _ = held.value
        taken = np.zeros(1 << SLOT_BITS, bool)
        taken[slot(codes)] = True
        out = [np.empty(0, np.int64)]
        for start in range(int(ends[0]), int(ends[-1]) - k + 1, PLACES):
            n = min(PLACES, int(ends[-1]) - k + 1 - start)
            code = np.zeros(n, np.uint64)
            for j in range(start, start + k):
                code <<= np.uint64(8)
                code |= data[j:j + n]
            at = np.flatnonzero(taken[slot(code)])
            which = np.minimum(np.searchsorted(codes, code[at]), len(codes) - 1)
            same = codes[which] == code[at]
            at, which = at[same] + start, which[same]
            text = np.searchsorted(ends, at, side="right") - 1
            within = at + k <= ends[text + 1]
            out.append(np.unique(text[within] * len(codes) + which[within]))
        return np.unique(np.concatenate(out))

    def found(column: pa.Array) -> pa.Array:
        k, codes, words = held.value
        column = column.cast(pa.large_binary()).fill_null(b"")
        out = [[] for _ in range(len(column))]
        _, ends, data = column.buffers()
        if len(column) and len(codes) and data is not None:
            ends = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
            last, whole = -1, b""
            for pair in pairs(np.frombuffer(data, np.uint8), ends).tolist():
                text, which = divmod(pair, len(codes))
                if text != last:
                    last, whole = text, column[text].as_py()
                out[text] += [w for w in words[which] if len(w) == k or w in whole]
        return pa.array([sorted(x) for x in out], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
    return F.arrow_udf(found, "array<string>")


def words_in(texts: DataFrame, text_col: str, words: DataFrame) -> DataFrame:
    """``(_key, found)``: of every distinct text that holds words of the table (column ``word``), those words in text order.

    ``_key`` is the SHA-256 of the text.  Blank, null and repeated words count for nothing."""
    listed = words.select("word").where("word <> ''").distinct()
    k = listed.agg(F.min(F.length("word")).alias("k")).first()["k"] or 1
    own = texts.select(F.col(text_col).alias("_text")).where("_text is not null").select(F.sha2(F.col("_text"), 256).alias("_key"), "_text") \
        .groupBy("_key").agg(F.any_value("_text").alias("_text"))
    salt = F.pmod(F.xxhash64("_key"), F.lit(SALTS))
    # a look-ahead yields the k characters from every place on
    grams = own.select("_key", salt.alias("_salt"), F.explode(F.array_distinct(F.regexp_extract_all("_text", F.lit(f"(?s)(?=(.{{{k}}}))"), 1))).alias("_gram"))
    heads = listed.select("word", F.substring("word", 1, k).alias("_gram"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("_salt"))
    met = grams.join(heads, ["_gram", "_salt"]).groupBy("_key").agg(F.array_sort(F.collect_set("word")).alias("_met"))
    found = F.filter("_met", lambda w: F.contains(F.col("_text"), w))
    return own.join(met, "_key").select("_key", found.alias("found")).where(F.size("found") > 0)


def moderate(comments: DataFrame, text_col: str, words: Sequence[str] | DataFrame) -> DataFrame:
    """Add violation (0/1), grade ('P0', 'P1' or '') and the matched words.

    Pass 1 (X12): the last comma token is on the list -> 1, P0, that word.
    Pass 2 (X13, intent): otherwise any listed word in the whole text -> 1, P1,
    the words joined by ', '.  Blank and repeated words of the list count for nothing.
    ``words`` is a list, or a table (column ``word``, in text order) of any length; both give the same rows."""
    if isinstance(words, DataFrame):
        listed = words.select("word").where("word <> ''").distinct()
        size = listed.agg(F.sum(F.octet_length("word") + 16)).first()[0] or 0
        if size <= SHARED_BYTES:
            rows = comments.withColumn("found", words_met(comments, [r["word"] for r in listed.collect()])(F.col(text_col)))
        else:
            rows = comments.withColumn("_key", F.sha2(F.col(text_col), 256)).join(words_in(comments, text_col, words), "_key", "left")
        found = F.coalesce(F.col("found"), F.array().cast("array<string>"))
    else:
        rows, found = comments, find_words(F.col(text_col), word_list(words))
    last = last_token(text_col)
    p0 = F.coalesce(F.array_contains(found, last), F.lit(False))      # the last token is part of the text
    return rows.select(
        *[F.col(x) for x in comments.columns],
        F.when(F.size(found) > 0, 1).otherwise(0).alias("violation"),
        F.when(p0, "P0").when(F.size(found) > 0, "P1").otherwise("").alias("grade"),
        F.when(p0, last).when(F.size(found) > 0, F.array_join(found, ", ")).otherwise("").alias("words"))
