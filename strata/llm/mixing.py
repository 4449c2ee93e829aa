"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame functions only).

Sources get target words by weight, stopped at ``cap`` times what they have.  Targets become
integer numbers of equal blocks, given to sources, and within a source to its shards, by
highest quotients ``votes / (2 seats + 1)``.  A shard is a stream of its documents in seeded
order, cut into blocks; it gives all its blocks as often as its quota holds them and the rest
of the quota as a run of blocks from a seeded start.  Since a run is an interval, what a
document gives is arithmetic on its place in the stream: no row is made per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, sized_broadcast

WORD = r"[^\x20\x09-\x0D]+"
SHARD_DOCS = 1024         # documents of a shard, until MAX_SHARDS shards are reached
MAX_SHARDS = 1 << 20
BLOCK_WORDS = 16
SMALL_ROWS = 100_000      # catalogue rows that may be broadcast


def n_words(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def sainte_lague(parties: DataFrame, group: Sequence[str], votes: str, total: str, seats: str,
                 order: Sequence[str], out: str) -> DataFrame:
    """``parties`` with the integer column ``out``: the ``seats`` of each group, given by highest quotients.

    ``total`` holds the group's sum of votes.  With P parties no one can end outside the counts
    at divisors total / (seats +- P / 2), so only those seats are ranked: about 4 P rows in all.
    Equal quotients go in the order of ``order``.  Parties without votes get none."""
    g, v = Window.partitionBy(*group), F.col(votes)
    p = F.count(F.when(v > 0, 1)).over(g)
    ranged = parties.withColumn("_lo", F.when(v > 0, F.floor(v * (F.col(seats) - p / 2) / F.col(total) + 0.5) - 1)) \
        .withColumn("_lo", F.greatest(F.lit(0).cast("bigint"), F.coalesce("_lo", F.lit(0).cast("bigint")))) \
        .withColumn("_hi", F.when(v > 0, F.floor(v * (F.col(seats) + p / 2) / F.col(total) + 0.5) + 1)) \
        .withColumn("_left", F.col(seats) - F.sum("_lo").over(g))
    asked = ranged.where("_hi > _lo").select(
        *group, *order, "_left", F.explode(F.sequence(F.col("_lo"), F.col("_hi") - 1)).alias("_seat"), v.alias("_v"))
    ranked = asked.withColumn("_rank", F.row_number().over(
        Window.partitionBy(*group).orderBy(F.desc(F.col("_v") / (2 * F.col("_seat") + 1)), *order, "_seat")))
    won = ranked.where("_rank <= _left").groupBy(*group, *order).agg(F.count("*").alias("_won"))
    keys = [*group, *order]
    return ranged.join(won, keys, "left").withColumn(out, F.col("_lo") + F.coalesce("_won", F.lit(0).cast("bigint"))) \
        .drop("_lo", "_hi", "_left", "_won")


def _source_targets(sized: DataFrame, weights: Sequence[float], share: float, cap: float, block_words: int,
                    shard_docs: int) -> DataFrame:
    """One row per source: place, size, target, shards, seats.  Windows here see one row per source."""
    src = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    src = src.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    src = src.withColumn("weight", weight).withColumn("most", cap * F.col("source_size")) \
        .withColumn("all_words", share * F.sum("source_size").over(every))
    # Water level: with sources by the level at which they are full, the level if all before one
    # are full rises up to the first that is not full and falls after it, so its maximum is the level.
    fill = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before, upto = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("all_words") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(upto)
    src = src.withColumn("level", level).withColumn("level", F.max("level").over(every))
    src = src.withColumn("target", F.least("most", F.col("level") * F.col("weight")))
    per_shard = F.greatest(F.lit(shard_docs).cast("double"), F.ceil(F.sum("docs").over(every) / MAX_SHARDS).cast("double"))
    src = src.withColumn("shards", F.ceil(F.col("docs") / per_shard)) \
        .withColumn("all_seats", F.round(F.col("all_words") / block_words).cast("bigint")) \
        .withColumn("one", F.lit(1))
    return sainte_lague(src, ["one"], "target", "all_words", "all_seats", ["place"], "seats").select(
        "source", "place", "source_size", "target", "shards", "seats")


def mix(rows: DataFrame, sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: int = 2,
        block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, seed: int = 7) -> DataFrame:
    """``rows`` (doc_id, source, size and any payload) with what the mix takes of each.

    Adds ``source_size``, ``target``, ``taken`` (words, repeats counted), ``whole`` (times the
    whole document is taken) and ``a1, b1, a2, b2`` (word ranges taken once more; empty: equal).
    ``sized`` has the same doc_id, source and size and is read for the sums.  Sources go in code
    point order, null last, with ``weights`` repeating; all targets sum to ``share`` of all words;
    a target stops at ``cap`` times its source's words and the excess is shared anew by weight.
    A document without words gives none; rows of equal doc_id, source and size are
    interchangeable; an empty table gives an empty result; reruns agree."""
    src = cut(_source_targets(sized, weights, share, cap, block_words, shard_docs))
    src = sized_broadcast(src, src.count(), SMALL_ROWS)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    number = F.conv(F.substring("seeded", 1, 8), 16, 10).cast("bigint")

    def placed(df):
        df = df.withColumn("seeded", key).withColumnRenamed("source", "_s")
        df = df.join(src, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
        return df.withColumn("shard", number % F.col("shards"))

    shard = ["place", "shard"]
    shards = placed(sized).groupBy(*shard).agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"), F.first("seats").alias("seats"))
    shards = shards.where("shard_size > 0").withColumn("votes", F.col("target") * F.col("shard_size") / F.col("source_size"))
    shards = sainte_lague(shards, ["place"], "votes", "target", "seats", ["shard"], "quota")
    blocks = F.ceil(F.col("shard_size") / block_words)
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("start"), "place", "shard").cast("binary")),
                               1, 8), 16, 10).cast("bigint")
    shards = shards.withColumn("blocks", blocks).withColumn("quota", F.least(F.col("quota"), cap * F.col("blocks"))) \
        .withColumn("whole", F.floor(F.col("quota") / F.col("blocks"))) \
        .withColumn("more", F.col("quota") - F.col("whole") * F.col("blocks")) \
        .withColumn("start", start % F.col("blocks")) \
        .select(*shard, "shard_size", "whole",
                (F.col("start") * block_words).alias("from1"),
                (F.least(F.col("start") + F.col("more"), "blocks") * block_words).alias("to1"),
                (F.greatest(F.lit(0).cast("bigint"), F.col("start") + F.col("more") - F.col("blocks")) * block_words).alias("to2"))
    stream = Window.partitionBy(*shard).orderBy("seeded", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    out = placed(rows).withColumn("at", F.sum("size").over(stream) - F.col("size")).join(shards, shard, "left")
    size, at, zero = F.col("size"), F.col("at"), F.lit(0).cast("bigint")

    def within(c):  # a place of the shard's stream as a place in the document
        return F.coalesce(F.least(F.greatest(c - at, zero), size), zero)
    out = out.withColumn("whole", F.coalesce("whole", zero)) \
        .withColumn("a1", within(F.col("from1"))).withColumn("b1", within(F.col("to1"))) \
        .withColumn("a2", zero).withColumn("b2", within(F.col("to2")))
    out = out.withColumn("taken", F.col("whole") * size + F.col("b1") - F.col("a1") + F.col("b2") - F.col("a2"))
    return out.drop("at", "seeded", "place", "shards", "seats", "shard", "shard_size", "from1", "to1", "to2")


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` of every document (see ``mix``)."""
    sized = cut(docs.select(F.col("doc_id"), F.col("source"), n_words("text").alias("size")))
    return mix(sized, sized, **options).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for every time a document is taken.

    Whole takes keep the text; a part is the taken words with the white space before each.
    ``n_chars``, if there, is that of the text.  Documents of which nothing is taken (all
    without words among them) are left out."""
    size = n_words("text").alias("size")
    rows = docs.select("doc_id", "source", size, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    out = mix(rows, docs.select("doc_id", "source", size), **options)
    chunks = F.regexp_extract_all(F.col("row.text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))

    def words(c, a, b):
        return F.slice(c, (F.col(a) + 1).cast("int"), (F.col(b) - F.col(a)).cast("int"))
    part = F.array_join(F.flatten(F.array(words(chunks, "a2", "b2"), words(chunks, "a1", "b1"))), "")
    extra = F.col("taken") - F.col("whole") * F.col("size")
    texts = F.concat(F.array_repeat(F.col("row.text"), F.col("whole").cast("int")),
                     F.when(extra == F.col("size"), F.array(F.col("row.text")))
                     .when(extra > 0, F.array(part)).otherwise(F.array().cast("array<string>")))
    out = out.where("taken > 0").select("row", F.explode(texts).alias("mixed"))
    cols = []
    for c in docs.columns:
        new = {"text": F.col("mixed"), "n_chars": F.length("mixed").cast(dict(docs.dtypes)[c])}.get(c)
        cols.append(F.col("row").getField(c).alias(c) if new is None else new.alias(c))
    return out.select(*cols)
