"""Language identification in two steps: the family first, then the language within it.

Texts become counts of hashed byte n-grams of their lower-cased letters.  One linear support
vector machine per family (against the rest) picks the family; inside a family every pair of
languages has one that votes.  All machines are trained here on a bounded sample.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_name

DIMENSIONS = 4096
SEGMENT = 1 << 18             # characters turned into counts at once
SAMPLE_PER_LANGUAGE = 250     # training documents of a language, in expectation
MAX_LANGUAGES = 256
# A document stays in the pipeline from this share of the usual score on (the median score of the
# model's own training documents, so that the number of languages doesn't matter).  Documents of
# check_s score 0.32 and more, a guess among two families of two languages about 0.25.
MIN_SCORE = 0.3
# Families of languages by ISO 639-1 code; a language that is not listed is its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}
_ASCII_LETTER = re.compile("[A-Za-z]")
# Bytes of letters stay (all bytes of non-ASCII characters too); the rest of ASCII is a gap.
_GAPS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), f"only {lang}")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def features(text: str) -> np.ndarray:
    """Square-rooted counts of hashed 1-, 2- and 3-grams, of unit length."""
    counts = np.zeros(DIMENSIONS)
    for at in range(0, len(text), SEGMENT):   # a segment also sees the two characters before it
        b = np.frombuffer(b" " + text[max(0, at - 2):at + SEGMENT].lower().encode().translate(_GAPS) + b" ", np.uint8)
        b = b.astype(np.uint32)
        for codes in (b, b[:-1] | b[1:] << 8, b[:-2] | b[1:-1] << 8 | b[2:] << 16):
            counts += np.bincount((codes * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS)
    root = np.sqrt(counts)
    return root / (np.linalg.norm(root) or 1.0)


# ---- training -----------------------------------------------------------------------------

def train_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 20, seed: int = 7) -> np.ndarray:
    """Weights of a linear support vector machine (squared hinge, dual coordinate descent); y is +-1.
    The last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, alpha, rng = np.zeros(x.shape[1]), np.zeros(len(x)), np.random.default_rng(seed)
    square = (x * x).sum(axis=1) + 1 / (2 * c)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            step = max(alpha[i] - (y[i] * (w @ x[i]) - 1 + alpha[i] / (2 * c)) / square[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
    return w


@dataclass
class Model:
    families: list[str]
    family_w: np.ndarray                        # a row for each family; one family: none
    languages: dict[str, list[str]]             # of each family
    pairs: dict[tuple[str, str], np.ndarray]    # positive side: the first language
    usual: float = 1.0                          # median score of the training documents

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        v = np.append(x, 1.0)
        squash = lambda m: 1.0 / (1.0 + np.exp(-4.0 * np.clip(m, -50, 50)))
        if len(self.families) > 1:
            p = squash(self.family_w @ v)
            at, sure = int(p.argmax()), float(p.max() / p.sum())
        else:
            at, sure = 0, 1.0
        langs = self.languages[self.families[at]]
        votes, trust = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
        for i, a in enumerate(langs):
            for b in langs[i + 1:]:
                p = float(squash(self.pairs[a, b] @ v))
                votes[a if p >= 0.5 else b] += 1
                trust[a] += p
                trust[b] += 1 - p
        best = max(langs, key=lambda k: (votes[k], trust[k]))
        within = trust[best] / (len(langs) - 1) if len(langs) > 1 else 1.0
        return best, min(1.0, max(0.0, sure * within))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, text_col: str = "text",
          lang_col: str = "lang", order_col: str = "doc_id") -> Model | None:
    """A model of all languages of ``docs``, from about ``per_language`` documents of each.

    The sample is by hash of ``order_col``, the same in every run.  Rows without language or
    letters are left out; None if nothing is left.  More than MAX_LANGUAGES languages are an error,
    not cut off."""
    rows = docs.select(F.col(order_col).alias("k"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return None
    place = F.pmod(F.xxhash64("k", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    chance = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, per_language / n))) for k, n in counts.items()])

    def counted(batches):
        for batch in batches:
            kept = [(lang, features(t).astype(np.float32).tobytes())
                    for t, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.string()),
                                              pa.array([f for _, f in kept], pa.binary())], ["lang", "x"])
    sample = rows.where(place < chance).select("text", "lang").mapInArrow(counted, "lang string, x binary").collect()
    sample.sort(key=lambda r: (r["lang"], r["x"]))
    if not sample:
        return None
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in sample]).astype(np.float64)
    lang = np.array([r["lang"] for r in sample])
    fam = np.array([family_of(k) for k in lang])
    families = sorted(set(fam.tolist()))
    languages = {f: sorted(set(lang[fam == f].tolist())) for f in families}
    family_w = np.stack([train_svm(x, np.where(fam == f, 1.0, -1.0)) for f in families]) if len(families) > 1 else np.zeros((0, 0))
    pairs = {}
    for langs in languages.values():
        for i, a in enumerate(langs):
            for b in langs[i + 1:]:
                at = (lang == a) | (lang == b)
                pairs[a, b] = train_svm(x[at], np.where(lang[at] == a, 1.0, -1.0))
    model = Model(families, family_w, languages, pairs)
    model.usual = float(np.median([model.predict(row)[1] for row in x]))
    return model


# ---- prediction ---------------------------------------------------------------------------

def predict_column(model: Model | None, docs: DataFrame, text: str | Column) -> Column:
    """A struct (lang, score) of a text column, by ``model``; ``und`` and 0 without letters or model."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pa.Array) -> pa.Array:
        out = [held.value.predict(features(t)) if held.value and has_letter(t) else ("und", 0.0) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([o[0] for o in out], pa.string()),
                                           pa.array([o[1] for o in out], pa.float64())], ["lang", "score"])
    return F.arrow_udf(predict, "lang string, score double")(text)


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row of ``docs``, learnt from the rows that
    are not held out.  Texts that are null, empty or without a letter are ``und`` with score 0, as
    is every text where no labelled row can be learnt from.  Rows that repeat are predicted each;
    predictions use the text alone, the whole of it."""
    model = train(docs.where(~held_out()))
    out = docs.select("doc_id", held_out().alias("held_out"), predict_column(model, docs, F.col("text").cast("string")).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def with_letters(docs: DataFrame) -> DataFrame:
    def lettered(texts: pa.Array) -> pa.Array:
        return pa.array([has_letter(t) for t in texts.to_pylist()], pa.bool_())
    return docs.where(F.arrow_udf(lettered, "boolean")(F.col("text").cast("string")))


def with_language(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language can be told: rejected are ``und`` and scores below ``min_score``
    times the usual score of the model.

    Where no labelled row can be learnt from, nothing can be told of any document, so all that have
    a letter stay."""
    name = free_name(docs, "_language")
    model = train(docs.where(~held_out()))
    if model is None:
        return with_letters(docs)
    out = docs.withColumn(name, predict_column(model, docs, F.col("text").cast("string")))
    return out.where((F.col(name)["lang"] != "und") & (F.col(name)["score"] >= min_score * model.usual)).drop(name)
