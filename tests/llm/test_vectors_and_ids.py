"""Whitening, vector codes and token-id files against brute force and exact round trips."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import queries, token_grammar, vector_code, whitening
from strata.llm.common import table

SF = "/root/testdata/sf0.001"
VECS = "vec_id bigint, embedding array<double>, label string"


def odd_vectors(spark):
    """Nulls in every column, unfit entries, repeated ids and vectors, two lengths, an empty vector, clashing extra columns."""
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist(), "ab"[i % 2]) for i in range(20)]
    rows += [(3, rows[4][1], "a"), (3, rows[4][1], "a"), (None, rows[0][1], None), (None, rng.normal(size=8).tolist(), ""),
             (50, None, "a"), (51, [1.0, None] * 4, "a"), (52, [nan] * 8, "a"), (53, [inf] * 8, "a"), (54, [1e300] * 8, "a"), (55, [], "a"),
             (60, [1.0, 2.0, 3.0], "a"), (61, [2.0, 2.0, 3.5], None), (62, [2.0, 2.0, 3.5], "a"), (70, [1.0], "z")]
    return spark.createDataFrame(rows, VECS).selectExpr("*", "1 as id", "2 as x", "3 as dims", "4 as _n", "5 as state", "6 as _label", "7 as part")


# ---- 11 whitening -------------------------------------------------------------------------

@pytest.mark.parametrize("d,n", [(1, 4), (2, 2), (6, 5), (6, 300), (40, 200)])
def test_spectrum_equals_scatter(d, n):
    rng = np.random.default_rng(d + n)
    x = np.floor(64 * rng.normal(size=(n, d)) * np.linspace(0.1, 1, d))
    x[-1] = x[0]
    whole, a, b = (whitening.Spectrum.empty(d) for _ in range(3))
    for i, row in enumerate(x):
        whole.add(row)
        (a if i < n // 3 else b).add(row)
    b.combine(a)
    scatter = (x - x.mean(0)).T @ (x - x.mean(0))
    for s in (whole, b):
        assert s.n == n or s is b
        assert np.allclose(s.basis @ np.diag(s.values) @ s.basis.T, scatter, atol=1e-9 * max(1.0, np.abs(scatter).max()))
        assert np.allclose(s.basis.T @ s.basis, np.eye(d), atol=1e-10) and (np.diff(s.values) >= 0).all()


def whitened_by_hand(x, k=16):
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    off = fit - sums / n
    cov = off.T @ off / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    some = e > 1e-12 * np.trace(cov)
    w = (x - sums / n) @ q * np.where(some, 1 / np.sqrt(np.where(some, e, 1)), 0)
    share = np.where(some, e, 0) / np.trace(cov) if np.trace(cov) > 0 else np.zeros(len(e))
    return n, [int(v) for v in ((n * x - sums) ** 2).sum(1)], w, share


def check_whitened(rows, vectors):
    """``rows`` of (vec_id, component, ...) against ``vectors`` {key: x rows} of one length."""
    x = np.array([v for _, v in vectors])
    n, off, w, share = whitened_by_hand(x)
    got = np.zeros_like(w)
    used = {}
    for i, (key, _) in enumerate(vectors):
        mine = sorted((r for r in rows if r["vec_id"] == key and r["deviation"] == off[i]), key=lambda r: r["component"])
        k = w.shape[1]
        assert len(mine) % k == 0 and mine
        used[(key, off[i])] = len(mine)
        got[i] = [mine[j * (len(mine) // k)]["whitened"] for j in range(k)]
        assert {r["n"] for r in mine} == {n}
        assert np.allclose([r["explained"] for r in mine[::len(mine) // k]], share, atol=1e-12)
    assert sum(used.values()) == len(rows) == w.size
    sign = np.sign((got * w).sum(0))
    assert np.allclose(got * np.where(sign == 0, 1, sign), w, atol=1e-7)
    assert max(r["identity_error"] for r in rows) < 1e-9


def test_whitening_of_the_table(spark):
    df = table(spark, SF, "embeddings")
    x = [(r["vec_id"], np.floor(64 * np.array(r["embedding"], float)).astype(np.int64) + 10 ** 6) for r in df.collect()]
    check_whitened(queries.op11_whitening(spark, SF).collect(), x)


def test_whitening_of_odd_vectors(spark):
    df = odd_vectors(spark).repartition(5)
    rows = whitening.whitened(df).collect()
    fit = [(r["vec_id"], np.floor(64 * np.array(r["embedding"], float)).astype(np.int64) + 10 ** 6) for r in df.collect()
           if r["embedding"] and r["vec_id"] not in (51, 52, 53, 54)]
    for d in (8, 3, 1):
        mine = [(i, v) for i, v in fit if len(v) == d]
        ids = {i for i, _ in mine}
        n = len(np.unique(np.array([v for _, v in mine]), axis=0))
        part = [r for r in rows if r["vec_id"] in ids and r["n"] == n]
        if d == 1:      # one vector: nothing varies
            assert [(r["component"], r["whitened"], r["explained"], r["identity_error"]) for r in part] == [(1, 0.0, 0.0, 0.0)]
        elif d == 8:
            check_whitened(part, mine)
        else:           # two distinct vectors: one direction varies
            assert len(part) == 9 and sorted(round(r["whitened"], 9) for r in part if r["component"] == 1) in ([-1, -1, 1], [-1, 1, 1])
            assert all(r["whitened"] == 0 for r in part if r["component"] > 1)
    assert len(rows) == 24 * 8 + 3 * 3 + 1
    assert whitening.whitened(df.limit(0)).count() == 0


def test_deviation_beyond_long_is_null():
    m = whitening.Model(2 ** 31, [0, 0], np.eye(2), np.ones(2), 2.0)
    assert m.deviations(np.array([[2, 0], [10, 0], [1, 1]])) == [None] * 3
    assert whitening.Model(3, [3, 6], np.eye(2), np.ones(2), 2.0).deviations(np.array([[1, 2], [2, 2]])) == [0, 9]


# ---- 12 vector codes ----------------------------------------------------------------------

def codes_by_hand(ids, x, parts=16, entries=64, rounds=2):
    ends = vector_code.part_ends(x.shape[1], min(parts, max(1, x.shape[1])))
    spans = list(zip([0, *ends[:-1]], ends))
    order = sorted(range(len(x)), key=lambda i: (ids[i] is None, ids[i] or 0, x[i].tolist()))[:entries]
    books = [x[order][:, a:b].copy() for a, b in spans]
    near = lambda: [((x[:, None, a:b] - e[None]) ** 2).sum(2).argmin(1) for (a, b), e in zip(spans, books)]
    for _ in range(rounds):
        for (a, b), book, c in zip(spans, books, near()):
            for j in set(c.tolist()):
                book[j] = x[c == j][:, a:b].sum(0) // (c == j).sum()
    codes = near()
    error = sum(((x[:, a:b] - e[c]) ** 2).sum(1) for (a, b), e, c in zip(spans, books, codes))
    digest = hashlib.sha256(",".join(str(v) for e in books for row in e for v in row).encode()).hexdigest()
    return ["".join(f"{c[i]:02x}" for c in codes) for i in range(len(x))], error.tolist(), digest


@pytest.mark.parametrize("rounds,entries", [(2, 64), (5, 20), (0, 7), (3, 300)])
def test_codes_equal_a_full_search(spark, rounds, entries):
    rng = np.random.default_rng(rounds)
    x = np.concatenate([rng.integers(-40, 40, (400, 8)), rng.integers(0, 3, (200, 8))])      # many ties
    df = spark.createDataFrame([(i, (v / 256).tolist(), "x") for i, v in enumerate(x)], VECS).repartition(4)
    got = {r["vec_id"]: r for r in vector_code.vector_codes(df, parts=4, entries=entries, rounds=rounds).collect()}
    codes, error, digest = codes_by_hand(list(range(len(x))), x, 4, entries, rounds)
    if entries > 256:
        codes = ["".join(f"{int(c[j:j + 2], 16):04x}" for j in range(0, len(c), 2)) if len(c) == 8 else c for c in codes]
    assert len(got) == len(x) and {r["codebooks_sha256"] for r in got.values()} == {digest}
    assert [got[i]["error"] for i in range(len(x))] == error
    if entries <= 256:
        assert [got[i]["code"] for i in range(len(x))] == codes
    assert {r["label_error"] for r in got.values()} == {sum(error)}


def test_codes_of_odd_vectors(spark):
    df = odd_vectors(spark).repartition(3)
    rows = vector_code.vector_codes(df).collect()
    fit = [r for r in df.collect() if r["embedding"] is not None and r["vec_id"] not in (51, 52, 53, 54)]
    assert len(rows) == len(fit)
    for d in (8, 3, 1):
        mine = [r for r in fit if len(r["embedding"]) == d]
        x = np.floor(256 * np.array([r["embedding"] for r in mine])).astype(np.int64)
        codes, error, digest = codes_by_hand([r["vec_id"] for r in mine], x)
        sums = {}
        for r, e in zip(mine, error):
            sums[r["label"]] = sums.get(r["label"], 0) + e
        want = sorted((r["vec_id"] is None, r["vec_id"] or 0, c, e, sums[r["label"]]) for r, c, e in zip(mine, codes, error))
        assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"], r["label_error"]) for r in rows if r["codebooks_sha256"] == digest) == want
    assert vector_code.vector_codes(df.limit(0)).count() == 0


def test_bounds_settle_like_a_full_search():
    rng = np.random.default_rng(3)
    x, entries = rng.integers(-50, 50, (500, 4)), rng.integers(-50, 50, (64, 4))
    bounds = vector_code.Bounds.full(x, entries, 8)
    compared = 0
    for step in range(6):
        moved = entries + rng.integers(-2, 3, entries.shape)
        bounds.move(np.sqrt(((moved - entries) ** 2).sum(1).astype(float)))
        entries = moved
        before = bounds.near[:, 0].copy()
        compared += bounds.settle(x, entries) > 0
        bounds.narrow(8 - step)
        assert (bounds.near[:, 0] == vector_code._all(x, entries).argmin(1)).all()
        assert before.shape == (500,) and bounds.near.shape[1] <= 9 - step
        back = vector_code._unpack(vector_code._pack([bounds], 64), 64)[0]
        assert (back.near == bounds.near).all() and (back.low[:, 0] >= bounds.low[:, 0]).all()
        assert (back.low[:, 1:] <= bounds.low[:, 1:]).all() and (back.outer <= bounds.outer).all()
    assert compared


# ---- 13 token ids -------------------------------------------------------------------------

def by_library(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [own.encode(t, add_special_tokens=False).ids + [2] for t in texts]


ODD_TEXTS = ["", " \t\n ", "Hello, World! it's 42 o'clock...", "<|endoftext|> a <|startoftext|>", "<| endoftext |>", "Ünïcödé ÇA İstanbul ß ſ",
             "日本語 のテキスト", "é combining", "a\u0085b c d\x1ce\x1ff", "''s 'S don'T we'LL", "a\0b \x7f", "١٢٣ ²³ ½ Ⅷ", "x" * 5000, "😀 a😀b"]


def test_ids_equal_the_library():
    t = token_grammar.WordTokenizer(__import__("public_tokenizers").path("word_bpe_49k.json"))
    want = [i[:-1] for i in by_library(ODD_TEXTS)]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in t.batch(ODD_TEXTS)] == want


@pytest.mark.parametrize("ids", [[], [7], [7, 7], [7] * 9, [7] * 64, [1, 2] * 40, [3, 3, 3, 1] * 30, list(range(100)), [5, 5, 5, 9, 5, 5] * 25])
def test_grammar_round_trip(ids):
    ids = np.array(ids, np.uint32)
    shard = token_grammar.Shard(memoryview(token_grammar.shard_bytes(ids, [1], [len(ids)], False) + b"\n"))
    assert shard.decode().tolist() == ids.tolist() and shard.ids == len(ids)
    for a in range(len(ids)):
        for b in (a + 1, min(a + 7, len(ids)), len(ids)):
            assert shard.decode_range(a, b).tolist() == ids[a:b].tolist()


def test_grammar_of_wide_ids_leaves_no_frequent_pair():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 60_000).clip(max=90_000).astype(np.uint32)
    alphabet, left, right, symbols = token_grammar.repair(ids)
    shard = token_grammar.Shard(memoryview(token_grammar.shard_bytes(ids, [1], [len(ids)], False) + b"\n"))
    assert (shard.decode() == ids).all() and (shard.decode_range(31_000, 32_000) == ids[31_000:32_000]).all()
    pairs = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:].astype(np.uint64)
    apart = symbols[:-1] != symbols[1:]
    assert len(symbols) < len(ids) and np.unique(pairs[apart], return_counts=True)[1].max() < token_grammar.MIN_PAIRS


def test_files_of_odd_documents(spark, tmp_path):
    rows = [(i % 9 if i else None, t, "en", "a", 1) for i, t in enumerate(ODD_TEXTS * 2)] + [(4, None, None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").selectExpr(
        "*", "1 as id", "2 as start", "3 as _hash", "4 as n_tokens", "5 as _row").repartition(3)
    folder = str(tmp_path / "ids")
    token_grammar.write_ids(df, folder, shard_ids=37)          # documents over many shards
    got = token_grammar.read_ids(spark, folder, with_ids=True).orderBy("start").collect()
    want = sorted((i is None, i or 0, bytes(np.array(ids, "<u4"))) for (i, *_), ids in zip(rows, by_library([r[1] or "" for r in rows])))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["ids"])) for r in got) == want
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(r["ids"]) // 4, zlib.crc32(r["ids"]))
        at += r["n_tokens"]
    keys = [(r["doc_id"] is None, r["doc_id"] or 0) for r in got]
    assert keys == sorted(keys)
    empty = str(tmp_path / "none")
    token_grammar.write_ids(df.limit(0), empty)
    assert token_grammar.read_ids(spark, empty).count() == 0


def test_files_of_the_table(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    got = queries.op13_token_grammar(spark, SF).orderBy("doc_id").collect()
    at = 0
    for r, ids in zip(got, by_library([docs[i] for i in sorted(docs)])):
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert [r["doc_id"] for r in got] == sorted(docs) and table(spark, SF, "documents").select(F.count("*")).first()[0] == len(got)
