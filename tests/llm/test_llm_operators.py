"""The training-data operators against brute force, exact round trips and held-out accuracy."""

import base64
import gzip
import hashlib
import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

from strata.llm import components as components_module
from strata.llm import chat, lang_id, metric_join, mixing, packing, queries, secret_crf, simhash, topk, url_filter, warc
from strata.llm.common import join_unique, table
from strata.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def doc_rows(spark, texts, source="a", lang="en"):
    return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)], DOCS)


def odd_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows, clashing extra columns."""
    rows = [(1, "one two three four five six", "en", "a", 27), (1, "one two three four five six", "en", "a", 27),
            (None, "one two three four five six", "en", None, None), (2, None, None, None, None), (3, "", "de", "a", 0),
            (4, " \t\n ", "fr", "b", 4), (5, "12345 678", "fr", "b", 9), (6, "x" * 30_000 + " y", "en", "b", 30_002)]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "1 as id", "'x' as fp", "2 as size", "'h' as host", "3 as comp", "4 as _key", "5 as taken", "6 as row")


# ---- 1 mixing -----------------------------------------------------------------------------

def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        t = {s: rest * w[s] / sum(w[o] for o in open_) for s in open_}
        over = {s for s in open_ if t[s] > cap * sizes[s]}
        if not over:
            return {**t, **{s: cap * sizes[s] for s in full}}
        full |= over


def test_mix_targets_and_takes(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = {r["doc_id"]: r for r in docs.select("doc_id", "text", "source").collect()}
    got = mixing.mixed_sizes(docs).collect()
    assert got and sorted(got) == sorted(mixing.mixed_sizes(docs.repartition(3)).collect())
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["size"] == len(WORDS.findall(rows[r["doc_id"]]["text"]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[rows[r["doc_id"]]["source"]] += r["size"]
        taken[rows[r["doc_id"]]["source"]] += r["taken"]
    want = targets_by_hand(dict(sizes))
    for r in got:
        assert r["target"] == pytest.approx(want[rows[r["doc_id"]]["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 4 * mixing.BLOCK_WORDS * 2


def test_sainte_lague_against_counting(spark):
    votes = [(0, i, float(v)) for i, v in enumerate([53, 24, 23, 7, 0.5, 0])] + [(1, i, 10.0) for i in range(7)]
    for seats in (0, 1, 2, 10, 101):
        df = spark.createDataFrame(votes, "g int, i int, v double").selectExpr(
            "*", "sum(v) over (partition by g) as t", f"cast({seats} as bigint) as n")
        got = {(r["g"], r["i"]): r["s"] for r in mixing.sainte_lague(df, ["g"], "v", "t", "n", ["i"], "s").collect()}
        for g in (0, 1):
            own = [(i, v) for h, i, v in votes if h == g]
            have = dict.fromkeys((i for i, _ in own), 0)
            for _ in range(seats):
                have[max((v / (2 * have[i] + 1), -i) for i, v in own)[1] * -1] += 1
            assert {i: got[g, i] for i in have} == have


def test_mixed_documents_keep_text(spark):
    texts = [f"  w{i} a{i}\tb{i}  c{i}\n" * (1 + i % 9) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "en", "s%d" % (i % 4), len(t)) for i, t in enumerate(texts)], DOCS)
    said = {r["doc_id"]: r["taken"] for r in mixing.mixed_sizes(docs).collect()}
    words = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        whole = WORDS.findall(texts[r["doc_id"]])
        part = WORDS.findall(r["text"])
        assert r["n_chars"] == len(r["text"]) and part
        at = [i for i in range(len(whole)) if whole[i:i + len(part)] == part]
        assert at or len(part) < len(whole)
        words[r["doc_id"]] += len(part)
    assert dict(words) == {k: v for k, v in said.items() if v}


# ---- 2 URL filter -------------------------------------------------------------------------

def judged_by_hand(url, rules, default="allow"):
    after = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", after).group()
    path = re.match(r"[^?#]*", after[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len((h + p).encode()), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, None, default)
    return host, path, best[1], best[2]


def test_url_rules_both_ways(spark):
    urls = ["https://a.Example.NET/en/1", "http://example.net/de/", "ftp://example.com/de/x?y", "http://notexample.com/de/", None, "",
            "no scheme.net/x", "http://net", "http://net/", "x://b.org/fr/#f", "x://b.org?/fr/", "http://xorg/fr/", "http://.net/ü/en/",
            "http://É.net/", "http://example.net:80/en/", "://://net/", "http://a.b.c.d.net/" + "p" * 5000]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id int, url string, host string")
    rules = spark.createDataFrame([*queries.URL_RULES, (None, "/", "block")], url_filter.RULES)
    want = [(i, *judged_by_hand(u, queries.URL_RULES)) for i, u in enumerate(urls)]
    for limit in (1 << 20, 0):
        got = url_filter.judge(pages, rules, max_list_bytes=limit).select("page_id", "host", "path", "rule", "verdict")
        assert sorted(tuple(r) for r in got.collect()) == want
    none = url_filter.judge(pages, rules.limit(0)).collect()
    assert {r["verdict"] for r in none} == {"allow"} and url_filter.judge(pages.limit(0), rules).count() == 0


def test_url_rules_that_spell_alike_and_odd_verdicts(spark):
    """One text cut into host and path at two places are two rules; verdicts may be any text."""
    urls = ["http://ab/x", "http://a/b/x", "http://a/b", "http://c.ab/", "http://d/", "http://e/", "http://A/b/é"]
    pages = spark.createDataFrame([(i, u, 7) for i, u in enumerate(urls * 40)], "page_id int, url string, _row int")
    rules = [("a", "b/", "allow"), ("ab", "/", "block"), ("a", "/b/", "review"), ("d", "/", "allow"), ("d", "/", "block"),
             ("e", "/", None), ("e", "", "allow")]
    frame = spark.createDataFrame(rules, url_filter.RULES)
    want = ["block", "review", "none", "block", "block", "allow", "review"] * 40
    said = ["ab/", "a/b/", None, "ab/", "d/", "e", "a/b/"] * 40
    for limit in (1 << 20, 100, 1):
        rows = sorted(url_filter.judge(pages, frame, default="none", max_list_bytes=limit).collect())
        assert [r["verdict"] for r in rows] == want and [r["rule"] for r in rows] == said and {r["_row"] for r in rows} == {7}


def test_url_candidates_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "ASKED_ROWS", 16)
    urls = [f"http://h{i % 7}.net/p{i % 3}/" for i in range(300)]
    rules = [("net", "/p1", "block"), ("h2.net", "/p2/", "allow"), *((f"n{i}.org", "/", "block") for i in range(50))]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    got = url_filter.judge(pages, spark.createDataFrame(rules, url_filter.RULES), max_list_bytes=500)
    assert sorted(tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()) \
        == [(i, *judged_by_hand(u, rules)) for i, u in enumerate(urls)]


def test_digest_collisions_are_confirmed(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda b, *a: len(b))
    path = tmp_path / "a.bin"
    path.write_bytes(url_filter.pack_array([("aa", "/", "block"), ("bb", "/", "allow")]))
    array = url_filter.DigestArray(str(path))
    assert [array.text[array.ends[j]:array.ends[j + 1]].tobytes() if j >= 0 else None for j in array.find([b"2:bb/", b"2:aa/", b"2:cc/"])] \
        == [b"2:bb/", b"2:aa/", None]


# ---- 3 top-k, 8 metric join ---------------------------------------------------------------

def test_dual_search_is_exact():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16)) * 300
    data = np.floor(centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 16)) * 9).astype(np.int64)
    data[100:200] = data[0]
    ids = rng.permutation(3000)
    queries_ = np.concatenate([data[:400], -data[:50]])
    qid = np.concatenate([ids[:400], np.full(50, -1)])
    best = topk.dual_search(queries_, qid, data, ids, 5)
    scores = queries_ @ data.T
    for i in range(len(queries_)):
        want = sorted((-s, v) for s, v in zip(scores[i].tolist(), ids.tolist()) if v != qid[i])[:5]
        assert best.rows[i] == want
    huge = data.astype(object) * 10 ** 9
    assert topk.dual_search(huge[:5], ids[:5], huge[:50], ids[:50], 2).rows[1] == sorted(
        (-int(huge[1] @ x), int(v)) for x, v in zip(huge[:50], ids[:50]) if v != ids[1])[:2]


def test_top_k_of_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(topk, "DATA_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(9)
    ids = [0] * 5 + [50, 50, 100] + [None] * 6 + [int(i) for i in rng.integers(1, 40, 100)]
    vectors = np.round(rng.normal(size=(len(ids), 4)), 1)
    whole = np.floor(vectors * 256).astype(np.int64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id bigint, embedding array<double>")
    key = [2 ** 63 - 1 if i is None else i for i in ids]
    want = []
    for q, own in enumerate(ids):
        if own is not None and own % 50 == 0:
            best = sorted((-int(whole[q] @ whole[x]), key[x]) for x in range(len(ids)) if x != q)[:5]
            want += [(own, r, v, -s) for r, (s, v) in enumerate(best, 1)]
    got = [(r[0], r[1], 2 ** 63 - 1 if r[2] is None else r[2], r[3]) for r in topk.top_k(df.repartition(4), 5, 50).collect()]
    assert sorted(got) == sorted(want)


def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (50, [0.99, 0.01], 1), (None, [1.0, 0.0], 1), (2, None, 1), (3, [], 1), (4, [0.0, 0.0], 1),
            (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, None], 1), (8, [1.0, 0.0], None), (9, [2.0, 0.0], 1), (9, [2.0, 0.0], 1),
            (10, [1.0, 0.0, 0.0], 1), (11, [0.0, 1.0], 1)]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, rep int, n string")


def test_vectors_with_nulls(spark):
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in metric_join.near_vectors(odd_vectors(spark)).collect()}
    assert got == {(0, 4, 0, True), (50, 4, 0, False), (None, 4, 0, False), (9, 4, 0, False), (2, 0, 2, True), (3, 0, 3, True),
                   (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (10, 0, 10, True), (11, 0, 11, True)}
    top = [tuple(r) for r in topk.top_k(odd_vectors(spark), k=2, every=50).collect()]
    assert sorted(top) == [(0, 1, 9, 131072), (0, 2, 9, 131072), (50, 1, 9, 129536), (50, 2, 9, 129536)]
    assert metric_join.near_vectors(odd_vectors(spark).limit(0)).count() == 0 and topk.top_k(odd_vectors(spark).limit(0)).count() == 0


def test_metric_join_cells_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "CELL", 60)
    monkeypatch.setattr(metric_join, "BLOCK", 25)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 8))
    x = np.concatenate([base[rng.integers(0, 40, 300)] + rng.normal(size=(300, 8)) * .18, rng.normal(size=(100, 8))]).astype(np.float32)
    x[350:370] = x[3]
    label = rng.integers(0, 2, len(x))
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))], "vec_id bigint, embedding array<float>, label int")
    d = x.astype(np.float64)
    cos = d @ d.T / np.outer(np.linalg.norm(d, axis=1), np.linalg.norm(d, axis=1))
    near = (cos >= .93) & (label[:, None] == label[None, :]) & ~np.eye(len(x), dtype=bool)
    root = simhash.local_roots(len(x), *np.nonzero(near))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in metric_join.near_vectors(df).collect()}
    assert got == {i: (int(near[i].sum()), int(root[i])) for i in range(len(x))}


# ---- 4 secrets ----------------------------------------------------------------------------

def base_by_hand(text):
    assign = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m.group(1)) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(out)]


ODD_TEXTS = ["password=abc123x", "PassWord : 'short", 'api_key="' + "Z" * 6, "ap\u0131key=abcdefgh", "\u017fecret=abcdefgh", "token=\n123456",
             "AKIAAKIA" + "Q" * 12, "AKIA" + "9" * 15, "a" * 23, "f" * 24, "é token==x.y_z-w= password=secret=abcdefg", "", "x" * 100_000]


def test_base_spans():
    for t in ODD_TEXTS:
        assert secret_crf.base_spans(t) == base_by_hand(t)


def test_secret_query_and_model(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in queries.op4_secret_scan(spark, "/root/testdata/sf0.01").collect():
        base = base_by_hand(texts[r["doc_id"]])
        kinds = [k for k, _, _ in base]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds.count("assign"), kinds.count("access"), kinds.count("hex"))
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) - {""} <= set(r["spans"].split(","))
    field = secret_crf.train(docs)
    # A secret without its keyword is found by its shape; prose, numbers and dates are not.
    key = "b7db7aa4a5fcc78305"
    assert ("crf", 18, 18 + len(key)) in secret_crf.scan(f"the value here is {key} and more", field)
    assert secret_crf.scan("On 2024-05-01 we paid 1,250.00 for item 88 of (555) 123-4567.", field) == []
    clean = secret_crf.redacted(odd_docs(spark).selectExpr("doc_id", "concat(text, ' password=abc123xyz') as text", "lang", "source", "n_chars", "fp"))
    for r in clean.collect():
        assert r["text"] is None or (r["text"].endswith(" [SECRET]") and r["n_chars"] == len(r["text"]))


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    field = secret_crf.Field(rng.normal(size=(1 << secret_crf.BITS, 3)), rng.normal(size=(3, 3)))
    feats = [rng.integers(0, 1 << secret_crf.BITS, 4) for _ in range(5)]
    e = field.scores(feats)

    def score(tags):
        path = [0, *tags, 0]
        return sum(field.step[a, b] for a, b in zip(path, path[1:])) + sum(e[i, t] for i, t in enumerate(tags))
    paths = list(np.ndindex(*[3] * 5))
    assert tuple(field.decode(feats)) == max(paths, key=score)
    weights = np.exp([score(p) for p in paths])
    want = np.array([[sum(w for w, p in zip(weights, paths) if p[i] == t) for t in range(3)] for i in range(5)]) / weights.sum()
    assert np.allclose(field.marginals(feats)[0], want)


def test_field_tags_tokens_of_any_shape():
    """Words, numbers, short tokens and pieces between other signs are in the chain too."""
    weight = lambda token: zlib.crc32(f"head {token[:4]}".encode()) & ((1 << secret_crf.BITS) - 1)
    for first, *rest in (["hunterhunter"], ["1234567890123456"], ["Zx9k2mQ"], ["p", "@", "ssw0rd", "!", "9"], ["пароль"]):
        field = secret_crf.Field(np.zeros((1 << secret_crf.BITS, 3)), np.zeros((3, 3)))
        field.step[secret_crf.OUTSIDE, secret_crf.INSIDE] = -1e3
        for w in ("so", "it", "is", "we", "said"):
            field.emit[weight(w), secret_crf.OUTSIDE] = 4
        field.emit[weight(first), secret_crf.BEGIN] = 4
        for w in rest:
            field.emit[weight(w), secret_crf.INSIDE] = 4
        whole = "".join([first, *rest])
        assert secret_crf.scan(f"so it is {whole} we said", field) == [("crf", 9, 9 + len(whole))]


def test_decoding_in_lanes_and_parts(monkeypatch):
    rng = np.random.default_rng(2)
    step = rng.normal(size=(3, 3))
    for n in (0, 1, 5, 128, 131, 1000):
        e = rng.normal(size=(n, 3))
        best, back = np.array([0.0, -np.inf, -np.inf]), []
        for row in e:
            paths = best[:, None] + step
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        want = [int((best + step[:, 0]).argmax())]
        for b in reversed(back):
            want.append(int(b[want[-1]]))
        assert secret_crf.viterbi(np.array_split(e, 3), step).tolist() == want[-2::-1]
    field = secret_crf.Field(rng.normal(size=(1 << secret_crf.BITS, 3)), step)
    words = ["token", "=", "x9y8z7w6v5", "of", "é", "1234", "the", "Ab/c.d", "\n", "\ud7ff"]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 2, 3, 700, 5, 300)] + [None]
    whole = [secret_crf.scan(t, field) for t in texts]
    assert sum(map(len, whole)) > 100 and list(secret_crf.Scanner(field).scan(texts)) == whole
    for name, value in {"LANE": 7, "LANES": 3, "PART_CHARS": 10, "PART_TOKENS": 4, "GROUP_TOKENS": 50, "KNOWN_TOKENS": 9}.items():
        monkeypatch.setattr(secret_crf, name, value)
    assert list(secret_crf.Scanner(field).scan(texts)) == whole


# ---- 5 packing ----------------------------------------------------------------------------

def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = queries.op5_packing(spark, "/root/testdata/sf0.01").collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = np.array(tok.encode(texts[doc], add_special_tokens=False).ids + [0], "<u4")
        own.sort(key=lambda r: r["start"])
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]] and sum(r["length"] for r in own) == len(ids)
        for r in own:
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    fill = []
    for own in by_seq.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]]
        fill.append(sum(r["length"] for r in own))
    assert max(fill) <= 1024 and sum(1024 - f for f in fill if f & (f - 1)) < 0.02 * sum(fill)


def test_packing_odd_texts(spark):
    tok = packing.tokenizer("byte_bpe_50k.json")
    for t in ["a  b", " x ", "don't", "a<|endoftext|>b", "\0 a", "é, f", "", "\n" * 5000, " " * 5000 + "x", "x" * 50_000, "٣ ²,c", "a\r\n b"]:
        assert tok.ids(t) == np.array(tok.own.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    got = packing.packed_documents(odd_docs(spark), with_ids=True).collect()
    assert sum(r["length"] == 1 and r["doc_tokens"] == 1 for r in got) == 2 and any(r["doc_id"] is None for r in got)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    assert packing.packed_documents(odd_docs(spark).limit(0)).count() == 0


def test_first_fit_decreasing_against_scan():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 1024, 500).tolist()
    bins, want = [], [None] * 500
    for i in sorted(range(500), key=lambda i: (-sizes[i], i)):
        at = next((b for b, used in enumerate(bins) if used + sizes[i] <= 1024), len(bins))
        if at == len(bins):
            bins.append(0)
        want[i] = (at, bins[at])
        bins[at] += sizes[i]
    assert packing.first_fit_decreasing(sizes, 1024) == want


# ---- 6 WARC -------------------------------------------------------------------------------

def test_warc_files_and_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_KEYS", 7)
    rows = [(i, f"http://h{i % 3}.example.org/{i // 2}?q", "same" if i % 4 == 0 else f"<p>é{i}</p>") for i in range(100)]
    rows += [(100, None, None), (101, "not a url\r\nX: y", ""), (102, "http://h0.example.org/0?q", "WARC/1.1\r\n\r\n" * 50), (103, "x://b/", "z" * 50_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, digest int").repartition(4)
    got = {r["page_id"]: tuple(r)[1:] for r in warc.archive_and_read(pages).collect()}
    first = {}
    for i, _, html in rows:
        first.setdefault(html or "", i)
    for i, _, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        refers = None if first[html or ""] == i else first[html or ""]
        assert got[i] == (len(raw), digest, "response" if refers is None else "revisit", refers)
    folder = str(tmp_path / "w")
    warc.write_archive(pages, folder)
    seen = 0
    for f in (tmp_path / "w").glob("part-*"):
        content = f.read_bytes()
        assert b"".join(r for _, _, r in warc.split_members(content)) == gzip.decompress(content)
        seen += sum(1 for _ in warc.split_members(content))
    assert seen == len(rows)
    warc.write_index(warc.scan_archive(spark, folder), str(tmp_path / "i"))
    index = warc.CaptureIndex(spark, str(tmp_path / "i"))
    asked = spark.createDataFrame([(warc.capture_key(rows[5][1], 5),), ("zzz",), ("",), (None,)], "key string")
    assert [r["key"] for r in index.lookup(asked).collect()] == [warc.capture_key(rows[5][1], 5)]
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_long_records_and_min_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "MEMBER_BYTES", 1000)
    record = warc.record_bytes(1, "http://a/", bytes(range(256)) * 40, "D", None)
    packed = warc.members(record)
    assert packed[-1:] == b"\0" and gzip.decompress(packed) == record
    assert [r for _, _, r in warc.split_members(packed + packed)] == [record, record]


# ---- 7 language ---------------------------------------------------------------------------

def test_language_accuracy_and_und(spark):
    truth = {r["doc_id"]: r for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    rows = queries.op7_language_id(spark, "/root/testdata/sf0.01").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in out) > 0.97 * len(out)
    odd = odd_docs(spark)
    und = {r["doc_id"]: r["lang_pred"] for r in lang_id.languages(odd).collect()}
    assert und[2] == und[3] == und[4] == und[5] == "und" and und[6] != "und"
    assert {r["doc_id"] for r in lang_id.with_language(odd).collect()} == {1, None, 6}
    assert lang_id.with_language(odd).columns == odd.columns and lang_id.languages(odd.limit(0)).count() == 0


def test_long_text_counts_like_one_piece(monkeypatch):
    text = "Été à la plage. " * 500
    whole = lang_id.features(text)
    monkeypatch.setattr(lang_id, "SEGMENT", 333)
    assert np.dot(whole, lang_id.features(text)) > 0.999


# ---- 9 chat -------------------------------------------------------------------------------

def test_chat_tree_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat, "BUNDLE_CHATS", 40)
    hot = [("system", "be brief"), ("user", "### x: \\### </turn>\n\\")]
    talks = {i: hot + [("assistant", f"a{i % 7}\\"), ("user", "é")][:i % 3] for i in range(200)}
    talks[-7] = [("user", "</turn>\n### assistant:\n"), ("assistant", "")]
    talks[500] = [("a:b\\", "\n"), ("assistant", "x" * 100_000)] * 3
    rows = [(c, t, r, s) for c, turns in talks.items() for t, (r, s) in enumerate(turns)] + [(900, None, None, None), (None, 1, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    talks |= {900: [("", "")], None: [("assistant", "")]}
    made = chat.bundles(df).collect()
    assert sum(len(b["text"]) for b in made) < sum(len(chat.format_turn(*t)[0]) for turns in talks.values() for t in turns)
    for b in made:     # attention and positions follow the path to the root
        for s in b["segments"]:
            up = [b["segments"][s["parent"]]] if s["parent"] >= 0 else []
            assert s["position"] == sum(i["end"] - i["start"] for i in s["attends"])
            assert not up or s["attends"][-1]["end"] == up[0]["end"]
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(chat.bundles(df)).collect()}
    for c, turns in talks.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c] == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                          hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat.format_turn(*t)[0]) for t in turns))
    assert chat.read_back(chat.bundles(df.limit(0))).count() == 0


def test_chat_prefixes_are_emitted_once_though_bundles_close(spark, monkeypatch):
    """A task emits every node of the prefix tree once, whatever the size of prefixes and bundles."""
    first = ("system", "long \\### " * 10_000)
    talks = {i: [first, ("user", f"q{i % 5}"), ("assistant", f"a{i % 7}"), ("user", "é" * 300), ("assistant", f"b{i % 11}")][:2 + i % 4]
             for i in range(60)}
    talks |= {100 + i: [("user", "other"), ("assistant", "same")] for i in range(9)} | {200: [first], 201: [first]}
    rows = [(c, t, *x) for c, turns in talks.items() for t, x in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    nodes = {tuple(turns[:n]) for turns in talks.values() for n in range(1, len(turns) + 1)}
    size = sum(len(chat.format_turn(*n[-1])[0]) for n in nodes)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for chars, chats in ((1 << 16, 1024), (400, 1024), (1 << 16, 4), (1, 1)):
            monkeypatch.setattr(chat, "BUNDLE_CHARS", chars)
            monkeypatch.setattr(chat, "BUNDLE_CHATS", chats)
            made = chat.bundles(df).collect()
            assert sum(len(b["text"]) for b in made) == size and len(made) > 1
            assert all(s["position"] == sum(i["end"] - i["start"] for i in s["attends"]) for b in made for s in b["segments"])
            got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(chat.bundles(df)).collect()}
            assert len(got) == len(talks)
            for c, turns in talks.items():
                loss = "".join(t for r, t in turns if r == "assistant")
                assert got[c] == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                                  hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat.format_turn(*t)[0]) for t in turns))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


# ---- 10 SimHash ---------------------------------------------------------------------------

def simhash_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(low)
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_by_hand(monkeypatch):
    texts = ["A b\x0bC\td e", "", None, "one", "É É É É É", "a " * 50, "x\x1cy z"] + ODD_TEXTS
    assert [simhash.fingerprint(t) for t in texts] == [simhash_by_hand(t) for t in texts]
    monkeypatch.setattr(simhash, "SEGMENT_BYTES", 10)
    assert simhash.fingerprint("ab cd ef gh ij kl mn op qr st") == simhash_by_hand("ab cd ef gh ij kl mn op qr st")


@pytest.mark.parametrize("cell", [1 << 22, 400])
def test_ball_hashing_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL_FINGERPRINTS", cell)
    monkeypatch.setattr(simhash, "PASS_VARIANTS", 5000)
    rng = np.random.default_rng(9)
    seeds = [int(x) for x in rng.integers(0, 1 << 63, 60, dtype=np.uint64)]
    fps = list(dict.fromkeys(seeds + [s ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 7)), replace=False)) for s in seeds * 9]))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    a, b = zip(*[(i, j) for i, j in combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4])
    want = simhash.local_roots(len(fps), np.array(a), np.array(b))
    got = [(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp bigint"), len(fps)).collect()]
    at = {s: i for i, s in enumerate(signed)}
    assert all((fps[at[x]] ^ fps[at[y]]).bit_count() <= 64 for x, y in got)
    assert (simhash.local_roots(len(fps), np.array([at[x] for x, _ in got]), np.array([at[y] for _, y in got])) == want).all()


def test_near_duplicates_query(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    ids = sorted(texts)
    fps = [simhash_by_hand(texts[i]) for i in ids]
    pairs = [(i, j) for i, j in combinations(range(len(ids)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = simhash.local_roots(len(ids), *map(np.array, zip(*pairs)))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op10_simhash(spark, "/root/testdata/sf0.01").collect()}
    assert got == {d: (f"{fps[i]:016x}", ids[root[i]]) for i, d in enumerate(ids)}


def test_near_duplicates_odd_rows(spark):
    odd = odd_docs(spark)
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(odd).collect()), key=str)
    assert got == [(1, 1), (1, 1), (2, 2), (3, 2), (4, 2), (5, 5), (6, 6), (None, 1)]
    kept = simhash.keep_one(odd)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5, 6] and kept.columns == odd.columns
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_mixing_odd_rows(spark):
    odd = odd_docs(spark)
    got = mixing.mixed_sizes(odd).collect()
    assert len(got) == 8 and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mixed_sizes(odd.limit(0)).count() == 0
    blank = doc_rows(spark, [None, "", " "])
    assert {(r["size"], r["taken"]) for r in mixing.mixed_sizes(blank).collect()} == {(0, 0)}


def test_near_duplicates_keep_rows_of_one_id(spark):
    """Rows of one id with different texts are documents each; a group loses its copies only."""
    texts = [" ".join(f"{w}{i}" for i in range(30)) for w in ("red", "blue")]
    docs = spark.createDataFrame([(5, texts[0], "en", "a", 1), (5, texts[1], "en", "a", 1), (5, texts[1], "en", "a", 1),
                                  (6, texts[0], "en", "a", 1)], DOCS)
    assert sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(docs).collect()) == [(5, texts[1]), (5, texts[0])]


# ---- components and hot keys --------------------------------------------------------------

@pytest.mark.parametrize("last, held, parts", [(1 << 20, 1 << 20, 211), (0, 100, 7), (150, 1 << 20, 3)])
def test_components_of_stars_paths_and_loops(spark, monkeypatch, last, held, parts):
    monkeypatch.setattr(components_module, "LAST_EDGES", last)
    monkeypatch.setattr(components_module, "FOREST_EDGES", held)
    star = [(0, i) for i in range(1, 3000)]
    path = [(10_000 + i, 10_001 + i) for i in range(200)]
    more = [(20_000, 20_001), (20_001, 20_000), (30_000, 30_000), (None, 5)]
    edges = spark.createDataFrame(star + path + more, "a bigint, b bigint").repartition(parts)
    got = {r["node"]: r["comp"] for r in components(edges).collect()}
    want = {**{i: 0 for i in range(3000)}, **{10_000 + i: 10_000 for i in range(201)}, 20_000: 20_000, 20_001: 20_000}
    assert got == want
    assert components(edges.limit(0)).count() == 0


def test_join_unique_keeps_every_row(spark):
    rows = spark.createDataFrame([(0 if i % 3 == 0 else i, i) for i in range(4000)], "k bigint, at bigint")
    unique = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("twice", F.col("k") * 2)
    got = join_unique(rows, unique, ["k"], "n", 4000).collect()
    assert sorted((r["k"], r["at"], r["twice"]) for r in got) == sorted((r["k"], r["at"], 2 * r["k"]) for r in rows.collect())


def test_secret_spans_apart_and_long_texts():
    rng = np.random.default_rng(5)
    for _ in range(200):
        some = [sorted((("k", int(a), int(a + n)) for a, n in zip(rng.integers(0, 60, 6), rng.integers(1, 12, 6))), key=lambda s: s[1])
                for _ in range(2)]
        want = [s for s in some[0] if not any(b[1] < s[2] and s[1] < b[2] for b in some[1])]
        assert secret_crf.apart(some[0], some[1]) == want
    long = " ".join(f"token=a1b2c3d{i:06d}" for i in range(60_000))
    examples = secret_crf.examples_of(long)
    assert len(secret_crf.scan(long, None)) == 60_000
    assert max(len(tags) for _, _, tags in examples) <= secret_crf.TRAIN_TOKENS
    assert all(t == secret_crf.BEGIN for _, _, tags in examples for t in tags)


def test_language_stage_without_a_model_and_below_the_threshold(spark):
    known = table(spark, "/root/testdata/sf0.01", "documents")
    lettered = known.where("text rlike '[A-Za-z]'").count()
    assert lang_id.with_language(known.withColumn("lang", F.lit(None).cast("string"))).count() == lettered
    held = known.where(lang_id.held_out())
    assert lang_id.with_language(held).count() == held.where("text rlike '[A-Za-z]'").count() > 0
    odd = spark.createDataFrame([(-1, "x 1 2 3 4 5", None, "a", 11), (-2, "\u0643\u062a\u0627\u0628 " * 20, None, "a", 100), (-3, "12 !", None, "a", 4)], known.schema)
    kept = lang_id.with_language(known.unionByName(odd)).select("doc_id")
    assert kept.where("doc_id in (-1, -3)").count() == 0 and kept.where("doc_id >= 0").count() == lettered
    assert lang_id.with_language(known.unionByName(odd), min_score=0.45).where("doc_id < 0").count() == 0
    assert lang_id.with_language(odd).count() == 2


def test_metric_join_repeated_ids_on_different_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0], 7), (None, [0.99, 0.01, 0.0], 7), (2, [0.0, 1.0, 0.0], 8), (None, [0.0, 0.99, 0.01], 8),
            (5, [1.0, 0.0, 0.0], 9), (5, [0.0, 1.0, 0.0], 9), (6, [0.01, 0.99, 0.0], 9), (None, [0.0, 0.0, 1.0], 9), (None, [0.0, 0.0, 1.0], 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted(metric_join.near_vectors(df).collect(), key=str)
    assert got == sorted([(1, 1, 1, True), (None, 1, 1, False), (2, 1, 2, True), (None, 1, 2, False), (5, 0, 5, True),
                          (5, 1, 5, True), (6, 1, 5, False), (None, 0, None, True), (None, 0, None, True)], key=lambda t: str(spark_row(t)))


def spark_row(t):
    return Row(vec_id=t[0], n_links=t[1], component_id=t[2], kept=t[3])


def test_chat_long_conversations_are_streamed(spark, monkeypatch):
    talks = {None: [("user" if i % 2 else "assistant", f"t{i} \\ é </turn>" + "x" * (i % 50)) for i in range(3000)],
             0: [("assistant", "y" * 900)] * 40, 3: [("user", "short"), ("assistant", "one")]}
    rows = [(c, t, *x) for c, turns in talks.items() for t, x in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    whole = sorted(chat.read_back(chat.bundles(df)).collect(), key=str)
    for name, value in (("LONG_TURNS", 100), ("LONG_BYTES", 10_000), ("BUNDLE_CHARS", 5000)):
        monkeypatch.setattr(chat, name, value)
    made = chat.bundles(df).collect()
    assert max(len(b["text"]) for b in made) < 7000 and max(len(b["segments"]) for b in made) < 300
    for c, turns in talks.items():
        if c != 3:
            parts = sorted((b for b in made if b["chats"][0]["conv_id"] == c), key=lambda b: b["chats"][0]["part"])
            assert "".join(b["text"] for b in parts) == "".join(chat.format_turn(*t)[0] for t in turns)
            assert [b["segments"][0]["position"] for b in parts] == [sum(len(x["text"]) for x in parts[:i]) for i in range(len(parts))]
            assert [b["chats"][0]["last"] for b in parts] == [False] * (len(parts) - 1) + [True] and len(parts) > 1
    assert sorted(chat.read_back(chat.bundles(df)).collect(), key=str) == whole
