"""Bursts, versioned config, running sets, mergeable counts, Bloom state and word tables against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import bursts, cdc, moderation
from strata.operators.bitmaps import distinct_bitmaps, distinct_counts, united
from strata.operators.bloom import BloomState
from strata.operators.bursts import with_bursts
from strata.operators.moderation import moderate
from strata.operators.scan import asof_last, running_profile

T0 = dt.datetime(2024, 1, 1)


def greedy(times, length):
    out, start = {}, None
    for t in sorted(set(times)):
        if start is None or t > start + dt.timedelta(seconds=length):
            start = t
        out[t] = start
    return out


@pytest.mark.parametrize("seed", range(3))
def test_bursts_are_greedy(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("aab"), i % 2, T0 + dt.timedelta(seconds=rng.randrange(0, 900))) for i in range(400)]
    rows += [("one", 0, T0), ("one", 0, T0), ("gap", 0, T0), ("gap", 0, T0 + dt.timedelta(seconds=5)), ("gap", 0, T0 + dt.timedelta(seconds=6))]
    df = spark.createDataFrame([*rows, (None, 0, T0), ("x", 0, None)], "k string, j int, ts timestamp")
    got = with_bursts(df, ["k", "j"], "ts", 5).collect()
    assert len(got) == len(rows) + 2
    for key in {(k, j) for k, j, _ in rows}:
        want = greedy([t for k, j, t in rows if (k, j) == key], 5)
        assert {r.ts: r.burst_start for r in got if (r.k, r.j) == key and r.ts} == want
    assert all(r.burst_start is None for r in got if r.k in (None, "x"))


def test_bursts_equal_the_stream_form(spark, tmp_path):
    """Every burst that the stream form closes is one of the batch form, with the same kept row."""
    from strata.operators.dedupe import latest_per_entity
    from strata.streaming.stateful import latest_in_burst_stream
    rng = random.Random(4)
    rows = sorted((T0 + dt.timedelta(seconds=rng.randrange(0, 600)), rng.choice("abc"), i) for i in range(150))
    df = spark.createDataFrame([(k, t, i) for t, k, i in rows], "k string, ts timestamp, n long")
    end = spark.createDataFrame([("end", T0 + dt.timedelta(hours=1), 0)], df.schema)
    for i, part in enumerate((df.where(F.col("ts") < T0 + dt.timedelta(seconds=300)), df.where(F.col("ts") >= T0 + dt.timedelta(seconds=300)), end)):
        part.coalesce(1).write.parquet(str(tmp_path / "src" / f"p={i}"))
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path / "src" / "p=*"))
    q = latest_in_burst_stream(src, "k", "ts", ["ts", "n"], 20).writeStream.format("memory").queryName("bursts_eq") \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = {tuple(r) for r in spark.table("bursts_eq").collect()}
    batch = latest_per_entity(with_bursts(df, ["k"], "ts", 20, "b"), ["k", "b"], ["ts", "n"]).select("k", "ts", "n")
    assert got == {tuple(r) for r in batch.collect()}


def test_asof_last_over_chunks(spark):
    rng = random.Random(1)
    rows = [("h" if rng.random() < 0.8 else "c", i, rng.choice([None, None, f"v{i}"])) for i in range(300)]
    got = asof_last(spark.createDataFrame(rows, "k string, t int, v string"), ["k"], ["t"], F.floor(F.col("t") / 16), "v", "o").collect()
    last = {}
    want = []
    for k, t, v in rows:
        last[k] = v or last.get(k)
        want.append((k, t, v, last[k]))
    assert sorted(tuple(r) for r in got) == sorted(want, key=lambda r: r[:2])


def test_config_valid_at_the_changes_time(spark):
    a, b = {"t": "x", "c": "1"}, {"t": "x", "c": "2"}
    conf = spark.createDataFrame([("r", None, a, 10), ("u", a, b, 20), ("d", b, None, 30), ("r", None, a, 40), ("r", None, {"t": "y", "c": "9"}, 0)],
                                 "op string, before map<string,string>, after map<string,string>, ts_ms long")
    ch = spark.createDataFrame([("x", t) for t in (5, 10, 15, 20, 29, 30, 35, 40, 99)] + [("y", 7), ("z", 7)], "tbl string, ts_ms long")
    got = cdc.route_asof(ch, conf, [("tbl", "t")], chunk_ms=8).select("tbl", "ts_ms", F.col("config")["c"].alias("c")).collect()
    assert sorted(tuple(r) for r in got) == [("x", 10, "1"), ("x", 15, "1"), ("x", 20, "2"), ("x", 29, "2"), ("x", 40, "1"), ("x", 99, "1"), ("y", 7, "9")]


def test_running_sets(spark):
    rng = random.Random(2)
    rows = [("u" if rng.random() < 0.7 else "w", i, rng.choice(["a", "b", None, "c"]), rng.choice(["x", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t int, s string, r string")
    got = {x.t: x for x in running_profile(df, ["k"], ["t"], F.floor(F.col("t") / 16), ["s", "r"]).collect()}
    n, sets = {}, {}
    for k, t, s, r in rows:
        n[k] = n.get(k, 0) + 1
        own = sets.setdefault(k, (set(), set()))
        own[0].update({s} - {None})
        own[1].update({r} - {None})
        assert (got[t].pv, got[t].s_set, got[t].r_set) == (n[k], ",".join(sorted(own[0])), ",".join(sorted(own[1])))
    plan = running_profile(df, ["k"], ["t"], F.floor(F.col("t") / 16), ["s", "r"])._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan


def test_distinct_counts_merge(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(8), rng.choice([1, 7, 32768, 32769, 10 ** 9, None, rng.randrange(10 ** 6)])) for _ in range(3000)]
    fine = distinct_bitmaps(spark.createDataFrame(rows, "h int, u long"), ["h"], "u")
    coarse = united(united(fine, [F.floor(F.col("h") / 2).alias("h2")]), [F.floor(F.col("h2") / 2).alias("h4")])
    got = {r.h4: r.n for r in distinct_counts(coarse, ["h4"], "n").collect()}
    assert got == {g: len({u for h, u in rows if h // 4 == g and u is not None}) for g in (0, 1)}


def test_bloom_state_drops_nothing(spark, tmp_path):
    rng = random.Random(5)
    state = BloomState(spark, str(tmp_path / "s"), ["k"], buckets=1)          # 20,000 keys in one bucket: many false positives
    seen, kept = set(), 0
    for epoch in range(3):
        rows = [(rng.randrange(30_000), i) for i in range(9000)]
        df = spark.createDataFrame(rows, "k long, n long")
        first = {}
        for k, n in rows:
            first.setdefault(k, n)
        want = {k: n for k, n in first.items() if k not in seen}
        for _ in range(2):                                                    # the batch is run again
            assert {r.k: r.n for r in state.new_rows(df, epoch, ["n"]).collect()} == want
        seen |= set(first)
        kept += len(want)
    maybe = state._may_be_seen(spark.range(10 ** 6, 10 ** 6 + 500).select(F.col("id").alias("k")), 3).where("_maybe").count()
    assert maybe > 50 and kept == len(seen)
    big = BloomState(spark, str(tmp_path / "b"), ["k"], buckets=8)
    big.new_rows(spark.range(20_000).select(F.col("id").alias("k"), F.col("id").alias("n")), 0, ["n"])
    assert big._may_be_seen(spark.range(20_000).select(F.col("id").alias("k")), 1).where("not _maybe").count() == 0
    assert big._may_be_seen(spark.range(10 ** 6, 10 ** 6 + 5000).select(F.col("id").alias("k")), 1).where("_maybe").count() < 150
    bytes_per_key = big.bits(1).select(F.sum(F.length("bits"))).first()[0] / 20_000
    assert bytes_per_key < 2


@pytest.mark.parametrize("n", [8, 300, 50_000])
def test_word_tables_of_any_length(spark, n):
    rng = random.Random(n)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(3, 7)))
    words = sorted({word() for _ in range(n)} | {"idiot", "bad one", "a.c"})
    texts = [" ".join(word() for _ in range(30)) for _ in range(40)] + ["", None, "xx, idiot ", "x bad one y", "abc", "ab", "same idiot"] + ["same idiot"] * 5
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, text string")
    table = spark.createDataFrame([(w,) for w in [*words, words[0], "", None]], "word string")
    got = {r.id: r for r in moderate(df, "text", table).collect()}
    assert len(got) == len(texts)
    for i, x in enumerate(texts):
        found = [w for w in words if w in (x or "")]
        last = (x or "").split(",")[-1].strip(" ")
        p0 = x is not None and last in words
        assert (got[i].violation, got[i].grade, got[i].words) == (int(bool(found)), "P0" if p0 else "P1" if found else "",
                                                                  last if p0 else ", ".join(found))
    if n == 8:
        assert sorted(map(tuple, moderate(df, "text", words).collect())) == sorted(map(tuple, got.values()))
    assert moderate(df, "text", table.limit(0)).where("violation = 1").count() == 0


def test_shared_word_tables_are_not_shuffled(spark, monkeypatch):
    """Words that go to every task meet texts of any bytes and places as the joined ones do, in a plan without a shuffle."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abé€😀\0,") for _ in range(rng.randrange(1, 14)))
    texts = [" ".join(word() for _ in range(rng.randrange(60))) for _ in range(60)] + ["", None, "a", "é", "abababab", "ab" * 400]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, text string").coalesce(1)
    for shortest, n in ((1, 5), (2, 40), (6, 400), (9, 3000)):
        words = sorted({w for w in (word() for _ in range(n)) if len(w.encode()) >= shortest} | {"abababab" * 2})
        table = spark.createDataFrame([(w,) for w in [*words, words[0], "", None]], "word string")
        shared = moderate(df, "text", table)
        assert "Exchange" not in shared._jdf.queryExecution().executedPlan().toString()
        with monkeypatch.context() as m:
            m.setattr(moderation, "PLACES", 7)
            in_bits = sorted(map(tuple, moderate(df, "text", table).collect()))
        with monkeypatch.context() as m:
            m.setattr(moderation, "SHARED_BYTES", 0)
            joined = sorted(map(tuple, moderate(df, "text", table).collect()))
        assert sorted(map(tuple, shared.collect())) == in_bits == joined
        want = {i: [w for w in words if w in (x or "")] for i, x in enumerate(texts)}
        assert all(r.violation == int(bool(want[r.id])) and (r.grade == "P0" or r.words == ", ".join(want[r.id])) for r in shared.collect())


def test_bursts_of_short_keys_need_no_joins(spark, monkeypatch):
    """Keys of few rows take one shuffle; long ones go by pointer doubling; both give the same rows, mixed too."""
    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 7, 8]), rng.choice("xy") if rng.random() > 0.05 else None,
             T0 + dt.timedelta(seconds=rng.randrange(40)) if rng.random() > 0.05 else None) for _ in range(160)]
    rows += [(100, "x", T0 + dt.timedelta(seconds=3 * i)) for i in range(20)]
    df = spark.createDataFrame(rows, "k int, j string, ts timestamp")
    got = {}
    for short in (12, 1000):
        monkeypatch.setattr(bursts, "SHORT", short)
        made = with_bursts(df, ["k", "j"], "ts", 5)
        assert short < 1000 or "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
        got[short] = sorted(map(str, made.collect()))
    assert len(got[12]) == len(rows) and got[12] == got[1000]
    want = {}
    for k, j, t in rows:
        if k is not None and j is not None and t is not None:
            want.setdefault((k, j), []).append(t)
    for r in made.collect():
        held = None not in (r.k, r.j, r.ts)
        assert r.burst_start == (greedy(want[r.k, r.j], 5)[r.ts] if held else None)
