"""Operators against brute-force Python on hand-written and generated rows."""

import datetime as dt
import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.operators import labels as lb
from strata.operators.dedupe import first_flag, first_per_key, latest_per_entity, latest_per_key
from strata.operators.joins import enrich, interval_join
from strata.operators.keywords import keywords
from strata.operators.merge import merge_dimension
from strata.operators.moderation import moderate
from strata.operators.scan import running_max_before, running_profile


def test_latest_and_first_per_key_ties(spark):
    rows = [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 5, 0, "w")]
    df = spark.createDataFrame(rows, "k string, ts int, tie int, v string")
    last = {r.k: r.v for r in latest_per_key(df, ["k"], ["ts", "tie"]).collect()}
    first = {r.k: r.v for r in first_per_key(df, ["k"], ["ts", "tie"]).collect()}
    ent = {r.k: r.v for r in latest_per_entity(df, ["k"], ["ts", "tie"], ["k"]).collect()}
    assert last == {"a": "z", "b": "w"} and ent == last
    assert first == {"a": "x", "b": "w"}


def test_first_flag(spark):
    rows = [(1, "m", "d1", 3), (2, "m", "d1", 1), (3, "m", "d2", 5), (4, "n", "d1", 1)]
    df = spark.createDataFrame(rows, "id long, mid string, d string, ts int")
    got = {r.id: r.uv for r in first_flag(df, ["mid", "d"], ["ts", "id"], "id", "uv").collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1}


def test_interval_join_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    left = [(rnd.randint(0, 3), i, base + dt.timedelta(seconds=rnd.randint(0, 5000))) for i in range(300)]
    right = [(rnd.randint(0, 3), 1000 + i, base + dt.timedelta(seconds=rnd.randint(0, 5000))) for i in range(300)]
    # exact bound hits
    left.append((9, 1, base)); right.append((9, 2, base + dt.timedelta(seconds=120)))
    right.append((9, 3, base - dt.timedelta(seconds=120))); right.append((9, 4, base + dt.timedelta(seconds=121)))
    l = spark.createDataFrame(left, "u int, lid int, lts timestamp")
    r = spark.createDataFrame(right, "u int, rid int, rts timestamp")
    got = sorted((x.u, x.lid, x.rid) for x in interval_join(l, r, ["u"], "lts", "rts", -120, 120).collect())
    want = sorted((a[0], a[1], b[1]) for a in left for b in right
                  if a[0] == b[0] and a[2] - dt.timedelta(seconds=120) <= b[2] <= a[2] + dt.timedelta(seconds=120))
    assert got == want and (9, 1, 4) not in got and (9, 1, 2) in got and (9, 1, 3) in got


def test_asymmetric_interval(spark):
    base = dt.datetime(2024, 1, 1)
    l = spark.createDataFrame([(1, 1, base)], "u int, lid int, lts timestamp")
    r = spark.createDataFrame([(1, 2, base + dt.timedelta(seconds=s)) for s in (-10, -5, 0, 20, 21)],
                              "u int, rid int, rts timestamp").withColumn("rid", F.monotonically_increasing_id())
    got = interval_join(l, r, ["u"], "lts", "rts", -5, 20).count()
    assert got == 3


def test_running_scans_match_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), i, rnd.randint(0, 50), rnd.choice(["x", "y", "z", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, pos long, v int, s string")
    chunk = F.floor(F.col("pos") / 37)
    got = {r.pos: r.prev_max for r in running_max_before(df, ["k"], ["pos"], chunk, "v").collect()}
    w = W.partitionBy("k").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    want = {r.pos: r.m for r in df.select("pos", F.max("v").over(w).alias("m")).collect()}
    assert got == want
    prof = {r.pos: (r.pv, r.s_set) for r in running_profile(df, ["k"], ["pos"], chunk, ["s"]).collect()}
    seen, cnt = {}, {}
    for k, pos, _, s in sorted(rows, key=lambda x: x[1]):
        cnt[k] = cnt.get(k, 0) + 1
        if s is not None:
            seen.setdefault(k, set()).add(s)
        assert prof[pos] == (cnt[k], ",".join(sorted(seen.get(k, set()))))


def test_merge_dimension_put_delete_empty(spark):
    cur = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y"), ("3", "c", "z")], "id string, n string, m string")
    ch = spark.createDataFrame([
        ("1", "u", 1, "", "x2"),        # empty name keeps the old one
        ("2", "d", 1, None, None),      # delete
        ("4", "c", 1, "d", "w"),        # insert
        ("3", "u", 1, "c1", None), ("3", "u", 2, "c2", None),  # last change wins
    ], "id string, op string, ts_ms long, n string, m string")
    got = sorted(tuple(r) for r in merge_dimension(cur, ch, "id", ["n", "m"]).collect())
    assert got == [("1", "a", "x2"), ("3", "c2", "z"), ("4", "d", "w")]
    got2 = sorted(tuple(r) for r in merge_dimension(cur, ch, "id", ["n", "m"], ignore_deletes=True, null_text=True).collect())
    assert got2 == [("1", "", "x2"), ("2", "b", "y"), ("3", "c2", "null"), ("4", "d", "w")]


def test_moderation_passes(spark):
    words = ["bad", "evil", "ugly"]
    rows = [("1", "nice text"), ("2", "some text,bad"), ("3", "an evil and ugly thing"), ("4", "no comma evil"),
            ("5", "ends with , ugly "), ("6", None)]
    df = spark.createDataFrame(rows, "id string, text string")
    got = {r.id: (r.violation, r.grade, r.words) for r in moderate(df, "text", words).collect()}
    assert got["1"] == (0, "", "")
    assert got["2"] == (1, "P0", "bad")
    assert got["3"] == (1, "P1", "evil, ugly")
    assert got["4"] == (1, "P1", "evil")
    assert got["5"] == (1, "P0", "ugly")
    assert got["6"][0] == 0


def test_moderation_is_the_same_for_any_list_length(spark):
    df = spark.createDataFrame([(1, "a w1x, w1x"), (2, "has w1x inside"), (3, "clean"), (4, None), (5, "")], "id int, text string")
    words = ["w1x", "w1x", "", "inside"]
    want = [(1, 1, "P0", "w1x"), (2, 1, "P1", "w1x, inside"), (3, 0, "", ""), (4, 0, "", ""), (5, 0, "", "")]
    table = spark.createDataFrame([("w1x",), ("w1x",), ("",), (None,)], "word string")
    for listed in (words, words + [f"other{i}x" for i in range(300)]):
        assert sorted((r.id, r.violation, r.grade, r.words) for r in moderate(df, "text", listed).collect()) == want
    assert [r.words for r in moderate(df.filter("id = 2"), "text", table).collect()] == ["w1x"]
    assert [r.grade for r in moderate(df, "text", []).collect()] == [""] * 5


def test_merge_applies_every_change_of_a_key(spark):
    cur = spark.createDataFrame([("1", "old", "s0"), ("2", "old", "s0"), ("3", "old", "s0")], "id string, name string, seg string")
    ch = spark.createDataFrame([("1", "u", 1, "new", None), ("1", "u", 2, "", "s2"), ("2", "d", 1, None, None), ("2", "c", 2, "", "s9"),
                                ("3", "u", 1, "x", "y"), ("3", "d", 2, None, None)], "id string, op string, ts_ms long, name string, seg string")
    got = sorted(tuple(r) for r in merge_dimension(cur, ch, "id", ["name", "seg"]).collect())
    assert got == [("1", "new", "s2"), ("2", None, "s9")]


def test_page_predicates(spark):
    from strata.sources.applog import login_rows, page_rows, search_rows
    rows = [("view", "1", None, "keyword", "w"), ("click", "1", "login", None, None), ("signup", "1", "login", None, None),
            ("view", "", "login", None, None), ("view", None, "", None, None), ("view", "2", "search", "keyword", "w"),
            ("view", "2", "search", "keyword", None), ("error", "2", "home", "keyword", "w")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, event_type string, uid string, last_page_id string, item_type string, item string")
    ids = lambda d: sorted(r.i for r in d.collect())
    assert ids(page_rows(df)) == [0, 1, 3, 4, 5, 6, 7] and ids(login_rows(df)) == [0, 1] and ids(search_rows(df)) == [5]


def test_keywords_inner(spark):
    df = spark.createDataFrame([(1, "Hello, wörld! 42"), (2, "123 ..."), (3, None)], "id int, t string")
    got = sorted((r.id, r.keyword) for r in keywords(df, "t").collect())
    assert got == [(1, "hello"), (1, "wörld")]


def test_scores_and_bands(spark):
    df = spark.createDataFrame([("iOS",), ("Android",), ("HarmonyOS",)], "os string")
    s = {r.os: r.device_18_24 for r in lb.apply_scores(df, "device", "os").collect()}
    assert str(s["iOS"]) == "0.070" and str(s["Android"]) == "0.080" and s["HarmonyOS"] is None
    tm = spark.createDataFrame([("苹果",), ("unknown",), (None,)], "b string")
    t = {r.b: r.tm_50 for r in lb.apply_scores(tm, "tm", "b").collect()}
    assert str(t["苹果"]) == "0.100" and str(t["unknown"]) == "0.120" and t[None] is None
    assert str(lb.score("amount", 0.7)) == "0.105"
    tot = spark.createDataFrame([(1, 2, 2, 0, 0, 0), (0, 0, 0, 0, 0, 0)],
                                ", ".join(f"total_{b} int" for b in lb.BANDS))
    got = tot.select(lb.age_band().alias("a"), lb.max_band_map().alias("m")).collect()
    assert got[0].a == "25-29" and got[0].m == {"25-29": 2} and got[1].m == {}


def test_enrich_default_and_first_match(spark):
    fact = spark.createDataFrame([("1201",), ("9999",), (None,)], "code string")
    dim = spark.createDataFrame([("1201", "good"), ("1201", "dup")], "c string, n string")
    got = sorted(r.name for r in enrich(fact, dim, "code", "c", {"n": "name"}, default={"name": "N/A"}).collect())
    assert got == ["N/A", "N/A", "dup"]


def test_seq_and_previous_matches_window(spark):
    from strata.operators.scan import seq_and_previous
    rnd = random.Random(11)
    rows = [(rnd.choice("abc"), i, rnd.randint(0, 30), rnd.choice([None, 1, 2, 3])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, pos long, t int, v int")
    got = {r.pos: (r.seq, r.prev_v) for r in seq_and_previous(df, ["k"], ["t", "pos"], F.floor(F.col("t") / 7), ["v"]).collect()}
    w = W.partitionBy("k").orderBy("t", "pos")
    want = {r.pos: (r.s, r.p) for r in df.select("pos", F.row_number().over(w).alias("s"), F.lag("v").over(w).alias("p")).collect()}
    assert got == want


def test_literal_modes(spark):
    from strata.operators.facts import cart_add
    ch = spark.createDataFrame([("r", 3, None), ("c", 2, None), ("u", 5, 2), ("u", 1, 4)],
                               "op string, sku_num_after int, sku_num_before int")
    assert sorted(r.sku_num for r in cart_add(ch).collect()) == [2, 3, 3]
    assert [r.sku_num for r in cart_add(ch, literal=True).collect()] == [3]
    fams = ["device", "search", "pay_time", "amount", "tm", "b1name"]
    row = [1] * (6 * len(fams))
    df = spark.createDataFrame([tuple(row)], ", ".join(f"{f}_{b} int" for f in fams for b in lb.BANDS))
    intent = lb.band_totals(df, fams).select([f"total_{b}" for b in lb.BANDS]).first()
    literal = lb.band_totals(df, fams, literal=True).select([f"total_{b}" for b in lb.BANDS]).first()
    assert [int(x) for x in intent] == [6] * 6
    assert [int(x) for x in literal] == [4, 4, 4, 0, 0, 4]


def test_hot_key_holding_a_third_of_rows(spark):
    """One key with a third of all rows: the skew-safe forms stay exact."""
    from strata.operators.scan import seq_and_previous
    rnd = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randint(0, 200)}", i, rnd.randint(0, 10_000), rnd.randint(0, 9))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, pos long, t long, v int")
    chunk = F.floor(F.col("t") / 500)
    # latest per key (map-side group limit) and per-key aggregate form agree with Python
    want_last = {}
    for k, pos, tt, v in rows:
        if k not in want_last or (tt, pos) > want_last[k][:2]:
            want_last[k] = (tt, pos, v)
    got1 = {r.k: (r.t, r.pos, r.v) for r in latest_per_entity(df, ["k"], ["t", "pos"]).collect()}
    got2 = {r.k: (r.t, r.pos, r.v) for r in latest_per_key(df, ["k"], ["t", "pos"]).collect()}
    assert got1 == want_last == got2
    # two-level position / previous value over the hot key
    s = {r.pos: (r.seq, r.prev_v) for r in seq_and_previous(df, ["k"], ["t", "pos"], chunk, ["v"]).collect()}
    hot = sorted((tt, pos, v) for k, pos, tt, v in rows if k == "hot")
    for i, (tt, pos, v) in enumerate(hot):
        assert s[pos] == (i + 1, hot[i - 1][2] if i else None)
    # the largest (key, chunk) group the scan ranks in one task is a slice of the hot key
    biggest = df.groupBy("k", chunk.alias("c")).count().agg(F.max("count")).first()[0]
    assert biggest < len(hot) / 10


def test_every_score_row_is_reached(spark, sf_small):
    """The order label check runs over every slot, tier, brand and category that has scores."""
    from strata.operators import labels as lb
    from strata.plans.profile import order_label
    seen = order_label(spark, sf_small).checkpoint()
    for family, col in (("pay_time", "pay_time_slot"), ("amount", "amount_tier"), ("tm", "tm_name"), ("b1name", "category_name")):
        values = {r[0] for r in seen.select(col).distinct().collect()}
        known = {k for k in lb.COEFFICIENTS[family] if k != lb.OTHER}
        assert known <= values, family
        if lb.OTHER in lb.COEFFICIENTS[family]:
            assert values - known - {""}, family
    assert {r[0] for r in seen.filter("tm_name = ''").select("tm_18_24").collect()} == {None}
