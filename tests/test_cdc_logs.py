"""CDC envelopes and app-log splitting on hand-written records (edge rows of FIXTURES A6)."""

import json

import pytest
from pyspark.sql import functions as F

from strata.operators import cdc
from strata.operators import logs as lg


def lines(spark, items):
    return spark.createDataFrame([(x,) for x in items], "value string")


def test_normalise_both_forms(spark):
    recs = [
        json.dumps({"op": "c", "after": {"id": "1", "x": "a"}, "source": {"db": "shop", "table": "t1"}, "ts_ms": 5}),
        json.dumps({"op": "d", "before": {"id": "2"}, "after": None, "source": {"db": "shop", "table": "t1"}, "ts_ms": 6}),
        json.dumps({"op": "u", "before": {"id": "3"}, "after": {}, "source": {"db": "shop", "table": "t1"}, "ts_ms": 7}),
        json.dumps({"database": "shop", "table": "t2", "type": "update", "ts": 10,
                    "data": {"id": "4", "n": "new", "k": "same"}, "old": {"n": "old"}}),
        json.dumps({"database": "shop", "table": "t2", "type": "bootstrap-insert", "ts": 11, "data": {"id": "5"}}),
        json.dumps({"database": "shop", "table": "t2", "type": "delete", "ts": 12, "data": {"id": "6"}}),
        json.dumps({"op": "c", "after": {"id": "7"}, "source": {"db": "other", "table": "t1"}, "ts_ms": 8}),
        None,
    ]
    n = cdc.normalise(cdc.parse_envelopes(lines(spark, recs)))
    got = {r.id: r for r in n.select("*", cdc.row_id().alias("id")).collect()}
    assert len(got) == 7
    assert got["4"].op == "u" and got["4"].before == {"id": "4", "n": "old", "k": "same"} and got["4"].ts_ms == 10000
    assert got["5"].op == "r" and got["5"].is_bootstrap
    assert got["6"].op == "d" and got["6"].after is None and got["6"].before == {"id": "6"}
    literal = {r.id for r in cdc.valid_changes(n, "shop", keep_deletes=False, drop_bootstrap=False)
               .select(cdc.row_id().alias("id")).collect()}
    intent = {r.id for r in cdc.valid_changes(n, "shop", keep_deletes=True, drop_bootstrap=True)
              .select(cdc.row_id().alias("id")).collect()}
    assert literal == {"1", "4", "5"}          # deletes and empty 'after' never pass the literal filter
    assert intent == {"1", "2", "4", "6"}      # deletes with a before image pass; bootstrap dropped


def test_failfast_on_bad_record(spark):
    with pytest.raises(Exception):
        cdc.parse_envelopes(lines(spark, ['{"op": "c"}', "not json"])).collect()


def test_latest_config_insert_update_delete_and_prune(spark):
    rows = [("r", None, {"source_table": "a", "sink_columns": "id,x"}, 1),
            ("u", {"source_table": "a"}, {"source_table": "a", "sink_columns": "id"}, 2),
            ("r", None, {"source_table": "b", "sink_columns": "id"}, 1),
            ("d", {"source_table": "b", "sink_columns": "id"}, None, 3)]
    cfg = spark.createDataFrame(rows, "op string, before map<string,string>, after map<string,string>, ts_ms long")
    cur = {r.source_table: r.config["sink_columns"] for r in cdc.latest_config(cfg, ["source_table"]).collect()}
    assert cur == {"a": "id"}
    data = spark.createDataFrame([("a", {"id": "1", "x": "2", "y": "3"}), ("b", {"id": "9"}), ("z", {"id": "0"})],
                                 "table_name string, after map<string,string>")
    routed = cdc.route_by_config(data, cdc.latest_config(cfg, ["source_table"]), [("table_name", "source_table")])
    got = routed.select(cdc.map_text(cdc.prune_columns(F.col("after"), F.col("config")["sink_columns"]))).collect()
    assert [r[0] for r in got] == ["id=1"]


def test_log_split_edges(spark):
    common = {"mid": "m1", "uid": "u1"}
    recs = [
        None,                                           # tombstone
        "this is not json",                             # dirty
        json.dumps({"page": {"page_id": "home"}, "ts": 1}),                          # no common
        json.dumps({"common": common, "page": {"page_id": "home"}, "displays": [], "ts": 2}),
        json.dumps({"common": common, "page": {"page_id": "good_detail"}, "ts": 3}),  # displays missing
        json.dumps({"common": common, "page": {"page_id": "x"}, "ts": 4,
                    "displays": [{"item": "1"}, {"item": "2"}, {"item": "3"}], "actions": [{"action_id": "a"}]}),
        json.dumps({"common": common, "start": {"entry": "icon"}, "err": {"error_code": "1"}, "ts": 5}),
    ]
    parsed = lg.parse_logs(lines(spark, recs))
    assert [r.line for r in lg.dirty(parsed).collect()] == ["this is not json"]
    logs = lg.clean(parsed)
    out = {k: v.collect() for k, v in lg.split_logs(logs).items()}
    assert [r.ts for r in out["err"]] == [5]
    assert [r.ts for r in out["start"]] == [5]
    assert sorted(r.display["item"] for r in out["display"]) == ["1", "2", "3"]
    assert len(out["action"]) == 1 and "ts" not in out["action"][0].asDict()
    assert sorted(r.ts for r in out["page"]) == [1, 2, 3, 4]


def test_log_parse_failfast(spark):
    with pytest.raises(Exception):
        lg.parse_logs(lines(spark, ["{}", "nope"]), mode="FAILFAST").collect()


def test_whole_records_keep_unknown_fields(spark):
    common = {"mid": "m1", "is_new": "1", "imei": "77"}
    page = {"common": common, "page": {"page_id": "x", "pos_id": 3}, "ts": 4, "zip": [1, {"a": None}],
            "displays": [{"item": "1", "n": {"x": 1}}, {"item": "2"}], "actions": [{"action_id": "a", "deep": [True]}], "err": {"code": 5}}
    start = {"common": common, "start": {"entry": "icon"}, "err": {"code": 1}, "ts": 5, "odd": "é"}
    got = lg.whole_records(lines(spark, [json.dumps(page), json.dumps(start), "[1]", "12 x", None, "{}"])).collect()
    out = {}
    for r in got:
        out.setdefault(r.tag, []).append(r.record if r.tag == "dirty" else json.loads(r.record))
    bare = {k: v for k, v in page.items() if k not in ("err", "displays", "actions")}
    assert sorted(out["dirty"]) == ["12 x", "[1]"] and out["page"] == [bare, {}]
    assert out["err"] == [page, start] and out["start"] == [{k: v for k, v in start.items() if k != "err"}]
    head = {"common": common, "page": page["page"]}
    assert out["display"] == [{**head, "ts": 4, "display": d} for d in page["displays"]]
    assert out["action"] == [{**head, "action": page["actions"][0]}]
    split = {k: [json.loads(r[0]) for r in v.select(F.to_json("record")).collect()]
             for k, v in lg.split_logs(lg.clean(lg.parse_logs(lines(spark, [json.dumps(page), json.dumps(start), "{}"])))).items()}
    assert split == {k: out[k] for k in split}


def test_is_new_is_repaired_in_the_whole_record(spark):
    from strata.streaming.runner import repaired_records
    recs = [('{"common":{"is_new":"1","mid":"m","x":[1]},"ts":5,"y":2}', "0"), ('{"ts":6}', None), ('{"common":{"mid":"m"},"ts":7}', "0")]
    got = repaired_records(spark.createDataFrame(recs, "line string, is_new_fixed string")).select(F.to_json("record"), "common.is_new").collect()
    assert [tuple(r) for r in got] == [('{"common":{"is_new":"0","mid":"m","x":[1]},"ts":5,"y":2}', "0"), ('{"ts":6}', None),
                                       ('{"common":{"mid":"m"},"ts":7}', None)]
