"""The keyed table of change files: arrival order, replay, compaction beside readers, lost writers."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from strata.streaming.keyed_table import KeyedTable, keyed_sink

CHANGE = "id string, op string, t bigint, n bigint, p bigint, s string"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), {"id": "string"}, {"n": "bigint", "p": "bigint", "s": "string"}, buckets=4)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGE)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_late_change_wins_over_older_cells_only(spark, table):
    for i, row in enumerate([("a", "u", 10, 5, None, None), ("a", "u", 20, None, 7, None), ("a", "u", 15, 6, None, None)]):
        table.write(changes(spark, row), i, "t", "op")
    assert rows(table.read()) == [("a", 6, 7, None)]
    table.compact(0)
    assert rows(table.read()) == [("a", 6, 7, None)]


def by_hand(log):
    out = {}
    for key in {r[0] for r in log}:
        own = [r for r in log if r[0] == key]
        gone = max((r[2] for r in own if r[1] == "d"), default=None)
        puts = [r for r in own if r[1] != "d"]
        if not puts or (gone is not None and max(r[2] for r in puts) < gone):
            continue
        cell = lambda i: max(((r[2], r[i]) for r in puts if r[i] is not None and (gone is None or r[2] >= gone)), default=(0, None))[1]
        out[key] = (key, cell(3), cell(4), cell(5))
    return sorted(out.values())


LOG = [("a", "c", 1, 1, 1, "x"), ("a", "u", 3, None, 4, None), ("b", "c", 1, 2, None, "y"), ("b", "d", 2, None, None, None),
       ("c", "c", 5, 9, None, None), ("c", "d", 4, None, None, None), ("d", "d", 7, None, None, None), ("a", "d", 2, None, None, None),
       ("e", "u", 6, 1, None, "m"), ("e", "u", 6, 3, None, "k"), ("b", "c", 2, None, 8, None)]


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_arrival_gives_the_same_table(spark, tmp_path, seed):
    import random
    log = LOG[:]
    random.Random(seed).shuffle(log)
    t = KeyedTable(spark, str(tmp_path / "t"), {"id": "string"}, {"n": "bigint", "p": "bigint", "s": "string"}, buckets=3, fan_in=2)
    for i, part in enumerate(itertools.batched(log, 3)):
        t.write(changes(spark, *part), i, "t", "op")
        if i == 1:
            t.compact()
    assert rows(t.read()) == by_hand(LOG)
    t.compact()
    t.compact()
    assert rows(t.read()) == by_hand(LOG) and rows(t.read(where=F.col("id") == "a")) == [r for r in by_hand(LOG) if r[0] == "a"]


def test_replayed_batch_changes_nothing(spark, table):
    sink = keyed_sink(table, "t", "op", compact_every=0)
    sink(changes(spark, ("a", "c", 1, 1, None, None)), 0)
    sink(changes(spark, ("a", "u", 2, 2, None, None)), 1)
    before = table.manifest()
    sink(changes(spark, ("a", "u", 2, 2, None, None)), 1)
    assert table.manifest() == before and not table.write(changes(spark, ("a", "u", 9, 9, None, None)), 0, "t", "op")
    assert table.write(changes(spark, ("b", "c", 1, 1, None, None)), 0, "t", "op", writer="other")
    assert rows(table.read()) == [("a", 2, None, None), ("b", 1, None, None)]


def test_a_batch_writes_its_changes_alone(spark, table):
    table.write(spark.range(2000).select(F.col("id").cast("string"), F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("t"),
                                         F.col("id").alias("n"), F.lit(None).cast("bigint").alias("p"), F.lit("x" * 50).alias("s")), 0, "t", "op")
    first = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(table.path) for f in fs}
    table.write(changes(spark, ("7", "u", 2, 70, None, None)), 1, "t", "op")
    after = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(table.path) for f in fs}
    assert {f: after[f] for f in first} == first
    new = table._runs([table.manifest()["runs"][-1]["name"]])
    assert new.count() == 1 and new.rdd.getNumPartitions() == 1
    assert table.read().count() == 2000 and rows(table.read(where=F.col("id") == "7"))[0][1] == 70


def test_reader_during_compaction_and_vacuum(spark, table):
    for i in range(3):
        table.write(changes(spark, ("a", "u", i, i, None, None)), i, "t", "op")
    open_reader = table.read()
    assert table.compact(0) == 3 and len(table.manifest()["runs"]) == 1
    table.write(changes(spark, ("a", "u", 9, 9, None, None)), 3, "t", "op")
    assert rows(open_reader) == [("a", 2, None, None)]       # the runs it opened are still there
    assert table.vacuum(keep=1) == 3 and rows(table.read()) == [("a", 9, None, None)]


def test_writer_meets_compaction(spark, table):
    """A batch committed while a level is merged stays beside the merged run."""
    for i in range(2):
        table.write(changes(spark, ("a", "u", i, i, None, None)), i, "t", "op")
    merge = table._write_run

    def slow(cells):
        name = merge(cells)
        table._write_run = merge
        table.write(changes(spark, ("b", "u", 5, 5, None, None)), 2, "t", "op")
        return name
    table._write_run = slow
    assert table.compact(0) == 2
    assert sorted(r["level"] for r in table.manifest()["runs"]) == [0, 1]
    assert rows(table.read()) == [("a", 1, None, None), ("b", 5, None, None)]


def test_manifest_of_a_lost_writer_is_passed_over(spark, table):
    table.write(changes(spark, ("a", "c", 1, 1, None, None)), 0, "t", "op")
    with open(os.path.join(table.path, "_manifest", "v000000000002.json"), "w") as f:
        f.write('{"runs": [')
    assert rows(table.read()) == [("a", 1, None, None)]
    assert table.write(changes(spark, ("a", "u", 2, 2, None, None)), 1, "t", "op") and rows(table.read()) == [("a", 2, None, None)]


def test_empty_table_and_empty_batch(spark, table):
    assert table.read().collect() == []
    table.write(changes(spark, ("a", "c", 1, 1, None, None)).limit(0), 0, "t", "op")
    assert table.read().collect() == [] and table.compact(0) == 0
