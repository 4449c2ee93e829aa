"""Snapshot and log: whatever happens while chunks are read, the result is the table that the log leaves."""

import random

import pytest
from pyspark.sql import functions as F

from strata.sources.snapshot import read_chunks, snapshot_then_log, table_after

LOG = "id bigint, pos bigint, op string, v string"


def as_of(history, pos):
    out = {}
    for i, p, op, v in history:
        if p <= pos:
            out.pop(i, None) if op == "d" else out.__setitem__(i, v)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_any_interleaving_gives_the_last_state(spark, seed):
    rng = random.Random(seed)
    history, live = [], set()
    for pos in range(1, 400):
        i = rng.randrange(60) if rng.random() < 0.7 else 7      # a hot key
        op = "c" if i not in live else rng.choice("uud")
        live.discard(i) if op == "d" else live.add(i)
        history.append((i, pos, op, None if op == "d" else f"v{pos}"))
    rows, marks = [], []
    for chunk in range(5):                                      # key 50 and above is in no chunk
        low = rng.randrange(0, 300)
        high = low + rng.randrange(0, 100)
        seen = as_of(history, rng.randint(low, high))           # the read falls anywhere between the marks
        rows += [(i, v) for i, v in seen.items() if i // 10 == chunk]
        marks.append((chunk, low, high))
    log = history + rng.sample(history, 100)                    # delivered twice
    rng.shuffle(log)
    args = (spark.createDataFrame(rows, "id bigint, v string"), spark.createDataFrame(marks, "chunk bigint, low bigint, high bigint"),
            spark.createDataFrame(log, LOG), "id", lambda k: F.floor(k / 10).cast("bigint"), ["v"])
    stream = snapshot_then_log(*args)
    got = stream.collect()
    assert len(got) == len({(r["id"], r["pos"], r["op"] == "r") for r in got})
    assert {r["id"]: r["v"] for r in table_after(stream, "id", ["v"]).collect()} == as_of(history, 10 ** 9)


def test_empty_inputs(spark):
    none = lambda s: spark.createDataFrame([], s)
    chunk = lambda k: F.floor(k / 10).cast("bigint")
    rows, marks = none("id bigint, v string"), none("chunk bigint, low bigint, high bigint")
    assert snapshot_then_log(rows, marks, none(LOG), "id", chunk, ["v"]).count() == 0
    got = snapshot_then_log(rows, marks, spark.createDataFrame([(1, 5, "c", "a")], LOG), "id", chunk, ["v"]).collect()
    assert [tuple(r) for r in got] == [(1, 5, "c", "a")]


def test_chunks_are_read_once_and_a_restart_goes_on(spark, tmp_path):
    reads, clock = [], iter(range(0, 1000, 10))

    def read(first, end):
        reads.append(first)
        if first == 20 and reads.count(20) == 1:
            raise RuntimeError("lost")
        return spark.range(first, end).select("id", F.col("id").cast("string").alias("v"))
    bounds = [(0, 0, 10), (1, 10, 20), (2, 20, 30)]
    with pytest.raises(RuntimeError):
        read_chunks(spark, bounds, read, lambda: next(clock), str(tmp_path))
    rows, marks = read_chunks(spark, bounds, read, lambda: next(clock), str(tmp_path))
    assert reads == [0, 10, 20, 20] and sorted(r["id"] for r in rows.collect()) == list(range(30))
    assert sorted(tuple(r) for r in marks.collect()) == [(0, 0, 10), (1, 20, 30), (2, 50, 60)]
