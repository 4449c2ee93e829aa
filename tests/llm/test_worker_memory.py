"""What a task keeps in Python workers: one worker at a time, and a batch in parts."""

import re
import tracemalloc

import pyarrow as pa

from strata.llm import components as components_module
from strata.llm import packing, secret_crf, simhash
from strata.llm.common import table, written

SF = "/root/testdata/sf0.001"
PYTHON = re.compile(r"InPandas|InArrow|EvalPython|PythonMapInArrow")


def chained_python_steps(plan: str) -> list[tuple[str, str]]:
    """Pairs of Python steps of a plan that lie in one stage, one above the other: a task has a worker for each."""
    above, out = [], []
    for line in plan.splitlines():
        m = re.search(r"[A-Za-z]", line)
        if m:
            step = re.sub(r"^\(\d+\) ", "", line[m.start():]).split()[0]
            above = [x for x in above if x[0] < m.start()]
            for _, higher in reversed(above):
                if "Exchange" in higher:
                    break
                if PYTHON.search(step) and PYTHON.search(higher):
                    out.append((higher, step))
            above.append((m.start(), step))
    return out


def test_near_duplicates_have_one_python_worker_a_task(spark, monkeypatch):
    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)
    monkeypatch.setattr(simhash, "written", noted)
    monkeypatch.setattr(components_module, "written", noted)
    docs = table(spark, SF, "documents")
    out = simhash.near_duplicates(docs)
    assert out.count() == docs.count()
    assert {"fingerprints", "edges", "last"} <= set(plans)
    assert any(PYTHON.search(p) for p in plans.values())
    assert {name: found for name, p in plans.items() if (found := chained_python_steps(p))} == {}


def test_secrets_are_scanned_in_parts_of_a_batch(spark, monkeypatch):
    asked = []

    class Noted(secret_crf.Scanner):
        def scan(self, texts):
            asked.append(len(texts))
            return super().scan(texts)
    monkeypatch.setattr(secret_crf, "PART_TEXTS", 7)
    texts = [None if i % 5 == 0 else f"row {i} has password=abc123xyz{i} in it" if i % 3 == 0 else f"row {i}" * (i % 4) for i in range(40)]
    scanner = Noted(None)
    parts = list(secret_crf.cleaned_parts(lambda: scanner, [pa.array(texts[:23]), pa.array([], pa.string()), pa.array(texts[23:])]))
    assert max(map(len, parts)) <= 7 and max(asked) <= 7 and sum(asked) == 40
    spans = [[(a, b) for _, a, b in secret_crf.scan(t, None)] for t in texts]
    assert [t for p in parts for t in p.to_pylist()] == [secret_crf.redact(t, s) for t, s in zip(texts, spans)]


def test_secret_columns_keep_the_order_of_rows(spark, monkeypatch):
    """Batches come back in other sizes than they went out; every row keeps its own result."""
    monkeypatch.setattr(secret_crf, "PART_TEXTS", 3)
    texts = [None if i % 11 == 0 else f"the key {i} is password=abc123xyz{i} here" for i in range(100)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").coalesce(2)
    clean = {r["doc_id"]: r["text"] for r in secret_crf.redacted(docs).collect()}
    assert len(clean) == 100 and all(clean[i] is None if t is None else f"xyz{i} " not in clean[i] and f"key {i} " in clean[i]
                                     for i, t in enumerate(texts))
    found = {r["doc_id"]: r["secrets"] for r in secret_crf.secrets(docs).collect()}
    for i, t in enumerate(texts):
        assert [t[s["start"]:s["end"]] for s in found[i] if s["kind"] == "assign"] == ([] if t is None else [f"password=abc123xyz{i}"])


def test_packing_holds_a_part_of_a_batch_as_strings(spark, monkeypatch):
    n, text = 4000, "word " * 1000
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: f)
    cut_up = packing.pieces(docs)
    packing.tokenizer(packing.TOKENIZER).ids(text)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([text] * n)], ["doc_id", "text"])
    tracemalloc.start()
    seen = [i for out in cut_up([batch]) for i in out.column("doc_id").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(set(seen)) == list(range(n))
    assert peak < batch.nbytes / 2
