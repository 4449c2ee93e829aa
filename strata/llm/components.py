"""Connected components of an edge list, by repeated contraction.

First every partition replaces its edges by a spanning forest of them, without a shuffle.  Each
round then relabels every vertex with a bijective hash (``xxhash64`` of one long is invertible, so
labels stay unique), lets every vertex adopt the smallest label among itself and its neighbours
and contracts the edges.  A vertex has a fair chance of disappearing in each round whatever the
shape of the component, so the number of rounds is logarithmic.  What is left of the contracted
graph when it has at most LAST_EDGES edges is finished by one task.  All other steps are combining
aggregates and joins with a unique side: a hub with very many edges is pre-aggregated, and in a
join its rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import join_unique, written

FOREST_EDGES = 1 << 20     # edges a task holds at once
LAST_EDGES = 1 << 20       # of the contracted graph, 16 bytes each


def smallest_of_component(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct vertices of the edges ``a[i] - b[i]``, and the smallest vertex of each one's component."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    label, left, right = np.arange(len(nodes)), places[:len(a)], places[len(a):]
    while len(left):
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while not np.array_equal(label, jumped := label[label]):
            label = jumped
        open_ = label[left] != label[right]
        left, right = left[open_], right[open_]
    return nodes, nodes[label]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition as edges from each vertex to the smallest of its component there."""
    held, n = [], 0

    def grown() -> tuple[np.ndarray, np.ndarray]:
        a, b = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        nodes, root = smallest_of_component(a, b)
        return root[nodes != root], nodes[nodes != root]

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")))
        n += batch.num_rows
        if n > FOREST_EDGES:
            a, b = grown()
            held, n = [(a, b)], len(a)
            if 2 * n > FOREST_EDGES:      # a forest so large leaves as it is, and the next one starts
                yield out(a, b)
                held, n = [], 0
    if held:
        yield out(*grown())


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges of a small graph as (vertex, smallest vertex of its component)."""
    held = [tuple(b.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")) for b in batches]
    if held:
        nodes, root = smallest_of_component(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(root, pa.int64())], ["x", "m"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, comp)`` for every vertex that occurs in an edge between different vertices.

    ``comp`` is the smallest vertex of the component.  Null ends are ignored; an empty edge
    list gives an empty result; repeated edges and loops change nothing.
    """
    def forest(pairs: DataFrame) -> DataFrame:
        return written(pairs.mapInArrow(_forest, "a bigint, b bigint"), "edges")
    pairs = forest(edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).where("a <> b"))
    nodes, n_nodes, step = None, 0, 0
    while (n_pairs := pairs.count()) > LAST_EDGES:
        def label(c):
            return F.xxhash64(F.lit(step).cast("bigint"), F.col(c))
        if nodes is None:
            nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("cur", F.col("node")), "nodes")
            n_nodes = nodes.count()
        both = pairs.select(F.explode(F.array(F.struct(label("a").alias("x"), label("b").alias("y")),
                                              F.struct(label("b").alias("x"), label("a").alias("y")))).alias("e")).select("e.*")
        best = both.groupBy("x").agg(F.min("y").alias("m"), F.count("*").alias("n"))
        best = written(best.select("x", F.least("x", "m").alias("m"), "n"), "best")
        moved = nodes.select("node", label("cur").alias("x"))
        nodes = written(_renamed(moved, best, n_nodes).select("node", F.col("m").alias("cur")), "nodes")
        one = pairs.select(label("a").alias("x"), label("b").alias("y"))
        one = join_unique(one, best, ["x"], "n", 2 * n_pairs).select(F.col("m").alias("p"), F.col("y").alias("x"))
        one = join_unique(one, best, ["x"], "n", 2 * n_pairs).select(F.col("p").alias("a"), F.col("m").alias("b"))
        pairs = forest(one.where("a <> b").distinct())
        step += 1
    last = written(pairs.coalesce(1).mapInArrow(_finished, "x bigint, m bigint"), "last")
    if nodes is None:
        return last.select(F.col("x").alias("node"), F.col("m").alias("comp"))
    nodes = written(_renamed(nodes.select("node", F.col("cur").alias("x")), last, n_nodes).select("node", F.col("m").alias("cur")), "nodes")
    first = nodes.groupBy("cur").agg(F.min("node").alias("comp"), F.count("*").alias("n"))
    return join_unique(nodes, first, ["cur"], "n", n_nodes).select("node", "comp")


def _renamed(nodes: DataFrame, best: DataFrame, n_nodes: int) -> DataFrame:
    """``(node, m)``: the new label of every vertex; labels without an edge stay."""
    held = nodes.groupBy("x").agg(F.count("*").alias("n")).join(best.select("x", "m"), "x", "left")
    return join_unique(nodes, held.select("x", F.coalesce("m", "x").alias("m"), "n"), ["x"], "n", n_nodes).select("node", "m")
