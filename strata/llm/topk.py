"""Exact top-k by inner product: dual-tree search over cover trees.

Data and queries are dealt to blocks; a task gets one block of each, builds a cover tree over
either and walks pairs of nodes.  For a query node (centre u, covering radius r) and a data node
(centre c, covering radius s) no product exceeds  u.c + |u| s + r |c| + r s ; a pair goes when
that is below the worst kth score of the query node's queries.  The best k of every block pair
are then merged.  Nothing is approximated: the bound only ever drops pairs that cannot win.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import id_back, id_key, written

LEAF, FAN = 128, 32
DATA_BLOCK, QUERY_BLOCK = 8192, 4096


class Node:
    """A node of the cover tree: centre, covering radius, its points and its children."""

    __slots__ = ("centre", "norm", "radius", "points", "children", "worst")

    def __init__(self, centre, radius, points, children):
        self.centre, self.radius, self.points, self.children = centre, radius, points, children
        self.norm, self.worst = float(np.linalg.norm(centre)), -np.inf


def cover_tree(x: np.ndarray, points: np.ndarray | None = None, centre: np.ndarray | None = None) -> Node:
    """Children are centres chosen farthest first until they cover the node at half its radius (or
    FAN of them), so centres are separated and every point lies within the covering radius."""
    points = np.arange(len(x)) if points is None else points
    own = x[points]
    centre = own.mean(axis=0) if centre is None else centre
    gap = np.linalg.norm(own - centre, axis=1)
    radius = float(gap.max()) * (1 + 1e-12) if len(points) else 0.0
    if len(points) <= LEAF or radius == 0.0:
        return Node(centre, radius, points, [])
    nearest, owner, centres = np.full(len(points), np.inf), np.zeros(len(points), np.int64), []
    pick = int(np.argmax(gap))
    while len(centres) < FAN and (not centres or nearest[pick] > radius / 2):
        d = np.linalg.norm(own - own[pick], axis=1)
        owner[d < nearest] = len(centres)
        nearest = np.minimum(nearest, d)
        centres.append(own[pick])
        pick = int(np.argmax(nearest))
    if len(centres) == 1:
        return Node(centre, radius, points, [])
    children = [cover_tree(x, points[owner == i], c) for i, c in enumerate(centres) if (owner == i).any()]
    if len(children) == 1:
        return Node(centre, radius, points, [])
    return Node(centre, radius, points, children)


class Best:
    """The k best (score, id) of every query so far; smaller ids win ties."""

    def __init__(self, n: int, k: int):
        self.k, self.rows = k, [[] for _ in range(n)]
        self.worst = np.full(n, -np.inf)

    def offer(self, q: int, scores, ids) -> None:
        rows = self.rows[q] + list(zip((-scores).tolist(), ids.tolist()))
        rows.sort()
        self.rows[q] = rows[:self.k]
        if len(self.rows[q]) == self.k:
            self.worst[q] = -self.rows[q][-1][0]


def dual_search(queries: np.ndarray, query_rows: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int,
                data_rows: np.ndarray | None = None) -> Best:
    """Top ``k`` of ``data`` for every row of ``queries`` (integer matrices), ties to smaller ids; the
    row of the same number (``data_rows``, else the ids) is left out."""
    data_rows = data_ids if data_rows is None else data_rows
    biggest = max((int(np.abs(m).max()) if m.size else 0) for m in (queries, data))
    kind = np.float64 if biggest * biggest * max(1, data.shape[1]) < 1 << 52 else object
    q, x = queries.astype(np.float64), data.astype(np.float64)
    exact_q, exact_x = (q, x) if kind is np.float64 else (queries.astype(object), data.astype(object))
    best = Best(len(q), k)
    if not len(q) or not len(x):
        return best
    slack = 0.25 + 1e-9 * float(np.linalg.norm(q, axis=1).max()) * float(np.linalg.norm(x, axis=1).max())

    def bounds(u: Node, nodes: list[Node]) -> np.ndarray:
        centres = np.stack([n.centre for n in nodes])
        s, norm = np.array([n.radius for n in nodes]), np.array([n.norm for n in nodes])
        return centres @ u.centre + u.norm * s + u.radius * norm + u.radius * s

    def base(u: Node, v: Node) -> None:
        scores = exact_q[u.points] @ exact_x[v.points].T
        ids = data_ids[v.points]
        good = (scores >= best.worst[u.points][:, None]) & (query_rows[u.points][:, None] != data_rows[v.points][None, :])
        for i in np.flatnonzero(good.any(axis=1)):
            take = np.flatnonzero(good[i])
            if len(take) > 4 * k:
                kth = np.partition(scores[i][take], len(take) - k)[len(take) - k]
                take = take[scores[i][take] >= kth]
            best.offer(int(u.points[i]), scores[i][take], ids[take])

    def walk(u: Node, v: Node, bound: float) -> None:
        u.worst = max(u.worst, float(best.worst[u.points].min()))
        if bound + slack < u.worst:
            return
        if not u.children and not v.children:
            base(u, v)
        elif u.children and (not v.children or u.radius > v.radius):
            for child in u.children:
                walk(child, v, float(bounds(child, [v])[0]))
        else:
            high = bounds(u, v.children)
            for i in np.argsort(-high, kind="stable"):
                walk(u, v.children[i], float(high[i]))

    top_q, top_x = cover_tree(q), cover_tree(x)
    walk(top_q, top_x, np.inf)
    return best


def quantized(embedding: str | Column) -> Column:
    """floor(256 x) of every component; null where the vector is null, empty or has a null or
    non-finite component."""
    c = F.col(embedding) if isinstance(embedding, str) else embedding
    wide = c.cast("array<double>")
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when((F.size(wide) > 0) & fine, F.transform(wide, lambda x: F.floor(x * 256)))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest inner products of quantized vectors.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's
    own; ties go to the smaller id (a null id is the largest, given back as null), and a query with
    fewer candidates gets them all.  Vectors that are null, empty or hold null or non-finite
    components take no part; vectors of different length do not meet.  Rows that repeat an id are
    candidates and, if divisible, queries each: every such query has its own ranks, and the other
    rows of its id are among its candidates.  Products beyond a long are stopped at its limits.
    An empty table gives an empty result."""
    rows = vectors.select(id_key(id_col).alias("id"), F.coalesce(F.col(id_col).cast("bigint") % every == 0, F.lit(False)).alias("asks"),
                          quantized(vec_col).alias("v"))
    # Rows get their numbers once, in a written table: an id may repeat.
    rows = written(rows.where("v is not null").withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    is_query = F.col("asks")
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    data_blocks, query_blocks = -(-counts["n"] // DATA_BLOCK) or 1, -(-counts["q"] // QUERY_BLOCK) or 1
    dealt = F.pmod(F.xxhash64("row"), F.lit(2 ** 31)).cast("bigint")
    data = rows.withColumn("d", dealt % data_blocks).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = rows.where(is_query).withColumn("q", (dealt % query_blocks).cast("int")) \
        .withColumn("d", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(data_blocks - 1).cast("bigint"))))

    def searched(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
        qid, xid = q["id"].to_numpy(np.int64), x["id"].to_numpy(np.int64)
        qrow, xrow = q["row"].to_numpy(np.int64), x["row"].to_numpy(np.int64)
        best = dual_search(np.stack(q["v"].to_numpy()), qrow, np.stack(x["v"].to_numpy()), xid, k, xrow)
        low, high = -2 ** 63, 2 ** 63 - 1
        found = [(int(qrow[i]), int(qid[i]), int(v), min(max(int(-s), low), high)) for i, r in enumerate(best.rows) for s, v in r]
        return pd.DataFrame(found, columns=["row", "query_id", "vec_id", "score"]).astype("int64")

    keys = ["dim", "q", "d"]
    found = queries.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInPandas(
        searched, "row bigint, query_id bigint, vec_id bigint, score bigint")
    ranked = found.withColumn("rank", F.row_number().over(
        Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", id_back("vec_id").alias("vec_id"), "score")
