"""Embedding near-duplicates by an exact metric range join.

On the unit sphere ``cos >= t`` is a distance of at most ``r = sqrt(2 - 2 t)``.  Pivots split the
vectors of a label into cells (nearest pivot).  By the triangle inequality a vector x of cell i
can only be within r of a vector y of cell j if  d(x, p_j) <= d(x, p_i) + 2 r  and
d(x, p_j) <= R_j + r  with R_j the radius of cell j; exactly those cells get a copy of x.  Of two
cells only the later one gets the copy, so a pair meets once, and cells join independently.
A cell beyond BLOCK rows is joined as pairs of blocks.  Only link counts and a spanning forest
leave a block pair, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_back, id_key, join_unique, written
from strata.llm.components import components
from strata.llm.simhash import local_roots

BLOCK = 2048          # rows of a block of a cell
CELL = 4096           # vectors a cell should hold
MAX_PIVOTS = 4096     # over all labels; beyond it cells grow, and with them their blocks


def _classes(rows: DataFrame) -> DataFrame:
    """Equal vectors of a label as one class, with its smallest id.  ``rep`` numbers the classes (ids
    may repeat); it holds only once the frame is materialised."""
    classes = rows.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    return classes.withColumn("rep", F.monotonically_increasing_id())


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def range_links(classes: DataFrame, threshold: float) -> DataFrame:
    """``(rep, root, n)`` per class and block pair: a link of the class's component there and the
    number of vectors of other classes it links with there.  ``classes``: label, v, rep, copies;
    v is a valid vector, classes are distinct within their label and ``rep`` is unique.  Pivots and
    blocks are drawn by the vectors, so they don't depend on how the classes were numbered."""
    spark = classes.sparkSession
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    slack = 1e-7   # distances near zero carry rounding of about 1e-8; more copies do no harm
    rows = classes.withColumn("part", F.struct("label", F.size("v").alias("dim")))
    drawn = F.xxhash64("label", "v")
    total = rows.count()
    cell_rows = max(CELL, -(-total // MAX_PIVOTS))
    sizes = rows.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows)
    # At most total / cell_rows <= MAX_PIVOTS labels have pivots, and so many pivots in all.
    wanted = {(r["part"]["label"], r["part"]["dim"]): -(-r["n"] // cell_rows) for r in sizes.collect()}
    share = F.pmod(drawn, F.lit(1 << 20)) / float(1 << 20)
    pivots: dict[tuple, np.ndarray] = {}
    if wanted:
        picked = rows.join(F.broadcast(sizes), "part") \
            .where(share < 2.0 * F.ceil(F.col("n") / cell_rows) / F.col("n")).select("part", "v", drawn.alias("drawn"))
        for r in picked.orderBy("drawn").collect():
            pivots.setdefault((r["part"]["label"], r["part"]["dim"]), []).append(r["v"])
        pivots = {p: _unit(v[:wanted[p]]) for p, v in pivots.items()}
    held = spark.sparkContext.broadcast(pivots)

    def distances(part, x):
        p = held.value.get(part)
        return None if p is None else np.sqrt(np.maximum(0, 2 - 2 * (x @ p.T)))

    def homes(batches):
        for pdf in batches:
            home, gap = np.zeros(len(pdf), np.int32), np.zeros(len(pdf))
            parts = [(p["label"], p["dim"]) for p in pdf["part"]]
            for part in set(parts):
                at = np.array([i for i, p in enumerate(parts) if p == part])
                if part in held.value:
                    d = distances(part, _unit(pdf["v"].iloc[at]))
                    home[at], gap[at] = d.argmin(axis=1), d.min(axis=1)
            pdf["home"], pdf["gap"] = home, gap
            yield pdf
    schema = "label {l}, v {v}, rep bigint, copies bigint, part struct<label:{l},dim:int>, home int, gap double".format(
        l=dict(rows.dtypes)["label"], v=dict(rows.dtypes)["v"])
    housed = written(rows.select("label", "v", "rep", "copies", "part").mapInPandas(homes, schema), "housed")
    reach = {}
    if wanted:
        far = housed.join(F.broadcast(sizes.select("part")), "part").groupBy("part", "home").agg(F.max("gap").alias("far"))
        reach = {(r["part"]["label"], r["part"]["dim"], r["home"]): r["far"] for r in far.collect()}
    radii = spark.sparkContext.broadcast(reach)

    def copied(batches):
        for pdf in batches:
            cells = []
            for part, v, home in zip(pdf["part"], pdf["v"], pdf["home"]):
                part = (part["label"], part["dim"])
                d, own = distances(part, _unit([v])), [int(home)]
                if d is not None:
                    d = d[0]
                    for j in np.flatnonzero(d <= d[home] + 2 * radius + slack):
                        if j > home and d[j] <= radii.value.get((*part, int(j)), -9.0) + radius + slack:
                            own.append(int(j))
                cells.append(own)
            pdf["cells"] = cells
            yield pdf[["label", "v", "rep", "copies", "part", "home", "cells"]]
    schema2 = schema.replace(", gap double", ", cells array<int>")
    members = housed.mapInPandas(copied, schema2).withColumn("cell", F.explode("cells")).drop("cells")
    members = members.withColumn("own", F.col("cell") == F.col("home"))
    in_cell = members.groupBy("part", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocked = members.join(in_cell, ["part", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("part", "v", F.lit(1)), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, "block").alias("b1"), F.greatest(o, "block").alias("b2")))
    dealt = blocked.withColumn("pair", F.explode(pair)).select(
        "part", "cell", "pair", "block", "own", "v", "rep", "copies")

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.asarray(v, np.float64) for v in pdf["v"]])
        norm = np.linalg.norm(x, axis=1)
        own, rep = pdf["own"].to_numpy(bool), pdf["rep"].to_numpy(np.int64)
        copies, b = pdf["copies"].to_numpy(np.int64), pdf["block"].to_numpy()
        b1, b2 = int(pdf["pair"].iloc[0]["b1"]), int(pdf["pair"].iloc[0]["b2"])
        first, second = np.flatnonzero(b == b1), np.flatnonzero(b == b2)
        n, left, right = np.zeros(len(x), np.int64), [], []
        for at in range(0, len(first), 512):
            i = first[at:at + 512]
            near = (x[i] @ x[second].T) / (norm[i][:, None] * norm[second][None, :]) >= threshold
            near &= own[i][:, None] | own[second][None, :]
            near &= i[:, None] != second[None, :]
            n[i] += near @ copies[second]
            if b1 != b2:
                n[second] += copies[i] @ near
            p, q = np.nonzero(near)
            # first partner of each row and first row of each partner, then the rest by component
            left.append(i[p])
            right.append(second[q])
            if sum(map(len, left)) > 1 << 21:
                a, c = np.concatenate(left), np.concatenate(right)
                roots = local_roots(len(x), a, c)
                left, right = [np.arange(len(x))], [roots]
        a, c = (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int),) * 2
        roots = local_roots(len(x), a, c)
        linked = np.flatnonzero(n > 0)
        return pd.DataFrame({"rep": rep[linked], "root": rep[roots[linked]], "n": n[linked]})

    return dealt.groupBy("part", "cell", "pair").applyInPandas(joined, "rep bigint, root bigint, n bigint")


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id",
                 vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors``.

    Vectors of equal label with a cosine of at least ``threshold`` (double precision) link.
    Vectors with a null label, that are null, empty, zero or hold null or non-finite components
    link with nothing; vectors of different length do not link.  Equal vectors of a label are one
    class, joined once.  A null id is the largest id, given back as null; rows that repeat an id
    are vectors each.  An empty table gives an empty result; other columns are not read."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(id_key(id_col).alias("id"), F.col(label_col).alias("label"), v.alias("v"),
                          F.coalesce(F.col(label_col).isNotNull() & (F.size(v) > 0) & fine, F.lit(False)).alias("ok"))
    valid = rows.where("ok")
    classes = written(_classes(valid), "classes")
    found = written(range_links(classes, threshold), "links")
    comps = components(found, "rep", "root")
    counted = found.groupBy("rep").agg(F.sum("n").alias("n"))
    grouped = written(classes.join(counted, "rep", "left").join(comps, F.col("rep") == F.col("node"), "left").select(
        "label", "v", "id", "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("comp", "rep").alias("group")), "grouped")
    # Only here classes get ids: the component is named by the smallest one in it.
    first = grouped.groupBy("group").agg(F.min("id").alias("comp"), F.count("*").alias("members"))
    named = written(join_unique(grouped.drop("id"), first, ["group"], "members", grouped.count()).drop("group"), "named")
    total = classes.agg(F.sum("copies")).first()[0] or 0
    linked = join_unique(valid.drop("ok"), named, ["label", "v"], "copies", total).select("id", "n", "comp")
    alone = rows.where("not ok").select("id", F.lit(0).cast("bigint").alias("n"), F.col("id").alias("comp"))
    return linked.unionByName(alone).select(
        id_back("id").alias("vec_id"), F.col("n").alias("n_links"), id_back("comp").alias("component_id"),
        (F.col("id") == F.col("comp")).alias("kept"))
