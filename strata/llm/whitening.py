"""Whitening of vectors by an incremental eigendecomposition of their covariance.

Partitions keep the spectrum of what they have read: count, mean, and eigenpairs of the centred
scatter.  A vector adds a centred rank-one term, whose eigenpairs come from the secular equation
after deflation of directions it doesn't touch and of equal eigenvalues.  Spectra are combined in
groups, level by level, by successive rank-one updates with the other's eigenpairs and the
difference of means.  A last pass over the vectors refines the basis: the exact covariance is
projected on it, and the small projected matrix is solved (Rayleigh-Ritz).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, id_back, id_key, written

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
LIMIT = 2 ** 48             # a scaled entry beyond has no exact place here
FAN_IN = 8                  # spectra combined by one task
EPS = np.finfo(np.float64).eps
CLOSE = 1e-12               # what may be left of the secular function, against its terms
NO_VARIANCE = 1e-12         # an eigenvalue below this share of the trace is zero


# ---- rank-one updates ---------------------------------------------------------------------

def _secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z2 / (d - x)) = 0`` for ascending, distinct ``d`` and positive ``z2``.

    Returns the roots and the matrix ``d[j] - root[i]``, exact near the poles: a root is a distance
    ``tau`` from its nearer pole.  Each step fits one term to the poles on either side of the root
    and solves the quadratic; a step that leaves the bracket is a bisection instead."""
    m = len(d)
    gap = np.append(d[1:] - d[:-1], z2.sum())
    todo = np.arange(m)
    left = np.tri(m)                        # poles up to the root's own are left of it
    delta = d[None, :] - (d + gap / 2)[:, None]
    f, size, step = _secular_step(delta, left, z2, todo)
    right = (f < 0) & (todo < m - 1)
    origin = np.where(right, todo + 1, todo)
    tau = np.where(right, -gap / 2, gap / 2)
    low, high = np.where(right | (f < 0), tau, 0.0), np.where(right, 0.0, np.where(f < 0, gap, tau))
    poles = d[None, :] - d[origin][:, None]
    at, own, own_left, own_poles = tau, slice(None), left, poles
    for _ in range(80):
        found = np.abs(f) <= CLOSE * size
        lo, hi, new = low[own], high[own], at + step
        new = np.where((new > lo) & (new < hi), new, (lo + hi) / 2)       # false for a step that is no number
        tau[own] = at = np.where(found, at, new)
        if found.all():
            break
        if found.any():
            keep = ~found
            todo, own_left, own_poles, at = todo[keep], own_left[keep], own_poles[keep], at[keep]
            own = todo
        f, size, step = _secular_step(own_poles - at[:, None], own_left, z2, todo)
        high[own], low[own] = np.where(f > 0, at, high[own]), np.where(f > 0, low[own], at)
    return d[origin] + tau, poles - tau[:, None]


def _secular_step(delta: np.ndarray, left: np.ndarray, z2: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The secular function, the sum of its terms' sizes, and the step to the root of its two-pole fit."""
    inverse = 1 / delta
    inner = inverse * left
    total, below_f = inverse @ z2, inner @ z2
    below = (inner * inverse) @ z2
    above = (inverse * inverse) @ z2 - below
    f, rows, m = 1 + total, np.arange(len(roots)), len(z2)
    last = roots == m - 1
    near, far = delta[rows, roots], np.where(last, 0.0, delta[rows, np.minimum(roots + 1, m - 1)])
    c = f - near * below - far * above
    with np.errstate(divide="ignore", invalid="ignore"):
        a = c * (near + far) + near * near * below + far * far * above
        b = near * far * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        step = np.where(last, near + near * near * below / c, step)
    return f, 1 + total - 2 * below_f, step


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``basis @ diag(values) @ basis.T + v v'``; ``values`` ascend."""
    z = basis.T @ v
    size = float(z @ z)
    if size == 0.0:
        return values, basis
    least = 8 * EPS * max(float(values[-1]), size)
    # equal eigenvalues: turn their directions so that one alone meets v
    breaks = np.flatnonzero(np.diff(values) > least) + 1
    if len(breaks) + 1 < len(values):
        basis = basis.copy()
        for a, b in zip(np.append(0, breaks), np.append(breaks, len(values))):
            if b - a > 1:
                u = z[a:b].copy()
                length = np.sqrt(u @ u)
                if length > 0:
                    sign = 1.0 if u[-1] >= 0 else -1.0
                    u[-1] += sign * length
                    u /= np.sqrt(u @ u)
                    basis[:, a:b] -= 2 * np.outer(basis[:, a:b] @ u, u)
                    z[a:b], z[b - 1] = 0.0, -sign * length
    active = np.flatnonzero(np.abs(z) * np.sqrt(size) > least)
    if not len(active):
        return values, basis
    d, z_ = values[active], z[active]
    roots, delta = _secular_roots(d, z_ * z_)
    # the vector for which these roots are exact, so that eigenvectors are orthogonal
    ratio = d[None, :] - d[:, None]
    np.fill_diagonal(ratio, 1.0)
    fitted = np.copysign(np.sqrt(np.abs((delta / ratio).prod(0))), z_)
    turn = fitted[None, :] / delta
    turn /= np.sqrt((turn * turn).sum(1))[:, None]
    whole = len(active) == len(values)
    turned = (basis if whole else basis[:, active]) @ turn.T
    if whole:
        return roots, turned
    values, basis = values.copy(), basis.copy()
    values[active], basis[:, active] = roots, turned
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


@dataclass
class Spectrum:
    """Count, exact sums, mean and eigenpairs of the centred scatter of some vectors (less ``OFFSET``)."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @staticmethod
    def empty(dims: int) -> Spectrum:
        return Spectrum(0, [0] * dims, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def add(self, x: np.ndarray) -> None:
        """A vector: a rank-one update with what it differs from the mean."""
        off = x - self.mean
        self.values, self.basis = rank_one(self.values, self.basis, off * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + off / self.n

    def combine(self, other: Spectrum) -> None:
        for value, direction in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, direction * np.sqrt(value))
        off, n = other.mean - self.mean, self.n + other.n
        self.values, self.basis = rank_one(self.values, self.basis, off * np.sqrt(self.n / n * other.n))
        self.mean = self.mean + off * (other.n / n)
        self.n, self.sums = n, [a + b for a, b in zip(self.sums, other.sums)]

    def row(self, dims: int, part: int) -> tuple:
        return dims, part, self.n, json.dumps(self.sums), self.mean.tobytes(), self.values.tobytes(), self.basis.tobytes()

    @staticmethod
    def of(dims: int, n: int, sums: str, mean: bytes, values: bytes, basis: bytes) -> Spectrum:
        one = lambda b: np.frombuffer(b, np.float64).copy()
        return Spectrum(n, json.loads(sums), one(mean), one(values), one(basis).reshape(dims, dims))


STATE = "dims int, part int, n bigint, sums string, mean binary, spectrum binary, basis binary"
STATE_NAMES = ["dims", "part", "n", "sums", "mean", "spectrum", "basis"]


def _by_length(batch: pa.RecordBatch):
    """``(dims, the rows of that length, their vectors as a matrix)``; empty vectors are left out."""
    lengths = pc.list_value_length(batch.column("x"))
    for d in pc.unique(lengths).to_pylist():
        if d:
            part = batch.filter(pc.equal(lengths, d))
            yield d, part, part.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def spectra(fit: DataFrame) -> dict[int, Spectrum]:
    """The spectrum of the vectors ``x`` of each length; the driver gets the last one of each length."""
    def updated(batches):
        own: dict[int, Spectrum] = {}
        for batch in batches:
            for d, _, x in _by_length(batch):
                state = own.setdefault(d, Spectrum.empty(d))
                x = x - OFFSET
                state.sums = [a + b for a, b in zip(state.sums, x.sum(0).tolist())]
                for row in x.astype(np.float64):
                    state.add(row)
        rows = [s.row(d, TaskContext.get().partitionId()) for d, s in own.items()]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=STATE_NAMES), schema=schema, preserve_index=False)

    def combined(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        states = [Spectrum.of(*r) for r in pdf[["dims", "n", "sums", "mean", "spectrum", "basis"]].itertuples(index=False)]
        first = max(states, key=lambda s: s.n)
        for s in states:
            if s is not first:
                first.combine(s)
        return pd.DataFrame([first.row(int(pdf["dims"].iloc[0]), int(pdf["part"].iloc[0]) // FAN_IN)], columns=STATE_NAMES)
    schema = pa.schema([("dims", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("sums", pa.string()), ("mean", pa.binary()),
                        ("spectrum", pa.binary()), ("basis", pa.binary())])
    states = cut(fit.mapInArrow(updated, STATE))
    top = states.agg(F.max("part")).first()[0] or 0
    while top > 0:
        states = states.groupBy("dims", F.floor(F.col("part") / FAN_IN)).applyInPandas(combined, STATE)
        top //= FAN_IN
    return {r["dims"]: Spectrum.of(r["dims"], r["n"], r["sums"], bytes(r["mean"]), bytes(r["spectrum"]), bytes(r["basis"]))
            for r in states.toLocalIterator()}


# ---- refinement ---------------------------------------------------------------------------

@dataclass
class Model:
    """``n``, exact sums ``sums`` of x, and the leading components with their eigenvalues, of one length."""

    n: int
    sums: list[int]
    basis: np.ndarray
    values: np.ndarray
    trace: float
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n``: the whole part of the mean is taken off in integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        return (x - whole) - np.array([s % self.n / self.n for s in self.sums])

    def scores(self, x: np.ndarray) -> np.ndarray:
        scale = np.zeros(len(self.values))
        some = self.values > NO_VARIANCE * self.trace
        scale[some] = 1 / np.sqrt(self.values[some])
        return self.centred(x) @ self.basis * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """``sum((n * x - sums) ** 2)`` in whole numbers; null beyond the range of long."""
        largest = max((abs(int(v)) for v in (x.min(), x.max())), default=0) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if len(self.sums) * largest ** 2 < 2 ** 63 else object
        off = x.astype(kind) * self.n - np.array(self.sums, kind)
        if kind is object:
            return [v if v < 2 ** 63 else None for v in (off * off).sum(1).tolist()]
        return (off * off).sum(1).tolist()


def _products(fit: DataFrame, made: dict[int, Model], view) -> dict[int, np.ndarray]:
    """``sum(y' y) / n`` over the fit list for each length, where ``y = view(model, x)``.  Tasks add up
    their rows; the driver gets one number for each pair of columns."""
    models = fit.sparkSession.sparkContext.broadcast(made)

    def added(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _by_length(batch):
                y = view(models.value[d], x)
                total[d] = total.get(d, 0.0) + y.T @ y
        for d, t in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(t.size, d, np.int32)), pa.array(np.arange(t.size, dtype=np.int32)),
                                              pa.array(t.ravel())], ["dims", "cell", "v"])
    cells: dict[int, dict[int, float]] = {}
    for r in fit.mapInArrow(added, "dims int, cell int, v double").groupBy("dims", "cell").agg(F.sum("v").alias("v")).toLocalIterator():
        cells.setdefault(r["dims"], {})[r["cell"]] = r["v"]
    out = {}
    for d, c in cells.items():
        side = round(len(c) ** 0.5)
        m = np.array([c[i] for i in range(side * side)]).reshape(side, side) / made[d].n
        out[d] = (m + m.T) / 2
    return out


def models(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """Whitening models of the distinct vectors ``fit`` (column ``x``), by length."""
    found = spectra(fit)
    start = {d: Model(s.n, [v + OFFSET * s.n for v in s.sums], np.linalg.qr(s.basis)[0], s.values, 0.0) for d, s in found.items()}
    out = {}
    for d, small in _products(fit, start, lambda m, x: m.centred(x) @ m.basis).items():
        values, turn = np.linalg.eigh(small)
        order = np.argsort(-values, kind="stable")[:components]
        basis = start[d].basis @ turn[:, order]
        basis *= np.where(basis[np.abs(basis).argmax(0), np.arange(basis.shape[1])] < 0, -1.0, 1.0)
        out[d] = Model(start[d].n, start[d].sums, basis, np.maximum(values[order], 0.0), float(np.trace(small)))
    for d, m in _products(fit, out, Model.scores).items():
        some = out[d].values > NO_VARIANCE * out[d].trace
        if some.any():
            out[d].error = float(np.abs(m[some][:, some] - np.eye(int(some.sum()))).max())
    return out


def whitened(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET,
             id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of every row whose vector is fit.

    An entry c becomes ``x = floor(scale * c) + offset``.  Vectors that are null or hold a null,
    non-finite or huge entry (2**48 or more when scaled) are dropped.  Each distinct x counts once for the
    model; every row is given back, repeated ids and vectors too.  Vectors of each length have a model of their
    own; an empty vector has no components.  A component without variance has whitened 0 and takes no part in
    ``identity_error``; explained is 0 if nothing varies.  A deviation beyond the range of long is null.  An
    empty table gives an empty result.  The driver and tasks hold a matrix of dims x dims for each length."""
    scaled = lambda c: c.cast("double") * F.lit(float(scale))
    rows = vectors.select(id_key(id_col).alias("id"), F.col(vector_col).alias("_v")) \
        .where(F.col("_v").isNotNull() & F.forall("_v", lambda c: F.coalesce(F.abs(scaled(c)) < LIMIT, F.lit(False)))) \
        .select("id", F.transform("_v", lambda c: F.floor(scaled(c)).cast("bigint") + F.lit(offset).cast("bigint")).alias("x"))
    made = models(written(rows.select("x").distinct(), "whitening"), components)
    known = vectors.sparkSession.sparkContext.broadcast(made)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]

    def applied(batches):
        for batch in batches:
            for d, part, x in _by_length(batch):
                m = known.value[d]
                k = len(m.values)
                ids = np.repeat(part.column("id").to_numpy(), k)
                off = pa.array(m.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
                share = m.values / m.trace if m.trace > 0 else np.zeros(k)
                columns = [ids, np.tile(np.arange(1, k + 1), len(x)), np.full(len(ids), m.n), off, m.scores(x).ravel(),
                           np.tile(share, len(x)), np.full(len(ids), m.error)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds)], names)
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    return rows.mapInArrow(applied, schema).withColumn("vec_id", id_back("vec_id"))
