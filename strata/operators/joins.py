"""Join helpers: first matches, enrichment lookups (J16-J20, U3), interval joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(dim: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order`` (a combining aggregate), the same in every run."""
    rest = [c for c in dim.columns if c not in keys]
    if not rest:
        return dim.distinct()
    ranked = dim.groupBy(*keys).agg(F.min(F.struct(*order, *[F.col(c).alias(f"__v{i}") for i, c in enumerate(rest)])).alias("__f"))
    return ranked.select(*keys, *[F.col(f"__f.__v{i}").alias(c) for i, c in enumerate(rest)])


def literal_broadcast(dim: DataFrame) -> DataFrame:
    """Broadcast a table built from literals in code (size fixed by construction)."""
    return F.broadcast(dim)


def enrich(fact: DataFrame, dim: DataFrame, fact_key: str | Sequence[str], dim_key: str | Sequence[str],
           columns: dict[str, str], default: dict[str, object] | None = None,
           unique: bool = False, literal: bool = False) -> DataFrame:
    """Left lookup of dimension attributes (the async/sync dim-join contract, J16/J17/U3).

    ``columns`` maps dim column -> output name.  Missing dims leave nulls, or the
    value from ``default`` (J20 uses 'N/A').  Of a key's dim rows the first in the order of
    the looked-up columns counts, so a lookup never multiplies fact rows (J23); pass
    ``unique=True`` for a dim whose key is unique by construction, ``literal=True`` for a
    table written in code (unique keys, size fixed: broadcast without a check).
    """
    fk = [fact_key] if isinstance(fact_key, str) else list(fact_key)
    dk = [dim_key] if isinstance(dim_key, str) else list(dim_key)
    tmp = [f"__k{i}" for i in range(len(dk))]
    d = (dim.select(*[F.col(c).alias(t) for c, t in zip(dk, tmp)],
                    *[F.col(c).alias(o) for c, o in columns.items()]))
    if literal:
        d = literal_broadcast(d)
    else:
        d = d if unique else first_match(d, tmp, [])
    cond = [fact[f] == d[t] for f, t in zip(fk, tmp)]
    out = fact.join(d, cond, "left").drop(*tmp)
    for name, val in (default or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(val)))
    return out


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                  lower_s: int, upper_s: int) -> DataFrame:
    """Inner interval join: ``right_ts BETWEEN left_ts + lower AND left_ts + upper`` (both inclusive).

    The range is turned into an equi-join on (keys, time bucket): buckets are as
    wide as the interval, the right side is tagged with its own bucket and the
    left side is exploded into the (at most three) buckets its range touches.  A
    user with many rows is thereby spread over many buckets and only rows that
    can match meet, never all pairs of a key.  Both sides must carry TIMESTAMP
    columns; column names other than the keys must not clash.
    """
    width = max(upper_s - lower_s, 1)
    lsec = F.unix_micros(F.col(left_ts)) / 1_000_000.0
    lo_b = F.floor((lsec + lower_s) / width)
    hi_b = F.floor((lsec + upper_s) / width)
    l2 = left.withColumn("__b", F.explode(F.sequence(lo_b.cast("bigint"), hi_b.cast("bigint"))))
    r2 = right.withColumn("__b", F.floor((F.unix_micros(F.col(right_ts)) / 1_000_000.0) / width).cast("bigint"))
    cond = [l2[k] == r2[k] for k in keys] + [l2["__b"] == r2["__b"]]
    cond.append(r2[right_ts] >= l2[left_ts] + F.expr(f"INTERVAL {lower_s} SECONDS"))
    cond.append(r2[right_ts] <= l2[left_ts] + F.expr(f"INTERVAL {upper_s} SECONDS"))
    joined = l2.join(r2, cond)
    return joined.select(*[l2[k] for k in keys],
                         *[l2[c] for c in left.columns if c not in keys],
                         *[r2[c] for c in right.columns if c not in keys])


def later_of(a: str, b: str) -> Column:
    """Event time of an interval-join result: the later of the two input times."""
    return F.greatest(F.col(a), F.col(b))


def lookup_chain(fact: DataFrame, steps: Sequence[tuple], how: str = "left") -> DataFrame:
    """A chain of dimension lookups through a snowflake.

    Each step is ``(dim, fact_key, dim_key, {dim_col: out_name})``;
    a later step may key on a column an earlier step added.  ``how='inner'`` drops
    facts whose chain breaks (the batch SQL form), ``'left'`` keeps them with nulls
    (the async-lookup form).  Which dim is broadcast is left to Spark's byte threshold.
    """
    out = fact
    for dim, fkey, dkey, cols in steps:
        d = dim.select(F.col(dkey).alias("__k"), *[F.col(c).alias(o) for c, o in cols.items()])
        d = first_match(d, ["__k"], [])
        out = out.join(d, out[fkey] == d["__k"], how).drop("__k")
    return out
