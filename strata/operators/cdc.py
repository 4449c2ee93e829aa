"""CDC parsing, validity filters, config-driven routing and column pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import merged
from strata.operators.scan import asof_last
from strata.sources.cdc import ENVELOPE_SCHEMA

FORM2_OPS = {"insert": "c", "update": "u", "delete": "d"}


def parse_envelopes(lines: DataFrame, line_col: str = "value", mode: str = "FAILFAST") -> DataFrame:
    """Parse change envelopes (null payloads dropped; a bad record fails the job).

    The parse is the element of a generator: evaluated once, not once for every field and filter above."""
    line = F.col(line_col)
    parsed = F.array(F.from_json(line, ENVELOPE_SCHEMA, {"mode": mode}))
    return lines.select(F.inline(F.when(line.isNotNull(), parsed)))


def normalise(env: DataFrame) -> DataFrame:
    """Both envelope forms to ``(db, table_name, op, is_bootstrap, before, after, ts_ms)``.

    Form 2: insert/update/delete -> c/u/d, ``bootstrap-*`` -> r flagged as
    bootstrap, ``data``/``old`` -> after/before (old holds only changed columns,
    so it is overlaid on data), ``ts`` seconds -> ms.
    """
    form1 = F.col("op").isNotNull()
    typ = F.col("type")
    op2 = F.coalesce(F.try_element_at(F.create_map(*[x for kv in FORM2_OPS.items() for x in map(F.lit, kv)]), typ),
                     F.when(typ.startswith("bootstrap-"), F.lit("r")))
    unchanged = F.map_filter(F.col("data"), lambda k, v: ~F.array_contains(F.map_keys(F.col("old")), k))
    before2 = F.when(F.col("old").isNotNull(), F.map_concat(unchanged, F.col("old")))
    before2 = F.when(typ == "delete", F.col("data")).otherwise(before2)
    return env.select(
        F.when(form1, F.col("source")["db"]).otherwise(F.col("database")).alias("db"),
        F.when(form1, F.col("source")["table"]).otherwise(F.col("table")).alias("table_name"),
        F.when(form1, F.col("op")).otherwise(op2).alias("op"),
        F.when(form1, F.lit(False)).otherwise(F.coalesce(typ.startswith("bootstrap-"), F.lit(False))).alias("is_bootstrap"),
        F.when(form1, F.col("before")).otherwise(before2).alias("before"),
        F.when(form1, F.col("after")).otherwise(F.when(typ != "delete", F.col("data"))).alias("after"),
        F.when(form1, F.col("ts_ms")).otherwise(F.col("ts") * 1000).alias("ts_ms"),
    )


def row_id(col: str = "id"):
    """The key taken from ``after`` or, for deletes, ``before``."""
    return F.coalesce(F.col("after")[col], F.col("before")[col])


def flat_change(after="after", before="before"):
    """P10: one change as a flat map: ``op`` and ``tm_ms``, then every field of ``after`` or, where
    that is missing or empty, of ``before`` (a field named like one of the two wins)."""
    has_after = F.coalesce(F.size(after) > 0, F.lit(False))
    head = F.create_map(F.lit("op"), F.col("op"), F.lit("tm_ms"), F.col("ts_ms").cast("string"))
    return merged(head, F.when(has_after, F.col(after)).otherwise(F.col(before)))


def flat_comment():
    """A comment change as a flat map: source db, table and server, op, time and the fields of
    ``after`` (``comment_txt`` as ``commentTxt``).  Null where the change has no ``after``."""
    a, src = F.col("after"), F.col("source")
    fields = {"ts_ms": F.col("ts_ms").cast("string"), "db": src["db"], "table": src["table"], "server_id": src["server_id"],
              "op": F.col("op"), "commentTxt": a["comment_txt"]}
    fields.update({k: a[k] for k in ("id", "order_id", "user_id", "appraise", "create_time")})
    return F.when(a.isNotNull(), F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)]))


def valid_changes(df: DataFrame, db: str, keep_deletes: bool = True, drop_bootstrap: bool = True) -> DataFrame:
    """P4 + P5: db matches, op in c/u/d/r, payload present.

    Literal reference form (``keep_deletes=False``): ``after`` must be a non-empty
    map, which also drops every delete.  Intent form keeps deletes that carry a
    ``before`` image.
    """
    has_after = F.coalesce(F.size("after") > 0, F.lit(False))
    has_before = F.coalesce(F.size("before") > 0, F.lit(False))
    payload = (has_after | ((F.col("op") == "d") & has_before)) if keep_deletes else has_after
    out = df.filter((F.col("db") == db) & F.col("op").isin("c", "u", "d", "r") & payload)
    if drop_bootstrap:
        out = out.filter(~F.col("is_bootstrap"))
    return out


def latest_config(config_changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P9 + J1 state: the current config rows from a config change stream.

    A config row is read from ``before`` on delete, else from ``after``; the
    last change per key wins and deleted keys disappear.  Output: one column per
    config field plus nothing else.
    """
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    c = config_changes.select("op", "ts_ms", row.alias("row"))
    key_cols = [F.col("row")[k].alias(k) for k in keys]
    last = (c.select(*key_cols, "op", "ts_ms", "row")
            .groupBy(*keys).agg(F.max_by(F.struct("op", "row"), F.col("ts_ms")).alias("l")))
    return last.filter(F.col("l.op") != "d").select(*keys, F.col("l.row").alias("config"))


def prune_columns(after, sink_columns):
    """Keep only the keys listed in the comma-separated ``sink_columns``."""
    return F.map_filter(after, lambda k, v: F.array_contains(F.split(sink_columns, ","), k))


def map_text(m) -> F.Column:
    """A map as 'k=v' pairs sorted by key and comma-joined (a stable text form)."""
    return F.array_join(F.transform(F.array_sort(F.map_keys(m)), lambda k: F.concat(k, F.lit("="), m[k])), ",")


def route_by_config(changes: DataFrame, config: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Attach the matching config row (broadcast when Spark's byte threshold allows it);
    rows without a config are dropped.  ``on`` pairs (change column, config field)."""
    cfg = config.select(*[F.col("config")[f].alias(f"cfg_{f}") for _, f in on], "config")
    cond = [changes[c] == cfg[f"cfg_{f}"] for c, f in on]
    return changes.join(cfg, cond, "inner").drop(*[f"cfg_{f}" for _, f in on])


def route_asof(changes: DataFrame, config_changes: DataFrame, on: Sequence[tuple[str, str]], chunk_ms: int = 86_400_000) -> DataFrame:
    """J1/J2 over history: each change with the config that was valid at its time; without one it is dropped.

    ``on`` pairs (change column, config field).  A config is valid from its change on, its deletion
    starts a gap; at one time the config change comes first.  Changes and config changes are one sequence
    per key, and the last config is carried forward by a two-level scan over ``chunk_ms`` chunks, so a table
    with most of the changes is spread over its chunks."""
    names = [f"__k{i}" for i in range(len(on))]
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    config = config_changes.select(*[row[f].alias(n) for n, (_, f) in zip(names, on)], F.col("ts_ms").alias("__t"), F.lit(0).alias("__n"),
                                   F.struct((F.col("op") == "d").alias("gone"), row.alias("config")).alias("__cfg"))
    own = F.struct(*changes.columns).alias("__row")
    both = changes.select(*[F.col(c).alias(n) for n, (c, _) in zip(names, on)], F.col("ts_ms").alias("__t"), F.lit(1).alias("__n"), own) \
        .unionByName(config, allowMissingColumns=True)
    found = asof_last(both, names, ["__t", "__n"], F.floor(F.col("__t") / chunk_ms), "__cfg", "__valid")
    return found.where(F.col("__row").isNotNull() & ~F.coalesce(F.col("__valid.gone"), F.lit(True))) \
        .select("__row.*", F.col("__valid.config").alias("config"))
