"""App-log parsing and splitting.

A line is parsed once.  The parse is the element of a generator, so Spark neither copies it into the
columns and filters above nor evaluates it again for them.  The columns that the warehouse works with
come from a schema; whole records, known fields or not, are maps of VARIANT values.

Parsing and the splits are narrow (per-row) steps: no shuffle.  Each output carries its whole record
(``record``) beside its columns, which costs its parse where it is used and nothing where it isn't;
``whole_records`` gives all six outputs as JSON text from one parse, in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
ELEM = T.MapType(S, S)
RECORD = "map<string,variant>"
COMMON = T.StructType([T.StructField(n, S) for n in ("ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc", "sid")])
PAGE = T.StructType([T.StructField(n, S) for n in ("page_id", "last_page_id", "item", "item_type", "during_time")])
LOG_SCHEMA = T.StructType([
    T.StructField("common", COMMON), T.StructField("page", PAGE), T.StructField("start", ELEM), T.StructField("err", ELEM),
    T.StructField("displays", T.ArrayType(ELEM)), T.StructField("actions", T.ArrayType(ELEM)), T.StructField("ts", S)])
CORRUPT = "_corrupt_record"
SPLIT_OFF = ("err", "displays", "actions")      # what the page record leaves to the other outputs


def _get(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def record_of(line: Column | str) -> Column:
    """A JSON object's fields as VARIANT values, by name; null if the line is no object."""
    return _get(F.try_parse_json(line), RECORD)


def parse_logs(lines: DataFrame, line_col: str = "value", mode: str = "PERMISSIVE") -> DataFrame:
    """P1 (PERMISSIVE, dirty rows kept with ``_corrupt_record``) or P2 (FAILFAST) JSON parse.

    Null payloads (tombstones) are dropped first (P3).  Numbers are read as text and cast: a field of an odd
    type is null in its column and whole in ``record``, and the line is not dirty for it."""
    line = F.col(line_col)
    schema = T.StructType(LOG_SCHEMA.fields + [T.StructField(CORRUPT, S)]) if mode == "PERMISSIVE" else LOG_SCHEMA
    opts = {"mode": mode, **({"columnNameOfCorruptRecord": CORRUPT} if mode == "PERMISSIVE" else {})}
    held = lines.select(line.alias("line"))
    out = held.select("line", F.inline(F.when(F.col("line").isNotNull(), F.array(F.from_json("line", schema, opts)))))
    during = F.col("page.during_time").try_cast("bigint")
    return out.withColumn("page", F.when(F.col("page").isNotNull(), F.col("page").withField("during_time", during))) \
        .withColumn("ts", F.col("ts").try_cast("bigint")).withColumn("record", record_of("line"))


def dirty(parsed: DataFrame) -> DataFrame:
    """P1 side output: the raw text of records that are not JSON."""
    return parsed.filter(F.col(CORRUPT).isNotNull()).select("line")


def clean(parsed: DataFrame) -> DataFrame:
    out = parsed.filter(F.col(CORRUPT).isNull()) if CORRUPT in parsed.columns else parsed
    return out.select(*[c for c in parsed.columns if c not in ("line", CORRUPT)])


def without(record: Column | str, *names: str) -> Column:
    """A record less some of its fields."""
    return F.map_filter(record, lambda k, v: ~k.isin(*names))


def parts(record: Column | str, *names: str) -> Column:
    """A record's fields of these names, where it has them."""
    return F.map_filter(record, lambda k, v: k.isin(*names))


def with_is_new(record: Column, value: Column) -> Column:
    """The record with its ``common.is_new`` replaced (D1); a record without ``common`` stays as it is."""
    common = F.transform_values(_get(record["common"], RECORD), lambda k, v: F.when(k == "is_new", value.cast("variant")).otherwise(v))
    new = F.call_function("to_variant_object", common)
    return F.transform_values(record, lambda k, v: F.when((k == "common") & common.isNotNull(), new).otherwise(v))


def _elements(record: Column, name: str) -> Column:
    return _get(record[name], "array<variant>")


def err_logs(logs: DataFrame) -> DataFrame:
    """Every record carrying ``err`` (the record keeps flowing to the other splits)."""
    return logs.filter(F.col("err").isNotNull())


def start_logs(logs: DataFrame) -> DataFrame:
    """R2: start records; exclusive, they feed no other split except err."""
    return logs.filter(F.col("start").isNotNull()).select("common", "start", "ts", without("record", "err").alias("record"))


def _not_start(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("start").isNull())


def _exploded(logs: DataFrame, name: str, one: str, *keep: str) -> DataFrame:
    """One row per element of ``name``: the record's fields ``keep`` and the element under ``one``."""
    own = parts("record", *keep)
    whole = F.map_concat(own, F.create_map(F.lit(one), F.col("_v")))
    return _not_start(logs).select("common", "page", "ts", "record", F.posexplode(name).alias("_i", one)) \
        .withColumn("_v", F.try_element_at(_elements(F.col("record"), name), F.col("_i") + 1)) \
        .withColumn("record", whole).drop("_i", "_v")


def display_logs(logs: DataFrame) -> DataFrame:
    """One row per display element: common, page, display, ts."""
    return _exploded(logs, "displays", "display", "common", "page", "ts").select("common", "page", "display", "ts", "record")


def action_logs(logs: DataFrame) -> DataFrame:
    """One row per action element: common, page, action (no ts, as in the reference)."""
    return _exploded(logs, "actions", "action", "common", "page").select("common", "page", "action", "record")


def page_logs(logs: DataFrame) -> DataFrame:
    """The non-start record without err, displays and actions."""
    return _not_start(logs).select("common", "page", "ts", without("record", *SPLIT_OFF).alias("record"))


def split_logs(logs: DataFrame) -> dict[str, DataFrame]:
    """The five outputs by tag."""
    return {"err": err_logs(logs), "start": start_logs(logs), "display": display_logs(logs),
            "action": action_logs(logs), "page": page_logs(logs)}


def _ordered(*fields: tuple[str, Column]) -> Column:
    """A record of these fields in order of name, without those that are null."""
    made = F.create_map(*[x for name, c in sorted(fields, key=lambda f: f[0]) for x in (F.lit(name), c)])
    return F.map_filter(made, lambda k, v: v.isNotNull())


def whole_records(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """R1-R6 in one pass: ``(tag, record)``, each output's record as JSON text with all its fields, known or not.

    A record gives rows to as many outputs as it belongs to; fields are in order of name.  Lines that
    are no JSON objects are ``dirty`` as they are."""
    r = F.col("record")
    line = F.col("line")
    parsed = lines.select(F.col(line_col).alias("line")).select("line", F.inline(F.when(line.isNotNull(), F.array(F.struct(record_of("line").alias("record"))))))
    row = lambda tag, text: F.struct(F.lit(tag).alias("tag"), text.alias("record"))
    none = F.array().cast("array<struct<tag:string,record:string>>")
    has = lambda name: _get(r[name], RECORD).isNotNull()

    def each(name: str, one: str, *keep: str) -> Column:
        made = lambda v: row(one, F.to_json(_ordered((one, v), *[(k, r[k]) for k in keep])))
        return F.coalesce(F.transform(_elements(r, name), made), none)
    page = F.concat(F.array(row("page", F.to_json(without(r, *SPLIT_OFF)))), each("displays", "display", "common", "page", "ts"),
                    each("actions", "action", "common", "page"))
    outputs = F.concat(F.when(has("err"), F.array(row("err", F.to_json(r)))).otherwise(none),
                       F.when(has("start"), F.array(row("start", F.to_json(without(r, "err"))))).otherwise(page))
    return parsed.select(F.inline(F.when(r.isNull(), F.array(row("dirty", F.col("line")))).otherwise(outputs)))
