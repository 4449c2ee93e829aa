"""Readers for the warehouse's input tables (Parquet) and their stand-in views.

Every reader returns a lazy DataFrame; column pruning and filters written later
reach the Parquet scan through Catalyst.  ``TIMESTAMP_NTZ`` columns are cast to
``TIMESTAMP`` (the session zone is fixed) so the same frame can carry a
watermark when it is read as a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def with_ltz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP_NTZ column to TIMESTAMP (wall clock read in the session zone)."""
    cols = [F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_ltz(spark.read.parquet(table_path(sf_dir, name)))


def read_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stand-in for a message-queue topic (S1): same rows, unbounded reader."""
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_ltz(r.parquet(path))


# ---- stand-in views (see FIXTURES.md part C) ---------------------------------------------

# Version order of an order-detail row: (l_orderkey, l_linenumber) repeats and the
# repeats are updates of one detail, ordered by ship date and then every other column.
DETAIL_KEY = ("l_orderkey", "l_linenumber")
DETAIL_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def money(c, precision: int = 16) -> F.Column:
    """Money as DECIMAL(16,2) (the reference's SQL type); exact from 2-decimal doubles.

    Line amounts use DECIMAL(12,2) so products with rates stay within 18 digits,
    where Spark keeps decimals in a long (the fast path); values are unchanged."""
    t = f"decimal({precision},2)"
    return F.col(c).cast(t) if isinstance(c, str) else c.cast(t)


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as the order_detail table, all versions, with money columns as decimals."""
    li = read(spark, sf_dir, "lineitem")
    price = money("l_extendedprice", 12)
    disc = F.col("l_discount").cast("decimal(3,2)")
    tax = F.col("l_tax").cast("decimal(3,2)")
    return li.select(
        *[F.col(c) for c in li.columns],
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        price.alias("split_original_amount"),
        (price * disc).alias("split_activity_amount"),
        (price * tax).alias("split_coupon_amount"),
        (price - price * disc - price * tax).alias("split_total_amount"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App events with the numeric key of ``props`` extracted (``k``).

    The key is the element of a generator: ``props`` is parsed once, not once for every use of ``k``."""
    ev = read(spark, sf_dir, "events")
    return ev.select("*", F.inline(F.array(F.struct(F.get_json_object("props", "$.k").cast("int").alias("k")))))


def session_key(spark: SparkSession) -> str:
    """Identity of the running application, for per-session caches of constant frames."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # remote session
        return spark.conf.get("spark.app.id", "remote")


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table written in code (config, dictionaries, score tables) as a JVM-side
    local relation: ``inline`` over an array of literal structs, no Python worker.

    ``schema`` is a DDL string ``"name type, ..."``; dict values become maps."""
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    fields = st.fields

    def lit(v, dt):
        if v is None:
            return F.lit(None).cast(dt)
        if isinstance(v, dict):
            kv = [x for k, val in v.items() for x in (F.lit(k), F.lit(val))]
            return F.create_map(*kv).cast(dt)
        return F.lit(v).cast(dt)

    structs = [F.struct(*[lit(v, f.dataType).alias(f.name) for v, f in zip(r, fields)]) for r in rows]
    if not structs:
        return spark.createDataFrame([], st)
    return spark.range(1).select(F.inline(F.array(*structs)))
