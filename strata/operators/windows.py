"""Event-time tumbling-window summaries.

``tumbling`` groups by ``window(ts, size)`` plus keys; Spark plans a partial
(map-side) aggregate and a final one, so a hot key or a global (un-keyed)
window is pre-reduced in every task before the shuffle.  On a streaming frame
the same call becomes a stateful windowed aggregate; add a watermark first
(``with_event_time``) so windows close and late rows are dropped (W8).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import window_text


def with_event_time(df: DataFrame, ts_col: str, delay: str = "0 seconds") -> DataFrame:
    """Declare the event-time column and its out-of-order bound (no-op in batch)."""
    return df.withWatermark(ts_col, delay) if df.isStreaming else df


def tumbling(df: DataFrame, ts_col: str, size: str, keys: Sequence[str | Column], aggs: Sequence[Column]) -> DataFrame:
    """Aggregate rows per tumbling window and keys; output starts with stt, edt, cur_date."""
    g = df.groupBy(F.window(F.col(ts_col), size).alias("window"), *keys).agg(*aggs)
    rest = [c for c in g.columns if c != "window"]
    return g.select(*window_text("window"), *rest)
