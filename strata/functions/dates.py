"""Date and time scalar functions (F1-F5, F22, W5) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"
DATE_FMT = "yyyy-MM-dd"
PARTITION_FMT = "yyyyMMdd"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_ms_to_ts(ms) -> Column:
    """F1 input side: epoch milliseconds (number or numeric text) to TIMESTAMP."""
    return F.timestamp_millis(_c(ms).cast("bigint"))


def ms_to_date_text(ms) -> Column:
    """Epoch-ms (number or text) to 'yyyy-MM-dd'."""
    return F.date_format(epoch_ms_to_ts(ms), DATE_FMT)


def ms_to_datetime_text(ms) -> Column:
    """epoch-ms to 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(epoch_ms_to_ts(ms), DATETIME_FMT)


def ms_to_partition(ms) -> Column:
    """Epoch-ms to the day partition text 'yyyyMMdd'."""
    return F.date_format(epoch_ms_to_ts(ms), PARTITION_FMT)


def text_to_ms(text, fmt: str = DATETIME_FMT) -> Column:
    """date or datetime text to epoch milliseconds (session zone)."""
    return F.unix_millis(F.to_timestamp(_c(text), fmt))


def ts_to_ms(ts) -> Column:
    return F.unix_millis(_c(ts))


def today_int(asof=None) -> Column:
    """today (or an as-of date) as int yyyyMMdd."""
    d = F.current_date() if asof is None else F.to_date(F.lit(asof))
    return F.date_format(d, PARTITION_FMT).cast("int")


def epoch_day_to_date(days) -> Column:
    """epoch day number (the CDC form of a DATE) to DATE."""
    return F.date_from_unix_date(_c(days).cast("int"))


def normalise_epoch(x) -> Column:
    """seconds-or-millis epoch to millis; values below 1e10 are seconds."""
    v = _c(x).cast("bigint")
    return F.when(v < F.lit(10_000_000_000), v * 1000).otherwise(v)


def window_text(win_col: str = "window") -> list[Column]:
    """Window start/end as text and the window date, named stt / edt / cur_date."""
    w = F.col(win_col)
    return [
        F.date_format(w.start, DATETIME_FMT).alias("stt"),
        F.date_format(w.end, DATETIME_FMT).alias("edt"),
        F.date_format(w.start, DATE_FMT).alias("cur_date"),
    ]
