"""Keys and buckets (F14-F16): hash buckets, hot-key override, row keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hash_bucket(x, n: int = 128) -> Column:
    """last 3 hex digits of md5(text), mod n, zero-padded to 4 digits."""
    h = F.conv(F.substring(F.md5(_c(x).cast("string")), -3, 3), 16, 10).cast("int")
    return F.lpad((h % n).cast("string"), 4, "0")


def hash_bucket_with_hot_keys(x, hot: Column, n: int = 128) -> Column:
    """a dedicated bucket for listed hot keys (compared in lower case), else F14.

    ``hot`` is the looked-up override (null when the key is not hot), normally
    from a broadcast join of the hot-key table on ``lower(x)``."""
    return F.coalesce(hot, hash_bucket(x, n))


def row_key(parts: Sequence, sep: str = "_", md5_items: bool = False, md5_whole: bool = False) -> Column:
    """F16: row key from ordered fields; optionally md5 each item or the whole key."""
    cols = [_c(p).cast("string") for p in parts]
    if md5_items:
        cols = [F.md5(c) for c in cols]
    k = F.concat_ws(sep, *cols)
    return F.md5(k) if md5_whole else k
