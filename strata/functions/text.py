"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def capitalize_first(x) -> Column:
    s = _c(x)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))


def lower_first(x) -> Column:
    s = _c(x)
    return F.concat(F.lower(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))


def is_blank(x) -> Column:
    return F.coalesce(F.trim(_c(x)) == "", F.lit(True))


def is_empty(x) -> Column:
    return F.coalesce(_c(x) == "", F.lit(True))


def zeros(n: int) -> Column:
    return F.repeat(F.lit("0"), n)


def allowed_chars(x, pattern: str = "^[A-Za-z0-9#_]+$") -> Column:
    return F.coalesce(_c(x).rlike(pattern), F.lit(False))


def list_append_text(list_text, element) -> Column:
    """parse a JSON list of strings (null starts an empty list), append, and render it
    as list text '[a, b, c]' (elements unquoted)."""
    arr = F.coalesce(F.from_json(_c(list_text), "array<string>"), F.array().cast("array<string>"))
    out = F.array_append(arr, _c(element).cast("string"))
    return F.concat(F.lit("["), F.array_join(out, ", "), F.lit("]"))


def first_token(x, sep: str = " ") -> Column:
    """first token."""
    return F.element_at(F.split(_c(x), sep), 1)


def last_token(x, sep: str = ",") -> Column:
    """last token."""
    return F.element_at(F.split(_c(x), sep), -1)


def prefixed(m, prefix: str) -> Column:
    """a map with every key prefixed."""
    return F.transform_keys(_c(m), lambda k, v: F.concat(F.lit(prefix), k))


def merged(left, right) -> Column:
    """two maps as one; of a key in both the right value counts.  A null map is empty."""
    empty = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(_c(left), empty), F.coalesce(_c(right), empty)
    return F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b)
