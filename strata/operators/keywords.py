"""Keyword extraction (the reference's lateral segmentation UDTF) as built-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Word boundary: any run of non-letters (all scripts).
WORD_SPLIT = r"[^\p{L}]+"


def keywords(df: DataFrame, text_col: str, out_col: str = "keyword") -> DataFrame:
    """One row per word of ``text_col`` (lower case); rows without words vanish (inner lateral)."""
    words = F.explode(F.split(F.lower(F.col(text_col)), WORD_SPLIT))
    rest = [c for c in df.columns if c != text_col]
    return df.select(*rest, words.alias(out_col)).filter(F.col(out_col) != "")
