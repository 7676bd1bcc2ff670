"""Column expressions shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word, and the white space between words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, in order; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)
