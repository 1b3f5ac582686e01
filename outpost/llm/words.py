"""Words as runs of characters other than ASCII white space, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: The characters that part words.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def word_array(text: Column) -> Column:
    """All words of a text; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
