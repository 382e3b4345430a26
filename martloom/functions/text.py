"""Text clean-up for staged files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a missing value.
FILE_NULLS = ("", "null", "NULL", "NaN")
KEY_NULLS = ("", "<NA>", "NA", "NULL", "null")
# Bytes that break a line-based load.
UNSAFE_CHARS = "\x01\x00\r\n"


def null_tokens(col: Column, tokens: tuple[str, ...] = KEY_NULLS, dtype: str = "string") -> Column:
    """Null for a token (after trimming), else the value; text that does not parse as ``dtype`` is null too."""
    return F.when(~F.trim(col).isin(*tokens), col).try_cast(dtype)


def clean_text(col: Column) -> Column:
    """Each unsafe character becomes one space."""
    return F.translate(col, UNSAFE_CHARS, " " * len(UNSAFE_CHARS))
