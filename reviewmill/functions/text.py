"""Text predicates and splits as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space as Python's str.strip and str.isspace see it; usable inside a
# character class by both Java and RE2.
WHITESPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"
# The same characters one by one, for trimming without a regular expression.
WHITESPACE_CHARS = "".join(map(chr, (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)))


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(col, F.lit(WHITESPACE_CHARS))


def has_text(col: Column) -> Column:
    """True when the string holds a character other than white space; false for null."""
    return F.coalesce(col.rlike(rf"[^{WHITESPACE}]"), F.lit(False))


def is_blank(col: Column, dtype: str = "string") -> Column:
    """Null, NaN, or a string of white space only."""
    if dtype == "string":
        return ~has_text(col)
    if dtype in ("double", "float"):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def na_to_null(col: Column, tokens: Sequence[str]) -> Column:
    """Null for cells that spell a missing value; everything else unchanged."""
    return F.when(~col.isin(list(tokens)), col)


def one_line(col: Column) -> Column:
    return F.translate(col, "\n", " ")


def chunk_array(col: Column, width: int) -> Column:
    """Fixed-width pieces in order; an empty or null text has none."""
    starts = F.sequence(F.lit(1), F.length(col), F.lit(width))
    return F.when(
        F.length(col) > 0, F.transform(starts, lambda i: F.substring(col, i, F.lit(width)))
    ).otherwise(F.array().cast("array<string>"))


def split_list(col: Column) -> Column:
    """Comma list to trimmed array; a null list is empty."""
    return F.coalesce(F.transform(F.split(col, ",", -1), strip), F.array().cast("array<string>"))


def matched_keywords(text: Column, keywords: Column) -> Column:
    """The keywords contained in the text, case ignored, in their own order."""
    return F.filter(keywords, lambda k: F.contains(F.lower(text), F.lower(k)))


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    lowered = F.lower(text)
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | F.contains(lowered, F.lit(phrase))
    return F.coalesce(hit, F.lit(False))
