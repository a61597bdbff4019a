"""Mixed-format date parsing.

A format pairs the full-match pattern of a date without its time of day with the parser's
format. The pattern keeps values away from a parser that would fail on them: a failed
parse costs a JVM exception per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TIME = r"[ T](?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?\z"

# Earlier entries win where a value fits several, so order settles d/m against m/d.
DEFAULT_DATE_FORMATS: tuple[tuple[str, str], ...] = (
    (r"^\d{4}-\d{2}-\d{2}\z", "yyyy-MM-dd"),
    (r"^\d{1,2}/\d{1,2}/\d{4}\z", "M/d/yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}\z", "d.M.yyyy"),
    (r"^\d{4}/\d{2}/\d{2}\z", "yyyy/MM/dd"),
)


def with_date(
    df: DataFrame, column: str = "review_date", formats: tuple[tuple[str, str], ...] = DEFAULT_DATE_FORMATS
) -> DataFrame:
    """Replace a text column by its date: the first format that yields a calendar date, else null.

    The text without its time of day is a column of its own, cut once per row.
    """
    staged = df.withColumn("_day", F.regexp_replace(F.trim(column), _TIME, ""))
    day = F.col("_day")
    attempts = [F.when(day.rlike(pattern), F.try_to_date(day, fmt)) for pattern, fmt in formats]
    return staged.withColumn(column, F.coalesce(*attempts)).drop("_day")


def is_iso_date(col: Column) -> Column:
    """``yyyy-MM-dd`` in form and a real date; null counts as invalid."""
    return F.when(
        col.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.try_to_date(col, "yyyy-MM-dd").isNotNull()
    ).otherwise(F.lit(False))
