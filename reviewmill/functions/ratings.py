"""Ratings written as numbers, as scaled numbers or as rows of symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.numbers import round_tenth, to_number
from reviewmill.functions.text import WHITESPACE

_INVISIBLE = r"\x{FE00}-\x{FE0F}\x{200D}"
# What is left after this removal is neither word character, white space nor modifier.
NON_SYMBOL = rf"[{_INVISIBLE}\p{{L}}\p{{N}}_{WHITESPACE}]"


def symbols(col: Column) -> Column:
    """The symbol characters of a cell, modifiers and joiners removed."""
    return F.regexp_replace(col, NON_SYMBOL, "")


def is_symbol_rating(col: Column) -> Column:
    """Symbols present and no ASCII letter or digit anywhere."""
    return ~col.rlike("[A-Za-z0-9]") & (F.length(symbols(col)) > 0)


def rating_outcome(col: Column) -> Column:
    """``missing``, ``numeric``, ``symbol`` or ``unparseable``."""
    return (
        F.when(col.isNull(), F.lit("missing"))
        .when(to_number(col).isNotNull(), F.lit("numeric"))
        .when(is_symbol_rating(col), F.lit("symbol"))
        .otherwise(F.lit("unparseable"))
    )


def symbol_set(df: DataFrame, cell: Column, by: str) -> DataFrame:
    """``by, symbols``: the distinct symbol characters of each group's cells, sorted and joined.

    Characters are counted first, so what a group gathers is bounded by the distinct symbols.
    """
    each = df.select(by, F.explode(F.regexp_extract_all(symbols(cell), F.lit("(?s)."), F.lit(0))).alias("symbol"))
    return each.groupBy(by, "symbol").agg(F.count(F.lit(1)).alias("n")).groupBy(by).agg(
        F.array_join(F.sort_array(F.collect_list("symbol")), "").alias("symbols"))


def with_rating(df: DataFrame, divisor: Column, column: str = "rating") -> DataFrame:
    """Scale numbers by the divisor, count symbols, null everything mixed or unreadable.

    The divisor never applies to symbols, and nothing is clipped to 1..5. The parsed number
    and the symbol count are columns of their own so that each is computed once per row.
    """
    staged = df.withColumns({
        "_number": to_number(F.col(column)),
        "_symbols": F.when(~F.col(column).rlike("[A-Za-z0-9]"), F.length(symbols(F.col(column)))),
        "_divisor": divisor,
    }).withColumn("_scaled", F.col("_number") / F.col("_divisor"))
    number = F.when(F.col("_divisor") > 1, round_tenth(F.col("_scaled"))).otherwise(F.col("_number"))
    value = F.when(F.col("_number").isNotNull(), number).when(F.col("_symbols") > 0, F.col("_symbols").cast("double"))
    return staged.withColumn(column, value).drop("_number", "_symbols", "_divisor", "_scaled")
