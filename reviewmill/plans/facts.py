"""Raw facts to processed facts in one lazily evaluated plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.contracts import FACT_SCHEMA
from reviewmill.functions.dates import DEFAULT_DATE_FORMATS, with_date
from reviewmill.functions.numbers import derived_total, to_number
from reviewmill.functions.ratings import with_rating
from reviewmill.operators.dedup import UNIT, collapse_duplicates
from reviewmill.operators.headers import conform


def typed(raw: DataFrame) -> DataFrame:
    """Numeric columns of the raw contract as numbers; unreadable cells become null."""
    types = dict(raw.dtypes)
    numbers = {
        c: to_number(F.col(c)) if types[c] == "string" else F.col(c).cast("double")
        for c in ("total_spent", "tip_amount", "tip_percentage", "party_size")
    }
    return raw.withColumns({**numbers, "party_size": numbers["party_size"].try_cast("int")})


def standardize_facts(
    raw: DataFrame,
    divisor: Column,
    unit: Sequence[str] = UNIT,
    order: Sequence[str] | None = None,
    compat: bool = False,
    formats: tuple[tuple[str, str], ...] = DEFAULT_DATE_FORMATS,
) -> DataFrame:
    """Raw contract rows to the 13 processed columns, in contract order.

    ``divisor`` is the rating divisor of a row's source. Ratings are normalised ahead of
    the collapse so a readable rating survives an unreadable sibling; ``compat=True``
    coalesces the raw cells first and keeps only what the first non-null one yields.
    ``order`` is the row order inside a unit: ``pos``, after ``file_key`` where rows have one, since rows are numbered
    file by file and not across files. Columns of ``unit`` beyond ``source`` stay at the end for the sink to partition by.
    """
    if order is None:
        order = ("file_key", "pos") if "file_key" in raw.columns else ("pos",)
    dated = with_date(typed(raw), "review_date", formats)
    carried = [c for c in unit if c != "source"]
    rows = dated if compat else with_rating(dated, divisor)
    rows = rows.drop("location", "restaurant_name", *[c for c in ("file_key",) if c not in (*unit, *order)])

    if "has_id" in rows.columns:
        keyed = collapse_duplicates(rows.filter("has_id").drop("has_id"), unit, order)
        loose = rows.filter("NOT has_id").drop("has_id", *[c for c in order if c not in unit])
        collapsed = keyed.unionByName(loose.withColumn("transaction_count", F.lit(1).cast("bigint")))
    else:
        collapsed = collapse_duplicates(rows, unit, order)
    if compat:
        collapsed = with_rating(collapsed, divisor)
    completed = collapsed.withColumns({
        "total_spent": derived_total(F.col("total_spent"), F.col("tip_amount"), F.col("tip_percentage")),
        "restaurant_id": F.col("source"),
    }).drop("tip_percentage")
    return conform(completed, FACT_SCHEMA, tuple(carried))
