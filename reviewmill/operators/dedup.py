"""Near-duplicate removal and collapse of duplicate review ids.

The collapse is one aggregation. Near-duplicates are keyed by their base id and their
siblings by their own id, so both counts and every coalesced field come out of a single
shuffle, partial aggregates cap what one hot id can send, and no join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.contracts import COALESCED_FIELDS, NULLED_ON_DUPLICATE
from reviewmill.functions.ids import base_id, is_near_dup

UNIT = ("source",)


def near_dup_counts(df: DataFrame, unit: Sequence[str] = UNIT) -> DataFrame:
    """Near-duplicate rows per base id."""
    return (
        df.filter(is_near_dup(F.col("review_id")))
        .groupBy(*unit, base_id(F.col("review_id")).alias("review_id"))
        .agg(F.count(F.lit(1)).alias("_near_dup_count"))
    )


def drop_near_duplicates(df: DataFrame, unit: Sequence[str] = UNIT) -> DataFrame:
    """Rows without near-duplicates, each carrying how many near-duplicates its id had."""
    kept = df.filter(~is_near_dup(F.col("review_id")))
    counted = kept.join(near_dup_counts(df, unit), [*unit, "review_id"], "left")
    return counted.withColumn("_near_dup_count", F.coalesce("_near_dup_count", F.lit(0)))


def without_id(df: DataFrame) -> DataFrame:
    """Rows that cannot be keyed, for the quarantine table."""
    return df.filter(F.col("review_id").isNull()).withColumn("reason", F.lit("missing review_id"))


def _group_counts(df: DataFrame, unit: Sequence[str], aggregates: Sequence[Column] = ()) -> DataFrame:
    near = is_near_dup(F.col("review_id"))
    keyed = (
        df.filter(F.col("review_id").isNotNull())
        .withColumn("_near", near)
        .withColumn("review_id", F.when(near, base_id(F.col("review_id"))).otherwise(F.col("review_id")))
    )
    return keyed.groupBy(*unit, "review_id").agg(
        F.count_if(~F.col("_near")).alias("_base_rows"),
        F.count_if(F.col("_near")).alias("_near_rows"),
        *aggregates,
    )


def orphan_near_dups(df: DataFrame, unit: Sequence[str] = UNIT) -> DataFrame:
    """Near-duplicate rows whose base id has no surviving row; no count can carry them."""
    return (
        _group_counts(df, unit)
        .filter(F.col("_base_rows") == 0)
        .select(*unit, "review_id", F.col("_near_rows").alias("orphan_rows"))
    )


def collapse_duplicates(
    df: DataFrame,
    unit: Sequence[str] = UNIT,
    order: Sequence[str] = ("pos",),
) -> DataFrame:
    """One row per (unit, review_id) with ``transaction_count``.

    Date, rating and text take their first non-null value in file order; the remaining
    columns come from the first row and are nulled when the id occurred more than once,
    near-duplicates included.
    """
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    base = ~F.col("_near")

    def first_value(column: str) -> Column:
        return F.min_by(column, F.when(base & F.col(column).isNotNull(), position)).alias(column)

    columns = df.columns
    coalesced = [c for c in COALESCED_FIELDS if c in columns]
    skip = {*unit, *order, "review_id", *coalesced}
    carried = [c for c in columns if c not in skip]
    aggregates = [first_value(c) for c in coalesced]
    if carried:
        aggregates.append(F.min_by(F.struct(*carried), F.when(base, position)).alias("_first"))

    grouped = (
        _group_counts(df, unit, aggregates)
        .filter(F.col("_base_rows") > 0)
        .withColumn("transaction_count", F.col("_base_rows") + F.col("_near_rows"))
    )
    unique = F.col("transaction_count") == 1
    projected = [
        (F.when(unique, F.col(f"_first.{c}")) if c in NULLED_ON_DUPLICATE else F.col(f"_first.{c}")).alias(c)
        for c in carried
    ]
    return grouped.select(*unit, "review_id", *coalesced, *projected, "transaction_count")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("pos",)) -> DataFrame:
    """First row per key in the given order, as an aggregate rather than a window."""
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), position).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])
