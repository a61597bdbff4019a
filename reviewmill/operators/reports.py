"""Bounded samples beside full counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_IDS = 25


def first_ids(df: DataFrame, keys: Sequence[str], id_col: str, n: int = SAMPLE_IDS) -> DataFrame:
    """The n smallest ids per key, sorted, as one array.

    The rank filter becomes a group limit ahead of the shuffle, so a task sends at most n
    rows per key and the array never grows past n.
    """
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(id_col))
    ranked = df.select(*keys, id_col).withColumn("_rank", F.row_number().over(order))
    return (
        ranked.filter(F.col("_rank") <= n)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(id_col)).alias("sample_ids"))
    )


def counted_with_sample(df: DataFrame, keys: Sequence[str], id_col: str, n: int = SAMPLE_IDS) -> DataFrame:
    """Row count per key with its n smallest ids; the count covers every row.

    Both halves read the same columns of the same frame, so a shuffle below is shared.
    """
    counts = df.select(*keys, id_col).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_bad"))
    samples = first_ids(df, keys, id_col, n)
    return counts.join(samples, list(keys), "left").withColumn(
        "sample_ids", F.coalesce("sample_ids", F.array().cast("array<string>"))
    )
