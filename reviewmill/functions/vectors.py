"""Similarity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def inner_product(left: Column, right: Column) -> Column:
    """Row-wise inner product in double precision. Batch search uses ``operators.search``."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def positive_score(score: Column) -> Column:
    """Monotone map of inner products to positive scores, as vector indexes publish it."""
    return F.when(score >= 0, score + 1).otherwise(1 / (1 - score))
