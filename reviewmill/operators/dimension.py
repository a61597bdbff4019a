"""The restaurant dimension and the name dictionary taken from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.contracts import REFERENCE_SCHEMA
from reviewmill.functions.text import has_text, split_list, strip
from reviewmill.operators.headers import conform


def standardize_dimension(raw: DataFrame) -> DataFrame:
    """Clean the dimension: id from location, categories as array, aggregate columns dropped."""
    if "location" not in raw.columns:
        raise ValueError("dimension has no 'location' column; restaurant_id cannot be derived")
    df = raw.drop("avg_stars", "total_reviews")
    if "categories" in df.columns:
        df = df.withColumn("categories", split_list(F.col("categories")))
    return df.withColumn("restaurant_id", F.lower("location")).withColumnRenamed("location", "source_file_tag")


def conform_dimension(df: DataFrame) -> DataFrame:
    return conform(df, REFERENCE_SCHEMA)


def categories_json(col: Column) -> Column:
    """Array as JSON text with a space after each comma, as the CSV export spells it."""
    options = {"writeNonAsciiCharacterAsCodePoint": "true"}

    def quoted(item: Column) -> Column:
        text = F.to_json(F.array(item), options)
        return F.substring(text, F.lit(2), F.length(text) - 2)

    return F.concat(F.lit("["), F.array_join(F.transform(col, quoted), ", "), F.lit("]"))


def name_dictionary(dimension: DataFrame, pos: str | None = None) -> DataFrame:
    """``name, restaurant_id``: trimmed, lower-cased, blanks skipped, last duplicate name wins."""
    order = F.col(pos) if pos else F.monotonically_increasing_id()
    return (
        dimension.withColumn("_pos", order)
        .filter(has_text(F.col("restaurant_name")) & has_text(F.col("restaurant_id")))
        .groupBy(F.lower(strip(F.col("restaurant_name"))).alias("name"))
        .agg(F.max_by(F.lower(strip(F.col("restaurant_id"))), "_pos").alias("restaurant_id"))
    )
