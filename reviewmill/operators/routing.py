"""File routing by key: prefix, kind, source and target key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.contracts import REFERENCE_MARKERS
from reviewmill.operators.matching import match_substrings


def decode_key(col: Column) -> Column:
    """Undo URL encoding of an object key; a malformed escape leaves the key as it is."""
    return F.coalesce(F.try_url_decode(col), col)


def is_reference_key(key: Column) -> Column:
    lowered = F.lower(key)
    hit = F.lit(False)
    for marker in REFERENCE_MARKERS:
        hit = hit | F.contains(lowered, F.lit(marker))
    return hit


def processed_key(key: Column) -> Column:
    """``raw/`` to ``processed/`` throughout, and a closing extension to ``.csv``."""
    return F.regexp_replace(F.replace(key, F.lit("raw/"), F.lit("processed/")), r"\.[\p{L}\p{N}_]+$", ".csv")


def source_of(key: Column, sources: list[str]) -> Column:
    """Source of a key for a configured list: the first listed name contained in it."""
    lowered = F.lower(key)
    found = F.lit(None).cast("string")
    for name in reversed(sources):
        found = F.when(F.contains(lowered, F.lit(name)), F.lit(name)).otherwise(found)
    return found


def route_keys(keys: DataFrame, sources: DataFrame, key: str = "key") -> DataFrame:
    """Route a manifest of (encoded) keys against a table of source names.

    Keys outside ``raw/`` are skipped. A fact key takes the longest source name it holds;
    with none it goes to quarantine.
    """
    decoded = keys.withColumn("file_key", decode_key(F.col(key)))
    facts = F.startswith(F.col("file_key"), F.lit("raw/")) & ~is_reference_key(F.col("file_key"))
    names = sources.select(F.lower("source").alias("name")).distinct()
    matched = match_substrings(
        decoded.filter(facts).select("file_key").distinct().withColumn("lowered", F.lower("file_key")),
        names, "file_key", "lowered", "name",
    )
    longest = matched.groupBy("file_key").agg(
        F.max_by("name", F.struct(F.length("name"), "name")).alias("source")
    )
    routed = decoded.join(longest, "file_key", "left")
    kind = (
        F.when(~F.startswith(F.col("file_key"), F.lit("raw/")), "skipped")
        .when(is_reference_key(F.col("file_key")), "dimension")
        .when(F.col("source").isNotNull(), "fact")
        .otherwise("quarantine")
    )
    return routed.withColumn("kind", kind).withColumn(
        "target_key", F.when(F.col("kind").isin("fact", "dimension"), processed_key(F.col("file_key")))
    )
