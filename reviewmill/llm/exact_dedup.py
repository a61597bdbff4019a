"""Exact deduplication by progressive refinement: length, then a hash of the beginning, then a hash of the whole.

Texts are equal when identical with every run of blanks as one space; null counts as empty, and empty texts are equal
to each other. The first pass keeps (doc_id, length, prefix hash) only. Groups of one length are refined by the prefix
hash, and just the rows still in a group of two or more are read again for the full hash; their texts stay in place. Of equal texts the row with
the smallest doc_id stays; a null id stays only where no other is in the group. Rows that repeat both doc_id and text
are one document: ``exact_groups`` lists it once with ``copies`` above one, and ``keep_first`` leaves one of them.
Columns beside ``doc_id`` and ``text`` are only carried by ``keep_first``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import key_filter, maybe_in, single_spaced, whole_text, without, written

PREFIX_CHARS = 256
_MARK = ("__length", "__head")


def _marked(docs: DataFrame, *carried: Column | str) -> DataFrame:
    spaced = docs.select(*carried, single_spaced(whole_text()).alias("__text"))
    return spaced.select(
        *(c for c in spaced.columns if c != "__text"), "__text",
        F.length("__text").alias("__length"), F.xxhash64(F.substring("__text", 1, PREFIX_CHARS)).alias("__head"),
    )


def _several(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")


def _same(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & left[key].eqNullSafe(right[key])
    return same


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, copies, and the length, prefix hash and (of refined rows) full hash behind them."""
    marks = written(_marked(docs, "doc_id").drop("__text"), "dedup-marks")
    # Filters of fixed size carry each step to the next: no join meets a length or prefix that a third of the rows share. What a
    # filter cannot rule out goes one step further and falls out there, at the latest as a group of one.
    same_length = maybe_in(marks, key_filter(_several(marks, "__length"), "__length"), "__length").where("__maybe")
    open_groups = key_filter(_several(same_length, *_MARK), *_MARK)
    alone = maybe_in(marks, open_groups, *_MARK).where("not __maybe")
    texts = maybe_in(_marked(docs, "doc_id"), open_groups, *_MARK).where("__maybe")
    hashed = texts.select("doc_id", *_MARK, F.sha2("__text", 256).alias("sha256"))
    documents = written(hashed.groupBy("doc_id", *_MARK, "sha256").agg(F.count("*").alias("copies")), "dedup-hashed")
    # written, so that the join below meets two plain tables and a hash with many rows can be split over tasks
    groups = written(documents.groupBy("sha256").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")), "dedup-sizes")
    grouped = documents.join(groups, "sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "copies", *_MARK, "sha256")
    single = alone.select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.lit(1).cast("long").alias("copies"), *_MARK, F.lit(None).cast("string").alias("sha256"))
    return grouped.unionByName(single)


def with_digest(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``groups`` with the full hash of every document, also of those that needed none to be told apart."""
    full = _marked(docs, "doc_id").select("doc_id", *_MARK, F.sha2("__text", 256).alias("text_sha256"))
    known = groups.where("sha256 is not null").withColumn("text_sha256", F.col("sha256"))
    rest = groups.where("sha256 is null")
    found = rest.join(full, _same(rest, full, "doc_id", *_MARK)).select(*(rest[c] for c in rest.columns), full["text_sha256"])
    return known.unionByName(found)


def keep_first(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = written(exact_groups(docs) if groups is None else groups, "dedup-groups")
    key = ("doc_id", "sha256")
    # groups without a full hash are of one row and stay
    spaced = F.sha2(single_spaced(whole_text()), 256)
    marked = docs.select(*(F.col(c).alias(f"__own_{c}") for c in docs.columns), "doc_id", spaced.alias("sha256"))
    stay = without(marked, groups.where("not kept"), *key)
    repeated = groups.where("kept and copies > 1").select(*key)
    if not repeated.isEmpty():
        once = stay.join(repeated, _same(stay, repeated, *key), "left_semi").dropDuplicates(list(key))
        stay = stay.join(repeated, _same(stay, repeated, *key), "left_anti").unionByName(once)
    return stay.select(*(F.col(f"__own_{c}").alias(c) for c in docs.columns))
