"""Helpers shared by the training-data operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.session import fresh_path

BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(name), F.lit(""))


DIGEST = "__digest"


def text_digest() -> Column:
    """Hash of the whole text, by which rows of one doc_id are told apart."""
    return F.sha2(whole_text(), 256).alias(DIGEST)


def words(text: Column) -> Column:
    """Runs of anything but space and \\t to \\r, in order; none in a blank text."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, BLANK + "+", -1))


def single_spaced(text: Column) -> Column:
    """Every run of blanks as one space; runs that are one space already are not touched."""
    return F.regexp_replace(text, r"\x20" + BLANK + r"+|[\x09-\x0D]" + BLANK + "*", " ")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also inside nested lambdas."""
    return F.transform(F.array(value), body)[0]


LEAST_SLOTS, MOST_SLOTS = 1 << 16, 1 << 20  # longs of a key filter: 16 bits a key between these, so its size is bounded


@dataclass(frozen=True)
class KeyFilter:
    """A bitmap of keys' hashes as rows (slot, bits); ``slots`` is how many there may be."""

    rows: DataFrame
    slots: int


def key_filter(keys: DataFrame, *names: str) -> KeyFilter:
    """A filter over the keys, sized by their number up to ``MOST_SLOTS``: small enough to be broadcast for any number of keys."""
    hashes = written(keys.select(F.xxhash64(*names).alias("hash")).distinct(), "key-hashes")
    slots = LEAST_SLOTS
    wanted = hashes.count() // 4
    while slots < min(wanted, MOST_SLOTS):
        slots *= 2
    bucket = hashes.select(F.pmod("hash", F.lit(slots * 64)).alias("bucket"))
    bit = F.expr("shiftleft(1L, CAST(bucket & 63 AS INT))")
    return KeyFilter(written(bucket.groupBy(F.shiftright("bucket", 6).alias("__slot")).agg(F.bit_or(bit).alias("__bits")), "key-filter"), slots)


def maybe_in(rows: DataFrame, bitmap: KeyFilter, *names: str) -> DataFrame:
    """``rows`` with ``__maybe``: false only where the key is surely not in the filter. Nothing is shuffled."""
    bucket = F.pmod(F.xxhash64(*names), F.lit(bitmap.slots * 64))
    placed = rows.withColumn("__bucket", bucket).withColumn("__slot", F.shiftright("__bucket", 6))
    met = placed.join(F.broadcast(bitmap.rows), "__slot", "left")
    hit = F.expr("coalesce(getbit(__bits, CAST(__bucket & 63 AS INT)), 0) = 1")
    return met.withColumn("__maybe", hit).drop("__slot", "__bits", "__bucket")


def without(rows: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """``rows`` whose key is not among ``keys``, nulls equal to nulls.

    Only rows that the filter cannot clear are shuffled for the exact comparison; the fuller the filter, the
    more of them there are.
    """
    keys = written(keys.select(*names).distinct(), "keys")
    marked = maybe_in(rows, key_filter(keys, *names), *names)
    cleared = marked.where("not __maybe").drop("__maybe")
    open_rows = marked.where("__maybe").drop("__maybe")
    named = keys.select(*(F.col(name).alias(f"__key_{name}") for name in names))
    same = F.lit(True)
    for name in names:
        same = same & open_rows[name].eqNullSafe(named[f"__key_{name}"])
    return cleared.unionByName(open_rows.join(named, same, "left_anti"))
