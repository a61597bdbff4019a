"""Fixity audit of WARC replicas with Merkle trees.

Every page is a WARC response record; a record's leaf is the hash of its bytes, at a fixed place: its page_id says the file
and the position inside it. ``FAN`` neighbouring leaves, an ordered range of offsets, have a parent that hashes their
hashes, up to one root per file, and files are joined the same way up to the root of a replica. Two replicas are compared
from the roots; a level is only read below nodes that differ.

A file holds ``PER_FILE`` positions at most and a node ``FAN`` children, so every group is bounded. Records that share a place
(repeated page_ids; records without an id, which are placed by their content in a file of their own) are counted by hash and become a
subtree: ranges of hashes (their first ``RANGE`` hex digits) hash their ordered (hash, copies) lists, and the place hashes its ranges in two
steps. So any change of a record or of its copies changes the place, and the records that differ are found below it. Equal copies meet
before they are shuffled. Null url and html count as empty. Negative ids have negative files. Extra columns are not read. Empty
replicas are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import written

FAN_BITS = 4
FAN = 1 << FAN_BITS
FILE_LEVELS = 3
PER_FILE = FAN**FILE_LEVELS
UNNUMBERED = -(1 << 52)  # file of records without an id, below that of any page_id
RANGE = 4  # hex digits: 65,536 ranges of the records at one place


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The record as text: header lines, an empty line, the payload, two line ends."""
    payload = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def records(pages: DataFrame) -> DataFrame:
    """file, at, hash, page_id, copies and n_bytes of every different record."""
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    hashed = pages.select("page_id", F.xxhash64("url", "html").alias("content"), record.alias("record")).select(
        "page_id", F.coalesce(F.floor(F.col("page_id") / PER_FILE), F.lit(UNNUMBERED)).alias("file"),
        F.pmod(F.coalesce("page_id", "content"), F.lit(PER_FILE)).alias("at"),
        F.octet_length("record").cast("long").alias("n_bytes"), F.sha2("record", 256).alias("hash"))
    return hashed.groupBy("file", "at", "hash").agg(
        F.min("page_id").alias("page_id"), F.count("*").alias("copies"), F.sum("n_bytes").alias("n_bytes"))


def _ranges(several: DataFrame) -> DataFrame:
    """file, at, range and hash of the ranges of records at places that hold several."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("hash", "copies"))), lambda r: F.concat_ws(":", r["hash"], r["copies"]))
    return several.groupBy("file", "at", F.substring("hash", 1, RANGE).alias("range")).agg(F.sha2(F.array_join(listed, ","), 256).alias("hash"))


def _above(nodes: DataFrame, *keys: Column | str) -> DataFrame:
    """One hash over the ordered nodes below each key."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("range", "hash"))), lambda r: F.concat_ws(":", r["range"], r["hash"]))
    return nodes.groupBy(*keys).agg(F.sha2(F.array_join(listed, ","), 256).alias("hash"))


def _replica(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Leaves of the places, and the records and ranges at the places that hold several; all written."""
    held = written(records(pages), "warc-records")
    places = held.groupBy("file", "at").agg(
        F.min("page_id").alias("page_id"), F.sum("copies").alias("n_records"), F.sum("n_bytes").alias("n_bytes"), F.min("hash").alias("hash"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n_bytes").over(before), F.lit(0))
    placed = written(places.withColumn("offset", offset), "warc-places")
    shared = placed.where("n_records > 1").select("file", "at")
    several = written(held.join(shared, ["file", "at"]).withColumn("range", F.substring("hash", 1, RANGE)), "warc-several")
    ranges = written(_ranges(several), "warc-ranges")
    half = _above(ranges, "file", "at", F.substring("range", 1, RANGE // 2).alias("half")).withColumnRenamed("half", "range")
    roots = _above(half, "file", "at").withColumnRenamed("hash", "root")
    leaf = placed.join(roots, ["file", "at"], "left").withColumn("hash", F.coalesce("root", "hash")).drop("root")
    return written(leaf, "warc-leaves"), several, ranges


def leaves(pages: DataFrame) -> DataFrame:
    """file, at, page_id, n_records, hash, offset and n_bytes of every leaf."""
    return _replica(pages)[0]


def _parent(level: int) -> tuple[Column, Column]:
    """Key of the node above: inside a file by position, above its root by file."""
    if level < FILE_LEVELS:
        return F.col("file"), F.shiftright("at", FAN_BITS)
    return F.shiftright("file", FAN_BITS), F.lit(0).cast("long")


def grow(leaf: DataFrame, levels: int) -> list[DataFrame]:
    """The tree's levels from the leaves up, each written: file, at, hash, and the range of offsets and number of leaves below."""
    tree = [written(leaf.select("file", "at", "page_id", "n_records", "hash", "offset", "n_bytes"), "merkle-leaves")]
    for level in range(levels):
        file, at = _parent(level)
        children = F.sort_array(F.collect_list(F.struct("file", "at", "hash")))
        above = tree[-1].groupBy(file.alias("file_"), at.alias("at_")).agg(
            F.sha2(F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["file"], c["at"], c["hash"])), ","), 256).alias("hash"),
            F.min("offset").alias("offset"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_records").alias("n_records"))
        tree.append(written(above.withColumnsRenamed({"file_": "file", "at_": "at"}), f"merkle-level{level + 1}"))
    return tree


def levels_for(*leaf: DataFrame) -> int:
    """Levels until all numbered files of any replica are below two nodes, of negative and of other ids; the unnumbered file has a
    root beside them."""
    tops = [one.where(F.col("file") > UNNUMBERED).agg(F.max(F.abs("file"))).first()[0] or 0 for one in leaf]
    files, levels = max(tops, default=0), FILE_LEVELS
    while files > 0:
        files >>= FAN_BITS
        levels += 1
    return levels


def _node(level: DataFrame, name: str) -> DataFrame:
    rest = [c for c in level.columns if c not in ("file", "at", "pf", "pa")]
    return level.select("file", "at", F.struct(*rest).alias(name))


def _shared_differences(differ: DataFrame, one: tuple[DataFrame, DataFrame], other: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Records that differ at places where both replicas have leaves and one of them has several: by ranges, then by record."""
    places = differ.select("file", "at")
    sides = []
    for several, ranges in (one, other):
        sides.append((several, ranges.join(places, ["file", "at"], "left_semi")))
    (records_one, ranges_one), (records_other, ranges_other) = sides
    unequal = ranges_one.withColumnRenamed("hash", "l").join(ranges_other.withColumnRenamed("hash", "r"), ["file", "at", "range"], "full_outer").where(
        ~F.col("l").eqNullSafe(F.col("r"))).select("file", "at", "range")
    unequal = written(unequal, "merkle-ranges")
    left, right = (side.join(unequal, ["file", "at", "range"], "left_semi").select("file", "at", "hash", F.struct("page_id", "copies", "n_bytes").alias(name))
                   for side, name in ((records_one, "a"), (records_other, "b")))
    met = left.join(right, ["file", "at", "hash"], "full_outer")
    copies_one, copies_other = F.coalesce("a.copies", F.lit(0)), F.coalesce("b.copies", F.lit(0))
    return met.where(copies_one != copies_other).select(
        "file", "at", F.coalesce("a.page_id", "b.page_id").alias("page_id"), F.coalesce("a.n_bytes", "b.n_bytes").alias("n_bytes"),
        F.when(copies_one > copies_other, F.col("hash")).alias("hash"), F.when(copies_other > copies_one, F.col("hash")).alias("hash_other"))


def audit(one: DataFrame, other: DataFrame) -> DataFrame:
    """What differs between two tables of pages: file, at, page_id, status, offset, n_bytes and both hashes.

    status is damaged, missing (from the other replica) or extra, by place. Offsets are the first replica's, where it has the place. A
    damaged place with several records has a row for each record that has more copies in one replica, under the hash of that replica.
    """
    (leaf, several, ranges), (leaf_other, several_other, ranges_other) = _replica(one), _replica(other)
    levels = levels_for(leaf, leaf_other)
    tree, tree_other = grow(leaf, levels), grow(leaf_other, levels)
    suspects = None
    for level in range(levels, -1, -1):
        left, right = tree[level], tree_other[level]
        if suspects is not None:
            file, at = _parent(level)
            left = left.withColumns({"pf": file, "pa": at}).join(suspects, ["pf", "pa"], "left_semi")
            right = right.withColumns({"pf": file, "pa": at}).join(suspects, ["pf", "pa"], "left_semi")
        found = _node(left, "l").join(_node(right, "r"), ["file", "at"], "full_outer")
        differ = found.where(~F.col("l.hash").eqNullSafe(F.col("r.hash")))
        if level:
            suspects = written(differ.select(F.col("file").alias("pf"), F.col("at").alias("pa")), "merkle-suspects")
    differ = written(differ, "merkle-differ")
    shared = F.col("l").isNotNull() & F.col("r").isNotNull() & (F.greatest("l.n_records", "r.n_records") > 1)
    status = F.when(F.col("r.hash").isNull(), "missing").when(F.col("l.hash").isNull(), "extra").otherwise("damaged")
    plain = differ.where(~F.coalesce(shared, F.lit(False))).select(
        "file", "at", F.coalesce("l.page_id", "r.page_id").alias("page_id"), status.alias("status"),
        F.coalesce("l.offset", "r.offset").alias("offset"), F.coalesce("l.n_bytes", "r.n_bytes").alias("n_bytes"),
        F.col("l.hash").alias("hash"), F.col("r.hash").alias("hash_other"))
    several_differ = differ.where(shared)
    inside = _shared_differences(
        several_differ, (_with_lone(several, leaf, several_differ), _lone_ranges(ranges, leaf, several_differ)),
        (_with_lone(several_other, leaf_other, several_differ), _lone_ranges(ranges_other, leaf_other, several_differ)))
    located = inside.join(several_differ.select("file", "at", F.col("l.offset").alias("offset")), ["file", "at"]).select(
        "file", "at", "page_id", F.lit("damaged").alias("status"), "offset", "n_bytes", "hash", "hash_other")
    return plain.unionByName(located)


def _lone(leaf: DataFrame, places: DataFrame) -> DataFrame:
    """Places with one record, where the other replica has several."""
    return leaf.where("n_records = 1").join(places.select("file", "at"), ["file", "at"], "left_semi")


def _with_lone(several: DataFrame, leaf: DataFrame, places: DataFrame) -> DataFrame:
    lone = _lone(leaf, places).select(
        "file", "at", "hash", "page_id", F.lit(1).cast("long").alias("copies"), "n_bytes", F.substring("hash", 1, RANGE).alias("range"))
    return several.unionByName(lone)


def _lone_ranges(ranges: DataFrame, leaf: DataFrame, places: DataFrame) -> DataFrame:
    lone = _lone(leaf, places).select("file", "at", F.substring("hash", 1, RANGE).alias("range"), F.sha2(F.concat(F.col("hash"), F.lit(":1")), 256).alias("hash"))
    return ranges.unionByName(lone)
