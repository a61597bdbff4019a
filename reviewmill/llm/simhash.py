"""SimHash near-duplicates: 64-bit fingerprints linked within a few bits, found by BK-trees, closed to components.

Fingerprints are counted in blocks of shingles, so a long text never stands in memory as shingles at once. Two
fingerprints within ``radius`` bits agree on all but ``radius`` of any blocks of their bits, so the corpus is sharded by
the values of the remaining blocks and each shard has its own BK-tree: only its own members search it. A shard over
``SHARD`` fingerprints is split at random into several trees, and its members go to all of them: as a broadcast while the
trees of such shards together stay below ``MAX_BROADCAST_BYTES``, else by a join on the shard. A task hands on a star per
tree instead of all pairs, which loses no connection. Links are exact: no shard, tree or neighbour is cut off.

Null and empty texts, and those without a word, have fingerprint zero and are linked like any other. Repeated rows have
one fingerprint and so one component. A null doc_id gets a fingerprint and a component; the component's id is its
smallest doc_id that is not null. Columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations, accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import bktree
from reviewmill.llm.common import DIGEST, text_digest, whole_text, without, written
from reviewmill.llm.components import star_labels

SHARD = 1 << 14  # fingerprints of one tree, about
MAX_BROADCAST_BYTES = 64 << 20
MEAN_BUCKET = 64  # more and narrower blocks are compared once buckets would hold more on average
SEED = 42
_TEXT_BLOCK = 1 << 20
_HASH_BLOCK = 1 << 15
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """Words in blocks of about a megabyte, each but the first led by none of the words before."""
    start = 0
    while start < len(text):
        cut = len(text)
        if start + _TEXT_BLOCK < len(text):
            found = _BLANK.search(text, start + _TEXT_BLOCK)
            cut = found.start() if found else len(text)
        yield text[start:cut].split()
        start = cut


def _shingle_hashes(text: bytes, length: int) -> Iterator[np.ndarray]:
    carried: list[bytes] = []
    shingles = 0
    for words in _word_blocks(text):
        words = carried + words
        joined = b" ".join(words)
        starts = list(accumulate((len(word) + 1 for word in words), initial=0))
        digest = xxhash.xxh64_intdigest
        for low in range(0, len(words) - length + 1, _HASH_BLOCK):
            high = min(low + _HASH_BLOCK, len(words) - length + 1)
            yield np.array(
                [digest(joined[a:b - 1], SEED) for a, b in zip(starts[low:high], starts[low + length:high + length], strict=True)], np.uint64)
            shingles += high - low
        carried = words[-(length - 1):] if length > 1 else []
    if not shingles and carried:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carried), SEED)], np.uint64)


def fingerprint(text: bytes, length: int = 3) -> int:
    """A bit is one where over half of the shingles' hashes have it; A-Z are lower-cased first."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in _shingle_hashes(text.translate(_LOWER), length):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0]) if n else 0


def fingerprints(docs: DataFrame, length: int = 3, *carried: Column) -> DataFrame:
    """doc_id, the carried columns and fingerprint (long), one row per input row."""
    read = docs.select("doc_id", *carried, F.encode(whole_text(), "UTF-8").alias("text"))
    own = [f for f in read.schema.fields if f.name != "text"]
    names = [f.name for f in own]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(text.as_py(), length) for text in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names), pa.array(values.view(np.int64))], [*names, "fingerprint"])

    return read.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own) + ", fingerprint long")


def _bucket_keys(blocks: int, radius: int) -> list[Column]:
    """One long per choice of the blocks that must agree: the choice's number, then their bits."""
    edge = [round(64 * k / blocks) for k in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key = F.lit(number).cast("long")
        for k in chosen:
            wide = edge[k + 1] - edge[k]
            bits = F.shiftrightunsigned("fingerprint", edge[k]).bitwiseAND(F.lit((1 << wide) - 1))
            key = F.shiftleft(key, wide).bitwiseOR(bits)
        keys.append(key)
    return keys


def _block_count(n: int, radius: int) -> int:
    """Blocks for ``n`` fingerprints: the fewest whose buckets stay small on average; it moves work, never results."""
    for blocks in range(radius + 1, radius + 4):
        if n >> (64 * (blocks - radius) // blocks) <= MEAN_BUCKET:
            break
    return blocks


_LINK = "a long, b long"


def _star_batch(values: np.ndarray, links: bktree.Links) -> pa.RecordBatch:
    rest, center = links.star()
    return pa.RecordBatch.from_arrays(
        [pa.array(values[rest].view(np.int64)), pa.array(values[center].view(np.int64))], ["a", "b"])


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists, and the number of each one's list."""
    flat = column.flatten().to_numpy().astype(np.int64).view(np.uint64)
    return flat, np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())


def _within(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, tree = _flat(batch.column("members"))
            links = bktree.Links(len(values))
            for query, node in bktree.search(bktree.build(values, tree), values, tree, radius):
                links.add(query, node)
            yield _star_batch(values, links)

    return run


def _across(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                nodes, tree = _flat(batch.column("tree").slice(row, 1))
                queries, own = _flat(batch.column("members").slice(row, 1))
                links = bktree.Links(len(nodes) + len(queries))
                for query, node in bktree.search(bktree.build(nodes, tree), queries, own, radius):
                    links.add(query + len(nodes), node)
                yield _star_batch(np.concatenate([nodes, queries]), links)

    return run


def links(distinct: DataFrame, radius: int = 2, shard: int = SHARD, broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints connected by pairs within the radius."""
    keys = F.array(*_bucket_keys(_block_count(distinct.count(), radius), radius))
    keyed = distinct.select("fingerprint", F.explode(keys).alias("key"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    placed = keyed.join(counts, "key").select(
        "key", "fingerprint", F.ceil(F.col("n") / shard).alias("shards")).withColumn(
        "shard", F.pmod(F.xxhash64("fingerprint"), "shards"))
    shards = written(placed.groupBy("key", "shard", "shards").agg(F.collect_list("fingerprint").alias("members")), "simhash-shards")
    inside = shards.select("members").mapInArrow(_within(radius), _LINK)
    split = shards.where("shards > 1")
    nodes = split.agg(F.sum(F.size("members"))).first()[0]
    if not nodes:
        return inside
    trees = split.select("key", F.col("shard").alias("tree_shard"), F.col("members").alias("tree"))
    if nodes * 8 <= broadcast_bytes:
        trees = F.broadcast(trees)
    met = split.join(trees, "key").where("tree_shard < shard").select("tree", "members")
    return inside.unionByName(met.mapInArrow(_across(radius), _LINK))


def _placed(docs: DataFrame, length: int, radius: int, carried: tuple[Column, ...]) -> tuple[list[str], DataFrame]:
    """Names of the row's own columns, and the rows with the fingerprint at the center of their component."""
    marked = written(fingerprints(docs, length, *carried), "simhash-fingerprints")
    distinct = written(marked.select("fingerprint").distinct(), "simhash-distinct")
    center = star_labels(links(distinct, radius))
    placed = marked.join(center, marked["fingerprint"] == center["node"], "left").select(
        *marked.columns, F.coalesce("center", "fingerprint").alias("center"))
    return marked.columns, written(placed, "simhash-placed")


def near_duplicates(docs: DataFrame, length: int = 3, radius: int = 2, carried: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id, the carried columns, fingerprint (long) and component_id of every row."""
    own, placed = _placed(docs, length, radius, carried)
    # written, so that the join below meets two plain tables and a component with many rows can be split over tasks
    smallest = written(placed.groupBy("center").agg(F.min("doc_id").alias("component_id")), "simhash-smallest")
    return placed.join(smallest, "center").select(*own, "component_id")


def keep_one(docs: DataFrame, length: int = 3, radius: int = 2) -> DataFrame:
    """One row of every component, with all its columns: that of the smallest doc_id, nulls last, and of its texts the one with the
    smallest hash; of rows that repeat both, any one."""
    _, placed = _placed(docs, length, radius, (text_digest(),))
    pairs = written(placed.groupBy("center", "doc_id", DIGEST).agg(F.count("*").alias("rows")), "simhash-pairs")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col(DIGEST).alias("digest")))
    winners = written(pairs.groupBy("center").agg(first.alias("first")), "simhash-winners")
    judged = pairs.join(winners, "center").withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col(DIGEST) == F.col("first.digest")))
    judged = written(judged.select("doc_id", DIGEST, "rows", "stays"), "simhash-judged")
    stay = without(docs.select("*", text_digest()), judged.where("not stays"), "doc_id", DIGEST)
    repeated = judged.where("stays and rows > 1").select(F.col("doc_id").alias("__id"), F.col(DIGEST).alias("__same"))
    if not repeated.isEmpty():
        same = stay["doc_id"].eqNullSafe(repeated["__id"]) & (stay[DIGEST] == repeated["__same"])
        once = stay.join(repeated, same, "left_semi").dropDuplicates(["doc_id", DIGEST])
        stay = stay.join(repeated, same, "left_anti").unionByName(once)
    return stay.select(*docs.columns)
