"""Ranked lexical search: term at a time over document blocks, with a limit on new accumulators.

Texts are cut into terms once and written as a forward index of the terms that any item holds, so a posting is two numbers and
texts never move. A task inverts its part of the index block by block and takes each item's terms rarest first. While the bounds of the
terms to come could lift an unseen document over the k-th partial score, postings create accumulators; once they cannot
(strictly, so that ties stay open), only survivors are updated, exactly, and those that fall behind are let go. The k-th
score found so far in a task is carried from block to block. A task hands on k rows per item; no pair of an item and a document
that does not rank in its task leaves it. Bounds are the largest contributions in the block, so nothing is approximate.

Items are searched in blocks chosen by hash with about ``BLOCK_TERMS`` (item, term) pairs; a block's vocabulary is what is broadcast.
An item is never cut: its terms are held at once.

Defined cases: a null or empty text, or one without a term, is no document (it counts in neither N nor L) and an item without
terms has no rows. Rows with one item id are one item with the terms of all, null being an id too. Repeated documents are each
ranked; a null doc_id ranks behind other ids of equal score. Very long texts are counted in pieces of a megabyte. Empty
tables give no rows. Only ids and texts are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmill.llm.common import whole_text, written

BLOCK_TERMS = 500_000  # (item, term) pairs searched in one pass over the index
BLOCK_POSTINGS = 1 << 20  # postings a task inverts at a time
_PIECE = 1 << 20
_SLICES = 64
_MARKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in _MARKS)  # A-Z to a-z, ASCII marks and controls to a space
_SPACE = re.compile(rb" ")


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text in order, in lists of about a megabyte."""
    folded = text.translate(_FOLD)
    start = 0
    while start < len(folded):
        found = _SPACE.search(folded, start + _PIECE)
        end = found.start() if found else len(folded)
        yield folded[start:end].split()
        start = end


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            distinct = sorted({term for part in terms(batch.column("text")[row].as_py()) for term in part})
            ids = pa.array([batch.column("item_id")[row].as_py()] * len(distinct), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(distinct, pa.binary())], ["item_id", "term"])


def _indexer(vocabulary):
    """Rows of doc_id, n (terms with repeats) and the places and counts of its terms in the vocabulary."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = vocabulary.value
        for batch in batches:
            ids, sizes, offsets, found, counts = [], [], [0], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                held: Counter[bytes] = Counter()
                for part in terms(text.as_py()):
                    held.update(part)
                if not held:
                    continue
                known = held.keys() & places.keys()
                ids.append(doc_id.as_py())
                sizes.append(held.total())
                found += [places[term] for term in known]
                counts += [held[term] for term in known]
                offsets.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, t)) for x, t in ((found, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return run


class Block:
    """Some documents, inverted: per term its documents in order, their contributions and the greatest of them."""

    def __init__(self, batches: list[pa.RecordBatch], weights: np.ndarray, documents: int, length: int):
        rows = pa.Table.from_batches(batches).combine_chunks()
        ids = rows["doc_id"].combine_chunks()
        self.nameless = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        n = rows["n"].to_numpy()
        exact = n if not len(n) or 90 * int(n.max()) * documents < 1 << 63 else n.astype(object)
        m = (10 + 90 * exact * documents // length).astype(np.int64)
        lists = rows["terms"].combine_chunks()
        term = lists.flatten().to_numpy()
        tf = rows["counts"].combine_chunks().flatten().to_numpy()
        doc = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy())
        gain = weights[term] * (1_000_000_000 * tf // (1_000 * tf + 8 * m[doc]))
        order = np.argsort(term, kind="stable")
        self.docs, self.gains = doc[order], gain[order]
        self.edges = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.bounds = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(np.diff(self.edges))
        if len(held):
            self.bounds[held] = np.maximum.reduceat(self.gains, self.edges[held])
        self.scores = np.zeros(len(n), np.int64)

    def search(self, rarest_first: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the best ``k``, and their exact scores; none that scores below ``least``."""
        scores = self.scores
        scores[:] = 0
        wanted = rarest_first[self.bounds[rarest_first] > 0]
        rest = np.append(np.cumsum(self.bounds[wanted][::-1])[::-1], 0)
        alive = None  # all documents with a score, while accumulators are made
        top = 0
        for step, term in enumerate(wanted):
            docs, gains = (x[self.edges[term]:self.edges[term + 1]] for x in (self.docs, self.gains))
            if alive is None and max(top, least) > rest[step]:
                touched = np.flatnonzero(scores)
                least = max(least, self._kth(scores[touched], k))
                if least > rest[step]:
                    alive = touched
            if alive is None:
                scores[docs] += gains
                top = max(top, int(scores[docs].max()))
                continue
            alive = alive[scores[alive] + rest[step] >= least]
            at = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
            hit = docs[at] == alive
            scores[alive[hit]] += gains[at[hit]]
            least = max(least, self._kth(scores[alive], k))
        found = np.flatnonzero(scores) if alive is None else alive
        least = max(least, self._kth(scores[found], k), 1)
        found = found[scores[found] >= least]
        return found, scores[found]

    @staticmethod
    def _kth(scores: np.ndarray, k: int) -> int:
        return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def _searcher(plan, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items, documents, length = plan.value
        best = [(np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)) for _ in items]  # score, without id, id

        def take(held: list[pa.RecordBatch]) -> None:
            block = Block(held, weights, documents, length)
            for item, rarest_first in enumerate(items):
                score, nameless, ids = best[item]
                found, scores = block.search(rarest_first, k, int(score[-1]) if len(score) == k else 0)
                if len(found):
                    score, nameless, ids = (np.concatenate(x) for x in ((score, scores), (nameless, block.nameless[found]), (ids, block.ids[found])))
                    order = np.lexsort((ids, nameless, -score))[:k]
                    best[item] = score[order], nameless[order], ids[order]

        held, postings = [], 0
        for batch in batches:
            held.append(batch)
            postings += len(batch.column("terms").flatten())
            if postings >= BLOCK_POSTINGS:
                take(held)
                held, postings = [], 0
        if held:
            take(held)
        if items and any(len(score) for score, _, _ in best):
            score, nameless, ids = (np.concatenate(x) for x in zip(*best, strict=True))
            number = np.repeat(np.arange(len(best)), [len(x[0]) for x in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), pa.array(ids, mask=nameless), pa.array(score)], ["item", "doc_id", "score"])

    return run


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each item; a slice of the documents first, so that no task meets more than a few thousand rows an item."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    by_slice = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(_SLICES))).orderBy(*order)
    first = scored.withColumn("rank", F.row_number().over(by_slice)).where(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, pairs: list[tuple[int | None, bytes]], k: int) -> DataFrame:
    spark = docs.sparkSession
    names = list(dict.fromkeys(item for item, _ in pairs))
    number = {name: k for k, name in enumerate(names)}
    vocabulary = {term: place for place, term in enumerate(sorted({term for _, term in pairs}))}
    index = written(docs.mapInArrow(
        _indexer(spark.sparkContext.broadcast(vocabulary)), "doc_id long, n long, terms array<int>, counts array<long>"), "lexical-index")
    documents, length = index.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for row in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    held: list[list[int]] = [[] for _ in names]
    for item, term in pairs:
        held[number[item]].append(vocabulary[term])
    items = [np.array(sorted(own, key=lambda place: (df[place], place)), np.int64) for own in held]
    plan = spark.sparkContext.broadcast((weights, items, documents, length))
    scored = index.mapInArrow(_searcher(plan, k), "item long, doc_id long, score long")
    named = spark.createDataFrame(list(enumerate(names)), "item long, item_id long")
    return _best(scored, k).join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int | None = None) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents of every item with a score above 0."""
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(whole_text(), "UTF-8").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.encode(whole_text(), "UTF-8").alias("text"))
    pairs = written(asked.mapInArrow(_item_terms, "item_id long, term binary").distinct(), "lexical-items")
    blocks = math.ceil(pairs.count() / (block_terms or BLOCK_TERMS))
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number in range(blocks):
        own = [(row["item_id"], bytes(row["term"])) for row in pairs.where(block == number).collect()]
        if own:
            found = found.unionByName(_search_block(read, own, k))
    return found
