"""Which dictionary entries occur inside which texts.

A cross product of texts and entries does not scale. A small dictionary is filtered in place by built-in functions; a larger one
becomes an automaton that finds all entries in one pass over a text, and one too large for that is looked up by hashes of the texts'
pieces, also in one pass. So the time follows the length of the texts, whatever the dictionary.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.operators.automaton import Automaton
from reviewmill.operators.pieces import match_pieces
from reviewmill.session import fresh_path

LITERAL_LIMIT = 128
GROUP_BYTES = 1 << 17  # entry bytes of an automaton: no more states than bytes, and so a bounded table
_WORD_EDGE = r"[\p{L}\p{N}_]"


def holds(text: Column, entry: Column, word: bool = False) -> Column:
    """Whether the entry occurs in the text, on request between word boundaries only."""
    held = F.contains(text, entry)
    if word:
        literal = F.concat(F.lit(r"\Q"), F.replace(entry, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        held = held & F.regexp_like(text, F.concat(F.lit(f"(?<!{_WORD_EDGE})"), literal, F.lit(f"(?!{_WORD_EDGE})")))
    return held


def _searcher(automaton, names, text_id: str, entry: str, word: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(names.value, pa.string())
        for batch in batches:
            texts = [text or b"" for text in batch.column("text").to_pylist()]
            number, found = automaton.value.find(texts, word)
            ids = batch.column("id").take(pa.array(number))
            yield pa.RecordBatch.from_arrays([ids, known.take(pa.array(found))], [text_id, entry])

    return run


def match_substrings(
    texts: DataFrame, entries: DataFrame, text_id: str, text: str, entry: str, word: bool = False,
    literal_limit: int = LITERAL_LIMIT,
) -> DataFrame:
    """``text_id, entry`` for every entry contained in a text.

    ``texts`` has one row per ``text_id``. Comparison is exact, so lower-case both sides
    first to ignore case. ``word=True`` asks for word boundaries around the entry as well.
    A dictionary of up to ``literal_limit`` entries becomes an array literal that each text
    filters in place. A larger one becomes a broadcast automaton; nothing is shuffled and only matches leave the pass. Past
    ``GROUP_BYTES`` a broadcast bitmap picks pieces of the texts that are then joined with the entries.
    """
    distinct = entries.select(entry).filter(F.length(entry) > 0).distinct()
    few = distinct.limit(literal_limit + 1).collect()
    if len(few) <= literal_limit:
        known = F.array(*[F.lit(r[0]) for r in few]).cast("array<string>")
        found = F.filter(known, lambda e: holds(F.col(text), e, word))
        return texts.select(text_id, F.explode(found).alias(entry))

    context = texts.sparkSession.sparkContext
    read = texts.select(F.col(text_id).alias("id"), F.col(text).cast("binary").alias("text"))
    schema = T.StructType([T.StructField(text_id, read.schema["id"].dataType), T.StructField(entry, T.StringType())])
    path = fresh_path(texts.sparkSession, "dictionary")
    distinct.write.parquet(path)
    held = texts.sparkSession.read.schema(distinct.schema).parquet(path)
    if held.agg(F.sum(F.octet_length(entry))).first()[0] > GROUP_BYTES:
        return match_pieces(read, held, text_id, entry, word, T.StructType([schema[0], T.StructField("_piece", T.BinaryType())]))
    names = [row[0] for row in held.sort(entry).collect()]
    automaton = Automaton([name.encode("utf-8") for name in names])
    return read.mapInArrow(_searcher(context.broadcast(automaton), context.broadcast(names), text_id, entry, word), schema)
