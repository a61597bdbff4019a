"""Comma files with line breaks inside quoted cells, read by many tasks.

Whether a line break ends a row depends on all quotes before it, so such a file cannot be cut blindly. Here every split packs
its lines into chunks and notes whether a chunk holds an odd number of quotes. Running sums of these parities (over splits, then over a
split's chunks; the text stays where it is) tell which chunks begin inside a quoted cell. Each chunk then finds its own rows: they
end at the line breaks outside quotes. Rows that reach over chunks are put together from their fragments, which are few.

Quotes follow RFC 4180: a cell with a quote or a line break is quoted, a quote inside is doubled. Rows end with ``\\n`` or ``\\r\\n``.
Blank lines are skipped, and the first row of every file must be the same header; another one fails the read.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.operators.bounds import BROADCAST_ROWS
from reviewmill.session import fresh_path

CHUNK = 1 << 20  # bytes of lines handled as one row
_CHUNK_COLUMNS = "path string, block bigint, seq int, first_line bigint, odd boolean, text binary"
_ROW_COLUMNS = "path string, block bigint, seq int, pos bigint, part int, text binary"
WHOLE, HEAD, MIDDLE, TAIL = range(4)


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to chunks; the lines of a split stand in one task, in order."""
    held: list[bytes] = []
    place, seq, first, size = None, 0, 0, 0

    def chunk() -> pa.RecordBatch:
        text = b"\n".join(held)
        cells = [[place[0]], [place[1]], [seq], [first], [text.count(b'"') % 2 == 1], [text]]
        types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
        names = ["path", "block", "seq", "first_line", "odd", "text"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types, strict=True)], names)

    for batch in batches:
        paths, blocks = batch.column("path").to_pylist(), batch.column("block").to_pylist()
        for here, line in zip(zip(paths, blocks, strict=True), batch.column("line").to_pylist(), strict=True):
            if held and (here != place or size >= CHUNK):
                yield chunk()
                seq, first = (seq + 1, first + len(held)) if here == place else (0, 0)
                held, size = [], 0
            place = here
            held.append(line)
            size += len(line) + 1
    if held:
        yield chunk()


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks to rows and fragments of rows."""
    for batch in batches:
        for number in range(batch.num_rows):
            cell = {name: batch.column(name)[number].as_py() for name in batch.schema.names}
            text = cell["text"] + b"\n"
            data = np.frombuffer(text, np.uint8)
            breaks = np.flatnonzero(data == 10)
            quotes = np.cumsum(data == 34)[breaks] + cell["inside"]
            ends = breaks[quotes % 2 == 0]
            starts = np.concatenate([[0], ends + 1])
            lines = np.searchsorted(breaks, starts)  # line breaks ahead of a row are the lines ahead of it
            rows = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=False)]
            parts = [WHOLE] * len(rows)
            if cell["inside"]:
                if rows:
                    parts[0] = HEAD
                else:
                    rows, parts = [cell["text"]], [MIDDLE]
            if starts[-1] < len(text) and parts[-1:] != [MIDDLE]:
                rows.append(text[int(starts[-1]):-1])
                parts.append(TAIL)
            kept = [k for k, (row, part) in enumerate(zip(rows, parts, strict=True)) if part != WHOLE or row.strip()]
            n = len(kept)
            yield pa.RecordBatch.from_arrays([
                pa.array([cell["path"]] * n, pa.string()), pa.array([cell["block"]] * n, pa.int64()), pa.array([cell["seq"]] * n, pa.int32()),
                pa.array([2 * cell["block"] + cell["first_line"] + int(lines[k]) for k in kept], pa.int64()),
                pa.array([parts[k] for k in kept], pa.int32()), pa.array([rows[k] for k in kept], pa.binary()),
            ], ["path", "block", "seq", "pos", "part", "text"])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _inside(chunks: DataFrame) -> DataFrame:
    """``path, block, seq`` of the chunks that begin inside a quoted cell."""
    odd = F.col("odd").cast("int")
    splits = chunks.groupBy("path", "block").agg(F.sum(odd).alias("odds"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.select("path", "block", F.coalesce(F.sum("odds").over(before), F.lit(0)).alias("ahead"))
    earlier = Window.partitionBy("path", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    own = chunks.select("path", "block", "seq", F.coalesce(F.sum(odd).over(earlier), F.lit(0)).alias("own"))
    return own.join(begun, ["path", "block"]).where((F.col("ahead") + F.col("own")) % 2 == 1).select("path", "block", "seq")


def rows_of_files(spark: SparkSession, paths: list[str], where: Column | None = None) -> DataFrame:
    """``path, pos, text`` of every row, header rows included; ``pos`` orders the rows of a file, and is 0 for its first line.

    ``pos`` is twice the byte a split starts at plus the line in it: a split has no more lines than bytes.
    """
    read = spark.read.options(lineSep="\n", recursiveFileLookup=where is not None).text(paths)
    lines = (read if where is None else read.where(where)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    chunks = _written(lines.mapInArrow(_packed, _CHUNK_COLUMNS), "raw-chunks")
    inside = _written(_inside(chunks), "raw-inside")
    few = inside.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    marks = inside.withColumn("marked", F.lit(1))
    begun = chunks.join(F.broadcast(marks) if few else marks, ["path", "block", "seq"], "left").select(
        "path", "block", "seq", "first_line", F.coalesce("marked", F.lit(0)).alias("inside"), "text")
    cut = _written(begun.mapInArrow(_cut, _ROW_COLUMNS), "raw-rows")

    along = Window.partitionBy("path").orderBy("block", "seq", "part")
    row = F.sum((F.col("part") == TAIL).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fragments = cut.where(F.col("part") != WHOLE).withColumn("row", row)
    pieces = F.transform(F.sort_array(F.collect_list(F.struct("block", "seq", "part", "text"))), lambda f: f["text"].cast("string"))
    joined = fragments.groupBy("path", "row").agg(F.min("pos").alias("pos"), F.array_join(pieces, "\n").alias("text"))
    return cut.where(F.col("part") == WHOLE).select("path", "pos", F.col("text").cast("string").alias("text")).unionByName(joined.select("path", "pos", "text"))


def read_csv_in_splits(spark: SparkSession, paths: list[str], where: Column | None = None) -> DataFrame:
    """All-string columns of the header, with ``pos`` and ``path``: the same rows in the same order as a read file by file.

    ``where``, over the file path alone, prunes files below ``paths``.
    """
    rows = rows_of_files(spark, paths, where).withColumn("text", F.regexp_replace("text", "\r\\z", ""))
    first = rows.where("pos = 0").select(F.regexp_replace("text", "^﻿", "").alias("text"))
    header = first.first()
    if header is None:
        raise ValueError("no header in the first line of any file")
    columns = next(csv.reader([header["text"]]))
    clean = F.regexp_replace("text", "^﻿", "")
    other = F.raise_error(F.concat(F.lit("header differs in "), F.col("path"))).cast("boolean")
    checked = rows.where(F.when(F.col("pos") != 0, F.lit(True)).when(clean == header["text"], F.lit(False)).otherwise(other))
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    parsed = checked.select(F.from_csv("text", schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}).alias("cells"), "pos", "path")
    return parsed.select("cells.*", "pos", "path")
