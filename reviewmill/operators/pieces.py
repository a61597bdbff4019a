"""A dictionary of any size against texts: pieces of texts that may be entries, by rolling hashes and a bitmap.

A piece of an entry's length may be an entry if its hash is in the bitmap; lengths from one power of two to the next are only tried where
the piece of that power may begin an entry. So one pass over the texts serves the whole dictionary, and what it hands on is text
for an exact join. A full bitmap, which is bounded, lets more pieces through and none less.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.operators.automaton import Automaton, _slices

SLICE = 1 << 19  # text bytes hashed at a time
MAX_BITS = 1 << 28  # 32 MB: the bound of what is broadcast

_BASE = 0x9E3779B97F4A7C15
_VALUE = (np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))


class _Hashes:
    """Hashes of all pieces of some bytes, from prefix polynomials modulo 2**64."""

    def __init__(self, data: np.ndarray):
        self.prefix = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[data] * _powers(_BASE, len(data))[:len(data)])])
        self.down = _powers(pow(_BASE, -1, 1 << 64), len(data))

    def of(self, at: np.ndarray, size: np.ndarray | int, whole: bool) -> np.ndarray:
        """Of the pieces from these places on, as entries or as beginnings of entries."""
        return _mix((self.prefix[at + size] - self.prefix[at]) * self.down[at] + np.asarray(2 * size + whole, np.uint64))


def _entry_hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both hashes of every entry: the whole, and its beginning of a power of two bytes."""
    for batch in batches:
        entries = batch.column(0).to_pylist()
        for first in range(0, len(entries), 1 << 12):
            some = entries[first:first + (1 << 12)]
            size = np.array([len(e) for e in some], np.int64)
            start = np.cumsum(size) - size
            hashes = _Hashes(np.frombuffer(b"".join(some), np.uint8))
            begin = np.array([1 << (n.bit_length() - 1) for n in size.tolist()], np.int64)
            both = np.unique(np.concatenate([hashes.of(start, size, True), hashes.of(start, begin, False)]))
            yield pa.RecordBatch.from_arrays([pa.array(both.view(np.int64))], ["hash"])


def _bitmap(entries: DataFrame) -> np.ndarray:
    """Two bits per hash, named by its highest and its lowest digits."""
    hashes = entries.mapInArrow(_entry_hashes, "hash long")
    wide = min(max(64 * entries.count(), 1 << 16).bit_length(), MAX_BITS.bit_length() - 1)
    places = F.array(F.shiftrightunsigned("hash", 64 - wide), F.col("hash").bitwiseAND(F.lit((1 << wide) - 1)))
    bit = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    slots = hashes.select(F.explode(places).alias("at")).groupBy(F.shiftright("at", 6).alias("slot")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros((1 << wide) // 64, np.int64)
    bits[slots["slot"].to_numpy()] = slots["bits"].to_numpy()
    return bits.view(np.uint8)


def _maybe(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    wide = len(bits).bit_length() + 2
    found = np.ones(len(hashes), bool)
    for at in (hashes >> np.uint64(64 - wide), hashes & np.uint64((1 << wide) - 1)):
        found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0
    return found


def _candidates(texts: list[bytes], lengths: list[int], bits: np.ndarray, word: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """Text, start and end of what may be an entry; places count from the start of the joined texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    text = np.repeat(np.arange(len(texts)), sizes)
    stop = offsets[1:][text]
    inside = np.append((data & 0xC0) == 0x80, False)  # not the first byte of a character
    hashes = _Hashes(data)
    every = np.flatnonzero(~inside[:-1])
    for power in sorted({n.bit_length() for n in lengths}):
        own = [n for n in lengths if n.bit_length() == power]
        at = every[every + (1 << (power - 1)) <= stop[every]]
        at = at[_maybe(hashes.of(at, 1 << (power - 1), False), bits)]
        for n in own:
            start = at[at + n <= stop[at]]
            start = start[~inside[start + n] | (start + n == stop[start])]
            start = start[_maybe(hashes.of(start, n, True), bits)]
            if word and len(start):
                start = start[Automaton._free(data, offsets, text[start], start, start + n)]
            yield text[start], start - offsets[text[start]], start - offsets[text[start]] + n


def _searcher(bitmap, lengths: list[int], word: bool, text_id: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            texts = [text or b"" for text in batch.column("text").to_pylist()]
            found: dict[tuple[int, bytes], None] = {}
            for slices in _slices(texts, max(lengths) + 8, SLICE):
                held = [piece[1] for piece in slices]
                for number, start, end in _candidates(held, lengths, bits, word):
                    for k, a, b in zip(number.tolist(), start.tolist(), end.tolist(), strict=True):
                        owner, text, cut_before, cut_behind = slices[k]
                        # what touches a cut is found whole, with what stands around it, in the neighbouring piece
                        if not (cut_before and a < 4) and not (cut_behind and len(text) - b < 4):
                            found[owner, text[a:b]] = None
            ids = batch.column("id").take(pa.array([owner for owner, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([piece for _, piece in found], pa.binary())], [text_id, "_piece"])

    return run


def match_pieces(texts: DataFrame, entries: DataFrame, text_id: str, entry: str, word: bool, schema: T.StructType) -> DataFrame:
    """``text_id, entry`` for every entry in a text of ``id, text`` (binary). ``entries`` are different, none is empty."""
    keyed = entries.select(entry, F.col(entry).cast("binary").alias("_piece"))
    lengths = [row[0] for row in keyed.select(F.octet_length("_piece")).distinct().collect()]
    bits = texts.sparkSession.sparkContext.broadcast(_bitmap(keyed.select("_piece")))
    found = texts.mapInArrow(_searcher(bits, lengths, word, text_id), schema)
    return found.join(keyed, "_piece").select(text_id, entry)
