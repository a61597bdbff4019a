"""Byte-level BPE: whole pre-tokens through a minimal perfect hash, the rest by heap merges over linked bytes, in blocks.

``encode`` adds ``ids``, ``decode`` turns ids back into bytes. Both work row by row inside Arrow batches and
never shuffle. A null or empty text has no ids and decodes to no bytes; very long texts are cut into pre-tokens
lazily, so memory follows a block of pre-tokens and not the text; repeated rows are encoded each on its own. Of the
input only the columns named in ``keep`` pass through, so other columns cannot clash with ``ids`` or ``decoded``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MAX_VOCABULARY_BYTES = 64 << 20  # checked before the vocabulary is broadcast
BLOCK_CHARS = 1 << 20  # texts are encoded in blocks of about this many characters
BLOCK_PIECES = 1 << 16
MEMO_BYTES = 80 << 20  # bound of one generation of a worker's memo, which has two
_ENTRY = 170  # bytes of a memo entry beside its key and ids, about
HEAPS = 4_096  # heaps of one block
SHORT = 32  # bytes of pre-tokens whose heaps are merged in blocks; longer ones are merged one by one
_NO_PAIR = np.int64(1 << 40)
_ID = np.dtype("<u4")


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a rank file (base64 token and rank a line)."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranked[k] for k in range(len(ranked))]


def _digests(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype=">u8").astype(np.uint64).reshape(-1, 2)


class PerfectHash:
    """Minimal perfect hash by levels of bit tables: a key rests at the first level where no other key shares its
    bit, and its number is the rank of that bit. 64-bit hashes are re-mixed per level."""

    def __init__(self, keys: list[bytes], spread: float = 2.0):
        hashed = _digests(keys)
        self.sizes: list[int] = []
        tables: list[np.ndarray] = []
        left = np.arange(len(keys))
        while len(left):
            size = max(8, int(len(left) * spread))
            at = self._slot(hashed[left], len(self.sizes), size)
            taken = np.bincount(at, minlength=size)
            tables.append(taken == 1)
            self.sizes.append(size)
            left = left[taken[at] != 1]
            if len(self.sizes) > 200:
                raise ValueError("keys must be distinct")
        self.bits = np.concatenate(tables) if tables else np.zeros(0, bool)
        self.rank = np.concatenate([[0], np.cumsum(self.bits)]).astype(np.int64)

    @staticmethod
    def _slot(hashed: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = hashed[:, 0] + np.uint64(2 * level + 1) * hashed[:, 1]
            mixed ^= mixed >> np.uint64(32)
        return (mixed % np.uint64(size)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """A number for each key, -1 where no level holds it; keys outside the set may get any number."""
        hashed = _digests(keys)
        found = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = base + self._slot(hashed[left], level, size)
            hit = self.bits[at]
            found[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
            if not len(left):
                break
        return found


def pair_ranks(tokens: list[bytes]) -> dict[int, int]:
    """Rank of what two neighbouring tokens make together, by left rank times the vocabulary's size plus right rank."""
    ranks, size = {token: rank for rank, token in enumerate(tokens)}, len(tokens)
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left * size + right] = rank
    return pairs


def heap_merge(parts: list[int], pairs: dict[int, int], size: int) -> list[int]:
    """Merge the ranks of a pre-token's bytes, in place, until no two neighbours make a token.

    The parts form a linked list; a heap yields the lowest-ranked pair of neighbours, leftmost first. An entry is one
    number: rank, then where the pair starts, then where it ends.
    """
    n = len(parts)
    wide = n + 1
    after = list(range(1, n + 2))  # by start of a part: start of the next
    before = list(range(-1, n))
    get, push, pop = pairs.get, heapq.heappush, heapq.heappop
    heap = []
    last = parts[0]
    for i in range(1, n):
        part = parts[i]
        if (rank := get(last * size + part)) is not None:
            heap.append((rank * wide + i - 1) * wide + i + 1)
        last = part
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        end = entry % wide
        entry //= wide
        i = entry % wide
        middle = after[i]
        if middle >= n or before[middle] != i or after[middle] != end:
            continue  # one of the two parts has been merged meanwhile
        merged = parts[i] = entry // wide
        after[i] = end
        before[middle] = -2
        if end < n:
            before[end] = i
            if (rank := get(merged * size + parts[end])) is not None:
                push(heap, (rank * wide + i) * wide + after[end])
        left = before[i]
        if left >= 0 and (rank := get(parts[left] * size + merged)) is not None:
            push(heap, (rank * wide + left) * wide + end)
    ids, i = [], 0
    while i < n:
        ids.append(parts[i])
        i = after[i]
    return ids


class HeapBlock:
    """The merges of many short pre-tokens at once, each with its linked bytes and its own heap.

    A heap is a heap-ordered complete tree over the places of a pre-token: a leaf holds the rank and place of the pair that starts there,
    a node the lesser of its two children, so the root is the lowest-ranked pair, leftmost first. All roots are popped together; a
    merge changes three leaves and the paths above them.
    """

    def __init__(self, pairs: dict[int, int], size: int, of_byte: list[int]):
        codes = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(codes)
        self.codes = np.append(codes[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], 0)
        self.size, self.of_byte = size, np.array(of_byte, np.int64)

    def _keys(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, there: np.ndarray) -> np.ndarray:
        """What a leaf holds for two neighbours: ``_NO_PAIR`` where there are not two or they make no token."""
        code = np.where(there, left * self.size + right, -1)
        at = np.searchsorted(self.codes, code)
        return np.where(self.codes[at] == code, self.ranks[at] * SHORT + place, _NO_PAIR)

    def merge(self, keys: list[bytes]) -> list[bytes]:
        """Packed ids of pre-tokens of at most ``SHORT`` bytes."""
        n = np.fromiter(map(len, keys), np.int64, len(keys))
        width = 8
        while width < n.max():
            width *= 2
        flat = np.frombuffer(b"".join(key.ljust(width, b"\0") for key in keys), np.uint8).reshape(len(keys), width)
        place = np.arange(width)
        parts = np.where(place < n[:, None], self.of_byte[flat], -1)
        after = np.tile(np.arange(1, width + 2), (len(keys), 1))
        before = np.tile(np.arange(-1, width), (len(keys), 1))
        right = np.concatenate([parts[:, 1:], np.full((len(keys), 1), -1)], axis=1)
        tree = [self._keys(parts, right, place, right >= 0)]
        while tree[-1].shape[1] > 1:
            tree.append(np.minimum(tree[-1][:, ::2], tree[-1][:, 1::2]))
        rows = np.flatnonzero(tree[-1][:, 0] < _NO_PAIR)
        while len(rows):
            root = tree[-1][rows, 0]
            at, rank = root % SHORT, root // SHORT
            middle = after[rows, at]
            end = after[rows, middle]
            parts[rows, at], parts[rows, middle] = rank, -1
            after[rows, at] = end
            before[rows, end] = at
            inside = end < n[rows]
            ahead = before[rows, at]
            behind = np.where(inside, end, 0)
            self._put(tree, rows, middle, np.full(len(rows), _NO_PAIR))
            self._put(tree, rows, at, self._keys(rank, parts[rows, behind], at, inside))
            led = ahead >= 0
            self._put(tree, rows[led], ahead[led], self._keys(parts[rows[led], ahead[led]], rank[led], ahead[led], True))
            rows = rows[tree[-1][rows, 0] < _NO_PAIR]
        held = parts >= 0
        ends = np.cumsum(held.sum(axis=1) * 4).tolist()
        packed = parts[held].astype(_ID).tobytes()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    @staticmethod
    def _put(tree: list[np.ndarray], rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        tree[0][rows, at] = value
        for below, level in zip(tree, tree[1:], strict=False):
            at = at >> 1
            level[rows, at] = np.minimum(below[rows, 2 * at], below[rows, 2 * at + 1])


class Memo:
    """Ids by text, in two generations: a full one becomes the old one, from which only what is asked for again is kept."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def put(self, key: str, ids: bytes) -> None:
        self.young[key] = ids
        self.size += len(key) + len(ids) + _ENTRY

    def missing(self, keys: Iterable[str]) -> set[str]:
        """Keys of neither generation; those of the old one move to the young one."""
        young, old, unknown = self.young, self.old, set()
        for key in keys:
            if key not in young:
                if key in old:
                    self.put(key, old[key])
                else:
                    unknown.add(key)
        return unknown

    def age(self) -> None:
        if self.size > MEMO_BYTES:
            self.young, self.old, self.size = {}, self.young, 0


class Encoder:
    """Texts to ids, as packed little-endian 32-bit numbers; lives as long as a worker process.

    Where a single space stands before anything but white space, a pre-token begins whatever comes before or after,
    so texts are cut at spaces first and each distinct part is matched once per block; a text with a space before white
    space or at its end is matched whole. The memo only keeps results of the two tiers, for parts and pre-tokens alike; it is
    bounded by bytes.
    """

    def __init__(self, tokens: list[bytes], pattern: str):
        self.pattern = regex.compile(pattern)
        self.blank_first = regex.compile(r" (?:\s|$)").match
        self.pairs = pair_ranks(tokens)
        ranks = {token: rank for rank, token in enumerate(tokens)}
        self.of_byte = [ranks[bytes([byte])] for byte in range(256)]
        self.hash = PerfectHash(tokens)
        self.slots = np.empty(len(tokens), _ID)
        self.slots[self.hash.find(tokens)] = np.arange(len(tokens), dtype=_ID)
        self.tokens = tokens
        self.packed = [int(rank).to_bytes(4, "little") for rank in range(len(tokens))]
        self.block = HeapBlock(self.pairs, len(tokens), self.of_byte)
        self.memo = Memo()

    def cuts(self, text: str) -> Iterator[tuple[list[str], bool]]:
        """Lists that together are the text, and whether they hold pre-tokens: cut at spaces, or, if very long, matched."""
        if len(text) <= BLOCK_CHARS:
            first, *rest = text.split(" ")
            yield [first, *[" " + part for part in rest]], False
            return
        matches = self.pattern.finditer(text)
        while block := [m.group() for m in islice(matches, BLOCK_PIECES)]:
            yield block, True

    def resolve(self, pieces: Iterable[str]) -> None:
        """Put pre-tokens into the memo: first tier by the perfect hash, all at once; then the heaps."""
        texts = list(pieces)
        keys = [text.encode("utf-8") for text in texts]
        put, packed, tokens = self.memo.put, self.packed, self.tokens
        slots = self.hash.find(keys)
        ranks = np.where(slots >= 0, self.slots[slots], 0).tolist()
        short = []
        for number, (key, slot, rank) in enumerate(zip(keys, slots.tolist(), ranks, strict=True)):
            if slot >= 0 and tokens[rank] == key:
                put(texts[number], packed[rank])
            elif len(key) <= SHORT:
                short.append(number)
            else:
                ids = heap_merge([self.of_byte[byte] for byte in key], self.pairs, len(tokens))
                put(texts[number], b"".join([packed[rank] for rank in ids]))
        short.sort(key=lambda number: len(keys[number]))
        for start in range(0, len(short), HEAPS):
            some = short[start:start + HEAPS]
            for number, ids in zip(some, self.block.merge([keys[number] for number in some]), strict=True):
                put(texts[number], ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        found: list[list[bytes]] = [[] for _ in texts]
        blocks: list[tuple[int, list[str], bool]] = []
        chars = 0
        for k, text in enumerate(texts):
            for block, matched in self.cuts(text or ""):
                blocks.append((k, block, matched))
                chars += min(len(text or ""), BLOCK_CHARS)
                if chars >= BLOCK_CHARS:
                    self._flush(blocks, found)
                    blocks, chars = [], 0
        self._flush(blocks, found)
        return [b"".join(parts) for parts in found]

    def _flush(self, blocks: list[tuple[int, list[str], bool]], found: list[list[bytes]]) -> None:
        self.memo.age()
        unseen = self._unseen(blocks)
        if unsafe := {part for part in unseen if self.blank_first(part)}:
            for at, (k, block, matched) in enumerate(blocks):
                if not matched and not unsafe.isdisjoint(block):
                    blocks[at] = k, self.pattern.findall("".join(block)), True
            unseen = self._unseen(blocks)
        # a part that is one pre-token is resolved as such; the others are put together from theirs
        split = [(part, own) for part, own in zip(unseen, map(self.pattern.findall, unseen), strict=True) if own != [part]]
        wanted = unseen.difference(part for part, _ in split)
        wanted.update(*(own for _, own in split), *(block for _, block, matched in blocks if matched))
        self.resolve(self.memo.missing(wanted))
        ids = self.memo.young.__getitem__
        for part, own in split:
            self.memo.put(part, b"".join(map(ids, own)))
        for k, block, _ in blocks:
            found[k].append(b"".join(map(ids, block)))

    def _unseen(self, blocks: list[tuple[int, list[str], bool]]) -> set[str]:
        """Parts not in the memo. A part that begins with two blanks is never put there."""
        return self.memo.missing(chain.from_iterable(block for _, block, matched in blocks if not matched))


_ENCODERS: dict[tuple[str, str], Encoder] = {}  # of this process, which outlives its tasks


def worker_encoder(shared, path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, pattern] = Encoder(shared.value, pattern)
    return _ENCODERS[path, pattern]


def _lists(packed: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in packed], out=offsets[1:])
    values = np.frombuffer(b"".join(packed), _ID).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def id_lists(column: pa.ListArray) -> Iterator[list[int]]:
    """The lists of an Arrow column as Python lists; null is an empty list."""
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    for row, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        yield values[start:end].tolist() if column[row].is_valid else []


def _slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of one column, a row at least."""
    for batch in batches:
        start = 0
        sizes = batch.column(column).nbytes / max(1, batch.num_rows)
        step = max(1, int(most / max(1.0, sizes)))
        while start < batch.num_rows:
            yield batch.slice(start, step)
            start += step


def _vocabulary(df: DataFrame, path: str):
    tokens = load_ranks(path)
    if (size := sum(map(len, tokens)) + 40 * len(tokens)) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary of {size} bytes is too large to broadcast")
    return df.sparkSession.sparkContext.broadcast(tokens)


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and ``ids`` (array of int) of every text, one row per input row."""
    shared = _vocabulary(docs, path)
    read = docs.select(*keep, docs[text].alias("__text"))
    schema = T.StructType([*(docs.schema[name] for name in keep), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared, path, pattern)
        for part in _slices(batches, "__text"):
            packed = encoder.encode(part.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(part.column(name) for name in keep), _lists(packed)], [*keep, "ids"])

    return read.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id", "ids")) -> DataFrame:
    """``keep`` columns and ``decoded`` (binary) of every row of ids; null ids decode to no bytes."""
    shared = _vocabulary(encoded, path)
    read = encoded.select(*keep, encoded["ids"].alias("__ids"))
    schema = T.StructType([*(encoded.schema[name] for name in keep), T.StructField("decoded", T.BinaryType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for part in _slices(batches, "__ids"):
            texts = [b"".join(map(token, ids)) for ids in id_lists(part.column("__ids"))]
            yield pa.RecordBatch.from_arrays([*(part.column(name) for name in keep), pa.array(texts, pa.binary())], [*keep, "decoded"])

    return read.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, n_tokens, and SHA-256 of a text's ids (little-endian 32-bit) and of what they decode to, in one pass."""
    shared = _vocabulary(docs, path)
    read = docs.select(*keep, docs[text].alias("__text"))
    own = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    schema = T.StructType([*(docs.schema[name] for name in keep), *own])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared, path, pattern)
        token = encoder.tokens.__getitem__
        for part in _slices(batches, "__text"):
            packed = encoder.encode(part.column("__text").to_pylist())
            decoded = (b"".join(map(token, np.frombuffer(ids, _ID).tolist())) for ids in packed)
            yield pa.RecordBatch.from_arrays([
                *(part.column(name) for name in keep), pa.array([len(ids) // 4 for ids in packed], pa.int64()),
                pa.array([hashlib.sha256(ids).hexdigest() for ids in packed], pa.string()),
                pa.array([hashlib.sha256(text).hexdigest() for text in decoded], pa.string()),
            ], [*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    return read.mapInArrow(run, schema)
