"""Phrase collocations: n-grams counted by Rabin-Karp fingerprints, then read from the text where they are frequent.

Many texts stand in one buffer. Prefix polynomials over its bytes give every word a hash, prefix polynomials over those give every
n-gram one, all as numpy arrays with 64-bit wrap-around; language and length are mixed in. Three scans of the texts:

1. words and pairs: (fingerprint, count) per part of the corpus, summed by one shuffle;
2. phrases of three and four words whose pairs all may be frequent (a phrase is no more frequent than its parts);
3. occurrences that may be frequent, as all their parts must be: a pointer to the first of each in the buffer is followed to the text, and the
   others are compared with it word by word, so phrases that share a fingerprint are told apart. Only these phrases
   become text; their counts are summed by phrase, which makes them exact, and every phrase carries the doc_id of one occurrence.

"May be frequent" is a bitmap of the fingerprints with enough occurrences, at most ``MAX_FILTER_BITS``, sized by their
counted number. It has no false negatives; the fuller it is, the more infrequent phrases scan 3 writes out, and they fall at the exact count.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated rows count each; a null doc_id only shows in the
pointer. Texts over ``BUFFER`` bytes are taken in pieces that share three words, and an n-gram is counted where its last word is new; a word
is never cut, and those of ``WIDE`` bytes or more are compared by SHA-256. Empty tables give no rows. Only the three columns named are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmill.llm.common import whole_text, written

LONGEST = 4
BUFFER = 1 << 19  # bytes hashed at a time; arrays over them, of eight bytes an item, are most of what a task holds
WIDE = 1 << 16  # words of so many bytes are hashed by their digest, so that no word fills a buffer
HELD = 1 << 21  # (fingerprint, count) entries a task sums before it hands them on
HELD_PHRASES = 1 << 15  # phrases a task sums before it hands them on
MAX_FILTER_BITS = 1 << 28  # 32 MB: the bound of what is broadcast
_RANK_SLICES = 64

_BASE, _WORD_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BYTE = (np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_FOLD = bytes(
    10 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b
    for b in range(256))  # cuts to a line feed, tab to space, A-Z to a-z
_GAP = re.compile(rb"[ \n]")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were ever asked for."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(n + n // 4, base, np.uint64)])) for base in (self.base, self.inverse))
        return self.up, self.down


_BYTES, _WORDS = _Powers(_BASE), _Powers(_WORD_BASE)


def _prefix(values: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """Prefix polynomials of the values, one more than values, and the inverse powers that shift a difference to place 0."""
    up, down = powers.upto(len(values) + 1)
    return np.concatenate([[np.uint64(0)], np.cumsum(values * up[:len(values)])]), down


class Buffer:
    """Texts with their rows, cut into words; ``old`` words at the front were counted before, in the piece they come from."""

    def __init__(self, texts: list[bytes], rows: list[int], seeds: np.ndarray, wide: dict[bytes, bytes], old: int = 0):
        self.wide = wide
        self.raw = b"\n".join(texts)
        self.bytes = np.frombuffer(self.raw, np.uint8)
        gap = (self.bytes == 32) | (self.bytes == 10)
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]])))
        self.start, self.end = edge[::2], edge[1::2]
        self.old = old
        lines = np.cumsum(self.bytes == 10, dtype=np.int64)
        self.piece = lines[self.start] if len(self.start) else np.zeros(0, np.int64)
        firsts = np.cumsum([0, *(len(text) + 1 for text in texts)])[:-1]
        text_of = np.searchsorted(firsts, self.start, side="right") - 1
        self.row = np.asarray(rows, np.int64)[text_of]
        self.seed = seeds[self.row]
        prefix, down = _prefix(_BYTE[self.bytes], _BYTES)
        self.word = _mix((prefix[self.end] - prefix[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        self.words, self.word_down = _prefix(self.word, _WORDS)

    def grams(self, n: int) -> np.ndarray:
        """First words of the n-grams that lie in one piece of text."""
        last = len(self.start) - n + 1
        return np.flatnonzero(self.piece[:last] == self.piece[n - 1:]) if last > 0 else np.zeros(0, np.int64)

    def fresh(self, at: np.ndarray, n: int) -> np.ndarray:
        """Those that end with a word that is new."""
        return at[at + n - 1 >= self.old] if self.old else at

    def fingerprints(self, at: np.ndarray, n: int) -> np.ndarray:
        return _mix((self.words[at + n] - self.words[at]) * self.word_down[at] ^ (self.seed[at] + np.uint64(n)))

    def word_numbers(self) -> np.ndarray:
        """A number per word, equal exactly for equal bytes: each word is compared with the first of its hash."""
        _, first, number = np.unique(self.word, return_index=True, return_inverse=True)
        size, like = self.end - self.start, first[number]
        same = np.array_equal(size, size[like])
        if same:
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            same = np.array_equal(self.bytes[np.repeat(self.start, size) + inside], self.bytes[np.repeat(self.start[like], size) + inside])
        if same:
            return number
        numbers: dict[bytes, int] = {}
        return np.array([numbers.setdefault(self.raw[a:b], len(numbers)) for a, b in zip(self.start.tolist(), self.end.tolist(), strict=True)], np.int64)

    def phrases(self, at: np.ndarray, n: int) -> Iterator[bytes]:
        """The n-grams from these words on, single-spaced, read from the text."""
        starts, ends = self.start[at], self.end[at + n - 1]
        plain = ends - starts == n - 1 + sum((self.end[at + k] - self.start[at + k] for k in range(n)), np.zeros(len(at), np.int64))
        for a, b, as_is in zip(starts.tolist(), ends.tolist(), plain.tolist(), strict=True):
            phrase = self.raw[a:b] if as_is else b" ".join(filter(None, self.raw[a:b].split(b" ")))
            if self.wide and b"\xff" in phrase:
                phrase = b" ".join(self.wide.get(word, word) for word in phrase.split(b" "))
            yield phrase


def _shortened(text: bytes, wide: dict[bytes, bytes]) -> bytes:
    """The folded text with a token for each word of ``WIDE`` bytes or more; a token's first byte is in no UTF-8 text."""
    if len(text) < WIDE:
        return text

    def short(word: re.Match) -> bytes:
        own = word.group()
        if len(own) < WIDE:
            return own
        token = b"\xff" + hashlib.sha256(own).hexdigest().encode()
        wide[token] = own
        return token

    return re.sub(rb"[^ \n]+", short, text)


def _pieces(text: bytes) -> Iterator[tuple[bytes, int]]:
    """(piece, words it repeats) of a folded text; all but the first repeat the last words before."""
    start, carried = 0, b""
    while start < len(text):
        found = _GAP.search(text, start + BUFFER)
        end = found.start() + 1 if found else len(text)
        piece = carried + text[start:end]
        yield piece, len(carried.split())
        at = len(piece)
        for _ in range(LONGEST - 1):
            at = len(piece[:at].rstrip(b" \n"))
            at = max(piece.rfind(b" ", 0, at), piece.rfind(b"\n", 0, at)) + 1
        carried = re.sub(rb"[ \n]+", lambda gap: b"\n" if b"\n" in gap.group() else b" ", piece[at:])
        start = end


def _buffers(batch: pa.RecordBatch) -> Iterator[Buffer]:
    """The words of a batch in buffers of about ``BUFFER`` bytes."""
    langs, wide = batch.column("lang").to_pylist(), {}
    seeds = np.array([xxhash.xxh3_64_intdigest(lang) for lang in langs], np.uint64)
    texts, rows, size = [], [], 0
    for row, text in enumerate(batch.column("text")):
        folded = _shortened(text.as_py().translate(_FOLD), wide)
        if len(folded) > BUFFER:
            for piece, old in _pieces(folded):
                yield Buffer([piece], [row], seeds, wide, old)
            continue
        texts.append(folded)
        rows.append(row)
        size += len(folded)
        if size >= BUFFER:
            yield Buffer(texts, rows, seeds, wide)
            texts, rows, size = [], [], 0
    if texts:
        yield Buffer(texts, rows, seeds, wide)


class _Sums:
    """Counts by fingerprint, summed when many came in; a bounded number is held."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, fingerprints: np.ndarray) -> None:
        keys, counts = np.unique(fingerprints, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        self.keys, self.counts = [], []
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        del order
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        self.keys, self.counts, self.size = [keys], [counts], len(keys)
        return keys, counts

    def emit(self) -> Iterator[pa.RecordBatch]:
        keys, counts = self.summed()
        self.__init__()
        for start in range(0, len(keys), 1 << 16):
            part = slice(start, start + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), pa.array(counts[part])], ["fingerprint", "occurrences"])


def _maybe(fingerprints: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether both bits of a fingerprint, named by its highest and its lowest digits, are set."""
    wide = len(bits).bit_length() + 2
    found = np.ones(len(fingerprints), bool)
    for at in (fingerprints >> np.uint64(64 - wide), fingerprints & np.uint64((1 << wide) - 1)):
        found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0
    return found


def _may_be_frequent(buffer: Buffer, bits: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By length, the n-grams that the bitmap holds and whose own shorter ones it holds, with their fingerprints."""
    shorter = None
    for n in range(1, longest + 1):
        at = buffer.grams(n)
        if shorter is not None:
            at = at[shorter[at] & shorter[at + 1]]
        fingerprint = buffer.fingerprints(at, n)
        held = _maybe(fingerprint, bits)
        at, fingerprint = at[held], fingerprint[held]
        yield n, at, fingerprint
        shorter = np.zeros(len(buffer.start), bool)
        shorter[at] = True


def _counting(lengths: tuple[int, ...], pairs) -> Callable:
    """Sums of fingerprints by part of the corpus; with ``pairs``, only of n-grams whose pairs may be frequent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = pairs.value if pairs else None
        sums = _Sums()
        for batch in batches:
            for buffer in _buffers(batch):
                two = np.ones(len(buffer.start), bool)
                if bits is not None:
                    two[:] = False
                    for n, at, _ in _may_be_frequent(buffer, bits, 2):
                        if n == 2:
                            two[at] = True
                for n in lengths:
                    at = buffer.fresh(buffer.grams(n), n)
                    for k in range(n - 1):
                        at = at[two[at + k]]
                    sums.add(buffer.fingerprints(at, n))
                if sums.size > HELD:
                    sums.summed()
                    if sums.size > HELD // 2:
                        yield from sums.emit()
        yield from sums.emit()

    return run


class _Phrases:
    """Counts by language and phrase with the doc_id of one occurrence; a bounded number is held."""

    def __init__(self) -> None:
        self.held: dict[str, dict[bytes, list]] = {}
        self.size = 0

    def add(self, lang: str, phrase: bytes, count: int, doc_id: int | None) -> None:
        own = self.held.setdefault(lang, {})
        entry = own.get(phrase)
        if entry is None:
            own[phrase] = [count, doc_id]
            self.size += 1
        else:
            entry[0] += count

    def emit(self) -> Iterator[pa.RecordBatch]:
        for lang, own in self.held.items():
            phrases = list(own)
            for start in range(0, len(phrases), 1 << 14):
                part = phrases[start:start + (1 << 14)]
                counts, ids = zip(*map(own.get, part), strict=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([p.count(b" ") + 1 if p else 0 for p in part], pa.int32()),
                    pa.array(part, pa.binary()), pa.array(counts, pa.int64()), pa.array(ids, pa.int64())],
                    ["lang", "n", "phrase", "occurrences", "doc_id"])
        self.__init__()


def _reading(bitmap) -> Callable:
    """(lang, n, phrase, occurrences, doc_id) of what may be frequent, and under the empty phrase, n = 0, the words by language."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        found = _Phrases()
        for batch in batches:
            langs, ids = batch.column("lang").to_pylist(), batch.column("doc_id").to_pylist()
            totals = np.zeros(len(langs), np.int64)
            for buffer in _buffers(batch):
                totals += np.bincount(buffer.row[buffer.old:], minlength=len(langs))
                number = buffer.word_numbers()
                for n, at, fingerprint in _may_be_frequent(buffer, bits, LONGEST):
                    new = at + n - 1 >= buffer.old
                    at, fingerprint = at[new], fingerprint[new]
                    first, counts = _alike(at, fingerprint, [number[at + k] for k in range(n)], buffer.seed[at])
                    for phrase, row, count in zip(buffer.phrases(first, n), buffer.row[first].tolist(), counts.tolist(), strict=True):
                        found.add(langs[row], phrase, count, ids[row])
                if found.size > HELD_PHRASES:
                    yield from found.emit()
            for lang, words in zip(langs, totals.tolist(), strict=True):
                found.add(lang, b"", words, None)
        yield from found.emit()

    return run


def _alike(at: np.ndarray, fingerprint: np.ndarray, words: list[np.ndarray], seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and count of every different n-gram, by fingerprint, where the words agree; else by the words themselves."""
    _, first, number, counts = np.unique(fingerprint, return_index=True, return_inverse=True, return_counts=True)
    like = first[number]
    if not all(np.array_equal(word, word[like]) for word in (*words, seed)):
        keys = np.stack([seed, *(word.astype(np.uint64) for word in words)], axis=1)
        _, first, counts = np.unique(keys, axis=0, return_index=True, return_counts=True)
    return at[first], counts


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """Two bits per fingerprint, see ``_maybe``."""
    keys = frequent.count()
    wide = min(max(32 * keys, 1 << 16).bit_length(), MAX_FILTER_BITS.bit_length() - 1)
    places = F.array(F.shiftrightunsigned("fingerprint", 64 - wide), F.col("fingerprint").bitwiseAND(F.lit((1 << wide) - 1)))
    bit = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    slots = frequent.select(F.explode(places).alias("at")).groupBy(F.shiftright("at", 6).alias("slot")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros((1 << wide) // 64, np.int64)
    bits[slots["slot"].to_numpy()] = slots["bits"].to_numpy()
    return bits.view(np.uint8)


def phrases(docs: DataFrame, least: int = 30) -> DataFrame:
    """lang, n, phrase, occurrences and seen (doc_id of an occurrence) of all phrases of 1 to 4 words found at least ``least`` times
    in a language; n = 0 holds a language's words."""
    spark = docs.sparkSession
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("und")).alias("lang"), F.encode(whole_text(), "UTF-8").alias("text"))

    def frequent(lengths: tuple[int, ...], pairs=None) -> DataFrame:
        counted = read.select("lang", "text").mapInArrow(_counting(lengths, pairs), "fingerprint long, occurrences long")
        # a task has summed its own already: another table of them in the JVM ahead of the shuffle would hold as many rows again
        summed = counted.repartition("fingerprint").groupBy("fingerprint").agg(F.sum("occurrences").alias("occurrences"))
        return written(summed.where(F.col("occurrences") >= least), "phrase-fingerprints")

    short = frequent((1, 2))
    long = frequent((3, 4), spark.sparkContext.broadcast(_bitmap(short)))
    bits = spark.sparkContext.broadcast(_bitmap(short.unionByName(long)))
    found = read.mapInArrow(_reading(bits), "lang string, n int, phrase binary, occurrences long, doc_id long")
    exact = found.groupBy("lang", "n", F.col("phrase").cast("string").alias("phrase")).agg(
        F.sum("occurrences").alias("occurrences"), F.min("doc_id").alias("seen"))
    return written(exact.where((F.col("occurrences") >= least) | (F.col("n") == 0)), "phrases")


def _part(start: Column | int, size: Column | int) -> Column:
    words = F.split("phrase", " ", -1)
    return F.array_join(F.slice(words, start, size), " ")


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = 30, most: int = 2_000, covered_percent: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score and seen of each language's first ``most`` phrases of 2 to 4 words.

    a, l and r are the occurrences of the phrase and of the two parts of its lowest-scoring cut, n the language's words. A phrase
    that a longer one covers (``covered_percent`` of its occurrences or more) is left out.
    """
    held = phrases(docs, least)
    counts = held.where("n > 0").select("lang", "phrase", F.col("occurrences").alias("f"))
    candidates = held.where("n > 1").select("lang", "phrase", F.col("n").alias("size"), F.col("occurrences").alias("a"), "seen")

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*", _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("size")).alias("rest"))
    left, right = (counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)) for part, name in (("first", "l"), ("rest", "r")))
    share = F.expr("CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", share)
    lowest = scored.groupBy("lang", "phrase", "a", "seen").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inside = candidates.where("size > 2").select("lang", F.col("a").alias("f"), F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda wide: F.transform(F.sequence(F.lit(1), F.col("size") - wide + 1), lambda start: _part(start, wide))))).alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    free = lowest.join(longer, ["lang", "phrase"], "left").where(
        F.col("f").isNull() | (F.lit(100) * _exact("f") < F.lit(covered_percent) * _exact("a")))

    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    sliced = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_RANK_SLICES))).orderBy(*order)
    first = free.withColumn("rank", F.row_number().over(sliced)).where(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    totals = held.where("n = 0").select("lang", F.col("occurrences").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "seen")
