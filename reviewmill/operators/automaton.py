"""Aho-Corasick over flat arrays: all entries of a dictionary found in one pass over the bytes of many texts.

The automaton is a dense table (state, class of byte) to state; bytes that no entry holds share a class. Texts of a batch stand end to
end, cut into strips that begin a longest entry's length early, and all strips step together, so a pass costs the bytes of
the texts, however many entries there are and however many match. UTF-8 needs no care: no character's bytes occur inside another's.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

SLICE_BYTES = 4 << 20  # text bytes stepped over at a time
_ASCII_WORD = np.array([chr(b).isalnum() or b == 95 for b in range(128)] + [False] * 128)


@lru_cache(1 << 16)
def _in_word(char: str) -> bool:
    return char == "_" or unicodedata.category(char)[0] in "LN"


class Automaton:
    """Entries as bytes, none empty, all different."""

    def __init__(self, entries: list[bytes]):
        held = np.zeros(256, bool)
        for entry in entries:
            held[np.frombuffer(entry, np.uint8)] = True
        self.classes = np.where(held, np.cumsum(held), 0).astype(np.int32)
        width = int(held.sum()) + 1
        children: list[dict[int, int]] = [{}]
        depth, ends = [0], {}
        for number, entry in enumerate(entries):
            state = 0
            for at, byte in enumerate(entry, 1):
                following = children[state].get(byte)
                if following is None:
                    following = children[state][byte] = len(children)
                    children.append({})
                    depth.append(at)
                state = following
            ends[state] = number
        n = len(children)
        self.entry = np.full(n, -1, np.int32)
        self.entry[list(ends)] = list(ends.values())
        parent = np.array([s for s, own in enumerate(children) for _ in own], np.int32)
        symbol = self.classes[np.array([b for own in children for b in own], np.int64)]
        child = np.array([c for own in children for c in own.values()], np.int32)
        levels = np.array(depth)[child]

        self.step = np.zeros((n, width), np.int32)
        fail = np.zeros(n, np.int32)
        self.shorter = np.zeros(n, np.int32)  # nearest shorter suffix that is an entry, 0 if none
        for level in range(1, int(levels.max(initial=0)) + 1):
            now = levels == level
            up, sign, down = parent[now], symbol[now], child[now]
            if level > 1:
                fail[down] = self.step[fail[up], sign]  # the row of a shorter state is complete
            self.step[up, sign] = down
            behind = fail[down]
            self.shorter[down] = np.where(self.entry[behind] >= 0, behind, self.shorter[behind])
            self.step[down] = self.step[behind]
        # a row was copied from its fallback before its own children stood in it, level by level, so it is complete now
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.reach = int(self.lengths.max(initial=1))

    def find(self, texts: list[bytes], word: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of texts and entries that occur in them, each pair once; on request only between word edges."""
        pairs = []
        for pieces in _slices(texts, self.reach + 8):
            owner, cut_before, cut_behind = (np.array(x) for x in zip(*((p[0], p[2], p[3]) for p in pieces), strict=True))
            piece, entry, to_start, to_end = self._find([p[1] for p in pieces], word)
            # what touches a cut is found whole, with what stands around it, in the neighbouring piece
            whole = ~(cut_before[piece] & (to_start < 4)) & ~(cut_behind[piece] & (to_end < 4))
            pairs.append(np.unique(owner[piece[whole]] * len(self.lengths) + entry[whole]))
        every = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        return np.divmod(every, max(1, len(self.lengths)))

    def _find(self, texts: list[bytes], word: bool) -> tuple[np.ndarray, ...]:
        """Text and entry of every occurrence, and its distances to the text's start and end."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        gaps = np.repeat(np.arange(len(texts)), sizes)
        total = len(data) + len(texts)
        early = self.reach - 1
        strip = max(4 * early, math.isqrt(total), 16)
        strips = -(-total // strip)
        line = np.zeros(early + strips * strip, np.int32)  # class 0 leads to the root: it stands before, between and behind texts
        line[early + np.arange(len(data)) + gaps] = self.classes[data]
        columns = np.lib.stride_tricks.as_strided(line, (strips, strip + early), (strip * 4, 4)).T.copy()
        flat, width = self.step.ravel(), self.step.shape[1]
        state = np.zeros(strips, np.int32)
        states = np.empty((strip, strips), np.int32)
        for at, column in enumerate(columns):
            state = flat[state * width + column]
            if at >= early:
                states[at - early] = state
        ending = (self.entry >= 0) | (self.shorter > 0)
        row, number = np.nonzero(ending[states])
        state = states[row, number]
        end = number.astype(np.int64) * strip + row  # place of the last byte, gaps counted
        text = np.searchsorted(offsets[1:] + np.arange(1, len(texts) + 1), end, side="right")
        end -= text
        found = []
        while len(state):
            is_entry = self.entry[state] >= 0
            found.append((text[is_entry], self.entry[state[is_entry]].astype(np.int64), end[is_entry]))
            state = self.shorter[state]
            more = state > 0
            state, text, end = state[more], text[more], end[more]
        text, entry, end = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        start = end - self.lengths[entry] + 1
        if word and len(text):
            free = self._free(data, offsets, text, start, end + 1)
            text, entry, start, end = text[free], entry[free], start[free], end[free]
        return text, entry, start - offsets[text], offsets[text + 1] - end - 1

    @staticmethod
    def _free(data: np.ndarray, offsets: np.ndarray, text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Whether neither the character before ``start`` nor the one at ``stop`` is a letter, a digit or ``_``."""
        low, high = offsets[text], offsets[text + 1]
        before, after = data[np.maximum(start - 1, 0)], data[np.minimum(stop, len(data) - 1)]
        inner_start, inner_stop = start > low, stop < high
        free = ~(inner_start & _ASCII_WORD[before]) & ~(inner_stop & _ASCII_WORD[after])
        for at in np.flatnonzero(free & inner_start & (before >= 128)).tolist():
            char = data[max(int(low[at]), int(start[at]) - 4):int(start[at])].tobytes().decode("utf-8", "ignore")[-1:]
            free[at] = not (char and _in_word(char))
        for at in np.flatnonzero(free & inner_stop & (after >= 128)).tolist():
            char = data[int(stop[at]):min(int(high[at]), int(stop[at]) + 4)].tobytes().decode("utf-8", "ignore")[:1]
            free[at] = not (char and _in_word(char))
        return free


def _slices(texts: list[bytes], overlap: int, width: int | None = None) -> Iterator[list[tuple[int, bytes, bool, bool]]]:
    """Runs of about ``SLICE_BYTES`` as (number of the text, piece, cut before, cut behind); long texts in overlapping pieces."""
    width = width or SLICE_BYTES
    held, size = [], 0
    for number, text in enumerate(texts):
        for start in range(0, max(1, len(text)), width):
            low, high = max(0, start - overlap), min(len(text), start + width + overlap)
            held.append((number, text[low:high], low > 0, high < len(text)))
            size += high - low
            if size >= width:
                yield held
                held, size = [], 0
    if held:
        yield held
