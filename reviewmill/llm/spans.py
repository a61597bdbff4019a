"""Places of pattern matches in a text, with built-in functions only.

``regexp_extract_all`` gives the matches and ``split`` by the same pattern the gaps between them; running totals of
their lengths are the places, in code points. Totals are kept per block of matches, so many matches in a long text do not
cost their square. Patterns must not match the empty string; texts are whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.llm.common import let

_BLOCK = 128
SPAN = "array<struct<start:int,end:int,value:string>>"


def _sum(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda total, x: total + x)


def find(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, value), end exclusive; empty where there is none."""

    def place(hits: Column, gaps: Column) -> Column:
        steps = F.transform(hits, lambda hit, i: F.length(gaps[i]) + F.length(hit))

        def with_steps(step: Column) -> Column:
            blocks = F.transform(
                F.sequence(F.lit(0), F.floor((F.size(step) - 1) / _BLOCK).cast("int")),
                lambda b: _sum(F.slice(step, b * _BLOCK + 1, F.lit(_BLOCK))),
            )
            starts = let(blocks, lambda block: F.transform(block, lambda x, b: _sum(F.slice(block, F.lit(1), b))))

            def spans(start: Column) -> Column:
                def span(hit: Column, i: Column) -> Column:
                    b = F.floor(i / _BLOCK).cast("int")
                    at = start[b] + _sum(F.slice(step, b * _BLOCK + 1, i % _BLOCK)) + F.length(gaps[i])
                    return F.struct(at.alias("start"), (at + F.length(hit)).alias("end"), hit.alias("value"))

                return F.transform(hits, span)

            return let(starts, spans)

        return let(steps, with_steps)

    found = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda hits: let(F.split(text, pattern, -1), lambda gaps: place(hits, gaps)),
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def named(spans: Column, kind: str, rank: int) -> Column:
    """The spans as (rank, kind, start, end)."""
    return F.transform(spans, lambda s: F.struct(
        F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


_CHARS = 512  # characters of a block of text that is walked to find a place in it


def _running_max(ends: Column, body) -> Column:
    """``body(at)`` where ``at(i)`` is the greatest of the first ``i`` ends, 0 at the start."""
    last = F.floor((F.size(ends) - 1) / _BLOCK).cast("int")
    tops = F.transform(F.sequence(F.lit(0), last), lambda b: F.array_max(F.slice(ends, b * _BLOCK + 1, F.lit(_BLOCK))))

    def with_tops(top: Column) -> Column:
        before = F.transform(top, lambda _, b: F.coalesce(F.array_max(F.slice(top, F.lit(1), b)), F.lit(0)))

        def with_before(start: Column) -> Column:
            def at(i: Column) -> Column:
                b = F.floor(i / _BLOCK).cast("int")
                return F.greatest(start[b], F.coalesce(F.array_max(F.slice(ends, b * _BLOCK + 1, i % _BLOCK)), F.lit(0)))

            return body(at)

        return let(before, with_before)

    return let(tops, with_tops)


def _rewritten(text: Column, ordered: Column, piece) -> Column:
    """The text with each span, ordered by start, replaced by ``piece(text between, span, at)``; ``at`` is where the spans before end.

    Texts are cut into blocks once, so a place is found without a walk from the start of the text, and the pieces are joined
    once: the time follows the text and the spans.
    """

    def with_blocks(blocks: Column) -> Column:
        def part(start: Column, end: Column) -> Column:
            i, j = F.floor(start / _CHARS).cast("int"), F.floor(end / _CHARS).cast("int")
            rest = F.concat(
                F.substring(F.get(blocks, i), start % _CHARS + 1, F.lit(_CHARS)),
                F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""),
                F.coalesce(F.substring(F.get(blocks, j), F.lit(1), end % _CHARS), F.lit("")))
            return F.when(start >= end, "").when(i == j, F.substring(F.get(blocks, i), start % _CHARS + 1, end - start)).otherwise(rest)

        def with_ends(ends: Column) -> Column:
            def body(at) -> Column:
                pieces = F.transform(ordered, lambda s, i: let(at(i), lambda before: piece(part, s, before)))
                tail = let(F.array_max(ends), lambda end: part(end, F.length(text)))
                return F.concat(F.array_join(pieces, ""), tail)

            return _running_max(ends, body)

        return let(F.transform(ordered, lambda s: s["end"]), with_ends)

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHARS}}}"), F.lit(0))
    return F.when(F.size(ordered) > 0, let(cut, with_blocks)).otherwise(text)


def blanked(text: Column, ordered: Column) -> Column:
    """The text with a space for each character of the spans, ordered by start: all other places stay as they are."""

    def piece(part, s: Column, at: Column) -> Column:
        start = F.greatest(s["start"], at)
        return F.concat(part(at, start), F.repeat(F.lit(" "), F.greatest(s["end"] - start, F.lit(0))))

    return _rewritten(text, ordered, piece)


def replaced(text: Column, ordered: Column) -> Column:
    """The text with each span, ordered by start, replaced by its kind in brackets; overlapping spans by the first one's."""

    def piece(part, s: Column, at: Column) -> Column:
        return F.when(s["start"] >= at, F.concat(part(at, s["start"]), F.lit("["), s["kind"], F.lit("]"))).otherwise("")

    return _rewritten(text, ordered, piece)
