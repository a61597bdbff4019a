"""Review id rules: near-duplicate suffix and Base64URL form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEAR_DUP_SUFFIX = r"(?i)(_copy|_dup)$"


def is_near_dup(col: Column) -> Column:
    """Id ends in ``_copy`` or ``_dup``; a null id does not."""
    return F.coalesce(col.rlike(NEAR_DUP_SUFFIX), F.lit(False))


def base_id(col: Column) -> Column:
    """Id without its suffix, taken off once only."""
    return F.regexp_replace(col, NEAR_DUP_SUFFIX, "")


def is_base64url(col: Column, mode: str = "lenient", allow_empty: bool = True) -> Column:
    """Whether an id decodes as Base64URL after right padding.

    ``lenient`` follows decoders that skip foreign ASCII characters and stop at a complete
    padding group; ``strict`` allows the URL-safe alphabet and closing padding only.
    """
    empty_ok = F.lit(allow_empty)
    if mode == "strict":
        shape = col.rlike(r"^[A-Za-z0-9_-]*={0,2}\z")
        bare = F.length(F.regexp_replace(col, "=", ""))
        length_ok = (bare % 4 != 1) & ((F.length(col) == bare) | (F.length(col) % 4 == 0))
        valid = shape & length_ok
    elif mode == "lenient":
        pads = F.pmod(-F.length(col), F.lit(4))
        clean = col.rlike(r"^[A-Za-z0-9+/_-]*\z")
        digits = F.when(clean, F.length(col)).otherwise(F.length(F.regexp_replace(col, "[^A-Za-z0-9+/_-]", "")))
        plain = (
            (digits % 4 == 0)
            | ((digits % 4 == 2) & (pads >= 2))
            | ((digits % 4 == 3) & (pads >= 1))
        )
        # With '=' inside, position matters: reduce to x and =, drop leading whole quads,
        # then accept a quad boundary at the end or a complete padding group anywhere.
        reduced = F.regexp_replace(F.regexp_replace(col, "[^A-Za-z0-9+/_=-]", ""), "[A-Za-z0-9+/_-]", "x")
        padded = F.regexp_replace(F.concat(reduced, F.repeat(F.lit("="), pads)), "^(?:xxxx)+", "")
        embedded = padded.rlike(r"^(?:=*x=*x=?xx)*(?:=*\z|=*x=*x(?:==|=?x=))")
        ascii_only = F.octet_length(col) == F.length(col)
        valid = ascii_only & F.when(F.contains(col, F.lit("=")), embedded).otherwise(plain)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.coalesce(F.when(col == "", empty_ok).otherwise(valid), F.lit(False))
