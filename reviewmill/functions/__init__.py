"""Column expressions; nothing here triggers a job."""

from reviewmill.functions.dates import is_iso_date, with_date
from reviewmill.functions.ids import base_id, is_base64url, is_near_dup
from reviewmill.functions.numbers import derived_total, needs_total, round_money, round_tenth, to_number
from reviewmill.functions.ratings import rating_outcome, symbols, with_rating
from reviewmill.functions.text import (
    chunk_array, contains_any, has_text, is_blank, matched_keywords, na_to_null, one_line, split_list, strip,
)
from reviewmill.functions.vectors import inner_product, positive_score

__all__ = [
    "base_id", "chunk_array", "contains_any", "derived_total", "has_text", "inner_product",
    "is_base64url", "is_blank", "is_iso_date", "is_near_dup", "matched_keywords", "na_to_null", "needs_total",
    "one_line", "positive_score", "rating_outcome", "round_money", "round_tenth",
    "split_list", "strip", "symbols", "to_number", "with_date", "with_rating",
]
