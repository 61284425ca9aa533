"""Column expressions."""

from .dates import (century_fixed, date_parts, iso_text, parse_day, parse_mixed_date,
                    parse_timestamp_text)
from .numbers import (null_as_zero_sum, recovered_sessions, round_to_long,
                      safe_ratio, signed_percent)
from .text import blank_to_null, clip, extract_or_null, plain_text, squash, translated
from .cells import coerce_cell, coerce_typed
from .links import extract_links, pick_link

__all__ = [
    "blank_to_null", "century_fixed", "clip", "coerce_cell", "coerce_typed", "date_parts",
    "extract_links", "extract_or_null", "iso_text", "null_as_zero_sum",
    "parse_day", "parse_mixed_date", "parse_timestamp_text", "pick_link", "plain_text",
    "recovered_sessions", "round_to_long", "safe_ratio", "signed_percent", "squash",
    "translated",
]
