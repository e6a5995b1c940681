"""Column helpers: text, numbers, dates and null handling."""

from .dates import date_id, iso_weekday, parse_ts, to_second, whole_days
from .nulls import fill_all, fill_all_zero
from .numbers import as_id, coerce_num, differs, pct_of, percent_score, to_number
from .text import (composite_key, fill_const, fill_title, fill_upper, null_tokens, slug, strip_text,
                   title_trim)

__all__ = [
    "date_id", "iso_weekday", "parse_ts", "to_second", "whole_days", "fill_all", "fill_all_zero",
    "as_id", "to_number", "coerce_num", "differs", "pct_of", "percent_score", "composite_key", "fill_const", "fill_title",
    "fill_upper", "null_tokens", "slug", "strip_text", "title_trim",
]
