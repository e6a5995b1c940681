"""Text clean-up expressions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts a CSV reader of the pandas family takes for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Every code point Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_RUNS = f"[{_CASED}]+|[^{_CASED}]+"


def null_tokens(col: Column) -> Column:
    """NULL for every token that stands for a missing value in a CSV cell."""
    return F.when(~col.isin(NULL_TOKENS), col)


def strip_text(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def title_trim(col: Column) -> Column:
    """Trimmed text with every run of cased letters capitalised (``O'Neil``, ``3Rd``).

    Plain ASCII words go through ``initcap`` (whole-stage code); only text with digits,
    punctuation or other scripts pays for the run-by-run rewrite.
    """
    text = strip_text(col)
    runs = F.regexp_extract_all(F.lower(text), F.lit(_RUNS), F.lit(0))
    rewritten = F.array_join(F.transform(runs, F.initcap), "")
    return F.when(text.rlike("^[A-Za-z ]*$"), F.initcap(text)).otherwise(rewritten)


def fill_const(col: Column, value: str) -> Column:
    return F.coalesce(col, F.lit(value))


def fill_upper(col: Column, value: str = "Unknown") -> Column:
    return F.upper(fill_const(col, value))


def fill_title(col: Column, value: str = "Unknown") -> Column:
    return title_trim(fill_const(col, value))


def composite_key(*cols: Column, missing: str = "nan") -> Column:
    """Key parts joined by ``_`` with a visible text for missing parts."""
    return F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit(missing)) for c in cols])


def slug(filename: Column) -> Column:
    """``custom_<name>`` table name of an unclassified file: lower case, blanks and dashes to ``_``."""
    stem = F.regexp_replace(filename, r"(?<=[^.])\.[^.]*$", "")
    return F.concat(F.lit("custom_"), F.translate(F.lower(stem), " -", "__"))
