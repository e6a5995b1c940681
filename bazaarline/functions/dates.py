"""Date parsing and calendar expressions over zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

# Date texts accepted besides ISO, month first.
DATE_FORMATS = ["MMM d yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d-MMM-yyyy"]


# A month name and a year; anything else would only fail format by format.
_NAMED = r"^([A-Za-z]{3,9} \d{1,2},? \d{4}|\d{1,2}[ -][A-Za-z]{3,9}[ -]\d{4})$"


def _as_ntz(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def parse_ts(col: Column, strict: bool = False, dtype: DataType | None = None) -> Column:
    """``col`` as ``timestamp_ntz``. Bad text is NULL, or an error with ``strict``.

    Accepted: ISO dates and times, ``yyyy/MM/dd``, ``MM/dd/yyyy`` with an optional time,
    ``yyyyMMdd`` and the month-name forms above.
    """
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return col.cast("timestamp_ntz")
    text = F.btrim(col.cast("string"))
    numeric = F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")
    numeric = F.regexp_replace(numeric, r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    numeric = F.regexp_replace(numeric, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    named = [F.try_to_date(text, f).cast("timestamp_ntz") for f in DATE_FORMATS]
    parsed = F.when(text.rlike(r"^\d{4}"), F.coalesce(_as_ntz(text), _as_ntz(numeric))).when(
        text.rlike(r"^\d{1,2}/"), _as_ntz(numeric)).when(text.rlike(_NAMED), F.coalesce(*named))
    if not strict:
        return parsed
    bad = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("timestamp_ntz")
    return F.coalesce(parsed, F.when(text.isNotNull(), bad))


def date_id(ts: Column) -> Column:
    """Calendar key ``yyyyMMdd`` as an integer."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def iso_weekday(day: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(day) + 1


def whole_days(start: Column, end: Column) -> Column:
    """Completed 24-hour periods between two timestamps (not midnights crossed)."""
    return F.extract(F.lit("DAY"), end - start)


def to_second(ts: Column) -> Column:
    """``ts`` without its sub-second part."""
    seconds = F.extract(F.lit("SECOND"), ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds - F.floor(seconds))
