"""Number coercion and scoring expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType, NumericType, StringType

# Fixed value: the numeric texts that count as numbers (no hex, no suffixes, no "NaN").
NUMBER_TEXT = (
    r"^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf(inity)?))\s*$"
)

_DIGITS = r"^\s*[+-]?[0-9]{1,19}\s*$"


def to_whole(text: Column) -> Column:
    """Integer text as ``bigint``, else NULL. The pattern keeps other text away from the cast,
    which would raise and catch an exception for every such cell."""
    return F.when(text.rlike(_DIGITS), F.btrim(text).try_cast("bigint"))


def to_number(col: Column, dtype: DataType | None = None) -> Column:
    """``col`` as a number, NULL where it is none. Numeric columns keep their type."""
    if isinstance(dtype, (FloatType, DoubleType)):
        return F.when(~F.isnan(col), col)
    if isinstance(dtype, NumericType):
        return col
    if isinstance(dtype, BooleanType):
        return col.cast("double")
    text = col if isinstance(dtype, StringType) else col.cast("string")
    return F.when(text.rlike(NUMBER_TEXT), F.btrim(text).try_cast("double"))


def coerce_num(col: Column, to_int: bool = False, dtype: DataType | None = None) -> Column:
    """Number or 0; with ``to_int`` truncated toward zero.

    Integer texts are read as integers first, so long ids keep every digit.
    """
    number = to_number(col, dtype)
    if not to_int:
        zero = F.lit(0.0) if dtype is None or not isinstance(dtype, NumericType) else F.lit(0)
        return F.coalesce(number, zero)
    whole = number.cast("bigint")
    if dtype is None or isinstance(dtype, StringType):
        whole = F.coalesce(to_whole(col.cast("string")), whole)
    return F.coalesce(whole, F.lit(0).cast("bigint"))


def as_id(col: Column, dtype: DataType | None = None) -> Column:
    """A key read as text, as a whole number; text that is no number stops the job."""
    if dtype is not None and not isinstance(dtype, StringType):
        return col
    text = F.btrim(col.cast("string"))
    whole = F.coalesce(to_whole(text), to_number(col).try_cast("bigint"))
    bad = F.raise_error(F.concat(F.lit("not a key: "), text)).cast("bigint")
    return F.coalesce(whole, F.when(text.isNotNull(), bad))


def differs(old: Column, new: Column, tolerance: float | None = None, null_safe: bool = False) -> Column:
    """Whether two values differ. By default a NULL on either side is "no difference known"."""
    unequal = old != new
    if tolerance is not None:
        unequal = F.abs(old - new) > F.lit(Decimal(str(tolerance)))
    if null_safe:
        return F.coalesce(unequal, old.isNull() != new.isNull())
    return F.coalesce(unequal, F.lit(False))


def pct_of(part: Column, whole: Column) -> Column:
    """``part`` / ``whole`` as a fraction, 0 for an empty whole."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def percent_score(bad: Column, total: Column) -> Column:
    """Whole-percent score ``(1 - bad/total) * 100`` cut toward zero, 100 for an empty total."""
    ratio = (F.lit(1.0) - bad.cast("double") / total.cast("double")) * F.lit(100)
    return F.when(total > 0, ratio.cast("int")).otherwise(F.lit(100))


def with_two_places(df: DataFrame, value: str, out: str) -> DataFrame:
    """Adds a value from 0 up as text with two places, rounded by its exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal form half up, which differs for values such as
    3.315; here whole part and fraction are split into integers (52 binary places), one step per
    projection so that no step is computed twice.
    """
    mask = F.lit(2 ** 52 - 1)
    steps = df.withColumn("__s", F.col(value) * F.lit(float(2 ** 52)))
    steps = steps.withColumn("__b", F.col("__s").cast("bigint"))
    steps = steps.withColumn("__p", F.col("__b").bitwiseAND(mask) * 100)
    steps = steps.withColumns({
        "__c": F.shiftright("__b", 52) * 100 + F.shiftright("__p", 52),
        "__o": (F.col("__p").bitwiseAND(mask) - F.lit(2 ** 51)).cast("double")
        + (F.col("__s") - F.col("__b").cast("double")) * 100})
    up = (F.col("__o") > 0) | ((F.col("__o") == 0) & (F.col("__c") % 2 == 1))
    steps = steps.withColumn("__c", F.col("__c") + F.when(up, 1).otherwise(0))
    text = F.concat(F.expr("cast(__c div 100 as string)"), F.lit("."),
                    F.lpad((F.col("__c") % 100).cast("string"), 2, "0"))
    return steps.withColumn(out, text).drop("__s", "__b", "__p", "__c", "__o")
