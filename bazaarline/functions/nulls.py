"""Whole-row null filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType, StringType


def fill_all_zero(df: DataFrame) -> DataFrame:
    """0 for every missing number, ``'0'`` for text, false for flags; dates stay NULL."""
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            col = F.when(~F.isnan(col), col)
        if isinstance(field.dataType, NumericType):
            col = F.coalesce(col, F.lit(0).cast(field.dataType))
        elif isinstance(field.dataType, StringType):
            col = F.coalesce(col, F.lit("0"))
        elif isinstance(field.dataType, BooleanType):
            col = F.coalesce(col, F.lit(False))
        out.append(col.alias(field.name))
    return df.select(*out)


def fill_all(df: DataFrame, value: str = "Unknown", cast_all: bool = True) -> DataFrame:
    """``value`` for every missing cell. Other types become text first, or stay as they are."""
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            col = F.coalesce(col, F.lit(value))
        elif cast_all:
            col = F.coalesce(col.cast("string"), F.lit(value))
        out.append(col.alias(field.name))
    return df.select(*out)
