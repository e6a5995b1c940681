"""Dataset profile: size, null and duplicate rates, and the kind of every column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from ..functions.dates import parse_ts
from ..functions.numbers import to_number, to_whole
from ..session import materialise
from .quality import _missing
from .skew import fits_broadcast, stored


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Whole-row duplicates (rows beyond the first of their kind) as one row.

    A 64-bit hash of every row is counted first, so 8 bytes per row are shuffled. If the list
    of repeated hashes turns out small enough to broadcast, only rows with such a hash are
    compared in full; otherwise all rows are. Both ways the count is exact.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    repeated = materialise(df.select(F.xxhash64(*cols).alias("__h")).groupBy("__h").agg(
        F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__h"), "repeated_rows")
    suspects = df
    if fits_broadcast(repeated):
        hashed = df.select(*cols, F.xxhash64(*cols).alias("__h"))
        suspects = hashed.join(F.broadcast(repeated), "__h", "left_semi")
    return suspects.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def dates_among(df: DataFrame, columns: Sequence[str]) -> Column:
    """Aggregate: those of the columns that have values, all of which read as dates."""
    kinds = []
    for name in columns:
        value = F.col(f"`{name}`").cast("string")
        all_dates = (F.count(value) > 0) & (F.count(value) == F.count(parse_ts(value)))
        kinds.append(F.when(all_dates, F.lit(name)))
    return F.array_compact(F.array(*kinds)) if kinds else F.array().cast("array<string>")


def profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, null and duplicate rate in percent, fields by kind, schema as JSON.

    Flags count as numeric; a column is a date field if all its values read as dates. One
    aggregation gives everything but the duplicates. Rates are rounded half-even to two places.
    """
    data = [f for f in df.schema if not f.name.startswith("_")]
    body = stored(df.select(*[F.col(f"`{f.name}`") for f in data]), "profiled")  # read three times
    numeric = [f.name for f in data if isinstance(f.dataType, (NumericType, BooleanType))]
    other = [f.name for f in data if f.name not in numeric]
    nulls = sum((F.count_if(_missing(df, f.name)) for f in data), F.lit(0).cast("bigint"))
    stats = body.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"), dates_among(body, other).alias("__dates"))
    dups = duplicate_row_count(body).scalar()
    names = F.array(*[F.lit(c) for c in other]).cast("array<string>")
    cells = F.col("rows") * len(data)
    schema_map = F.create_map(*[x for f in data for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    return stats.withColumn("__dups", dups).select(
        F.col("rows"), F.lit(len(data)).alias("columns"),
        F.when(cells > 0, F.bround(F.col("nulls") / cells * 100, 2)).otherwise(F.lit(0.0)).alias("null_rate"),
        F.when(F.col("rows") > 0, F.bround(F.col("__dups") / F.col("rows") * 100, 2)).otherwise(F.lit(0.0))
        .alias("dup_rate"),
        F.array(*[F.lit(c) for c in numeric]).cast("array<string>").alias("numeric_fields"),
        F.filter(names, lambda c: F.array_contains(F.col("__dates"), c)).alias("date_fields"),
        F.filter(names, lambda c: ~F.array_contains(F.col("__dates"), c)).alias("categorical_fields"),
        F.to_json(schema_map).alias("schema_definition"))


def profile_counts(df: DataFrame) -> DataFrame:
    """The profile with the number of fields per kind instead of their names."""
    return profile(df).select(
        "rows", "columns", "null_rate", "dup_rate", F.size("numeric_fields").alias("numeric_count"),
        F.size("date_fields").alias("date_count"), F.size("categorical_fields").alias("categorical_count"),
        "schema_definition")


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns cast to the narrowest type all their values fit: bigint, double, boolean or text.

    One aggregation over all columns decides; a column without values counts as double.
    """
    text = [f.name for f in df.schema if f.dataType.typeName() == "string" and not f.name.startswith("_")]
    if not text:
        return df
    checks = []
    for name in text:
        value = F.btrim(F.col(f"`{name}`"))
        present = value.isNotNull()
        checks += [
            F.count_if(present & to_whole(value).isNull()).alias(f"bigint:{name}"),
            F.count_if(present & to_number(value).isNull()).alias(f"double:{name}"),
            F.count_if(present & ~value.isin("True", "False", "TRUE", "FALSE", "true", "false")).alias(f"boolean:{name}"),
            F.count_if(~present).alias(f"null:{name}"), F.count_if(present).alias(f"some:{name}"),
        ]
    seen = df.agg(*checks).first()
    types = {}
    for name in text:
        if seen[f"some:{name}"] == 0:
            types[name] = "double"
        elif seen[f"bigint:{name}"] == 0:
            types[name] = "double" if seen[f"null:{name}"] else "bigint"
        elif seen[f"double:{name}"] == 0:
            types[name] = "double"
        elif seen[f"boolean:{name}"] == 0 and not seen[f"null:{name}"]:
            types[name] = "boolean"
    casts = {n: (to_number(F.col(f"`{n}`")) if t == "double" else to_whole(F.col(f"`{n}`")) if t == "bigint" else F.btrim(F.col(f"`{n}`")).try_cast(t))
             for n, t in types.items()}
    return df.withColumns(casts)
