"""Row-level set operators: dedup, latest, upsert, anti joins, set unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import Lookup, fits_broadcast, is_stored, spread_joins, stored


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], keep: str = "first") -> DataFrame:
    """One row per key: the first or last in ``order_by``. Missing keys form one group.

    Spark limits every task to one row per key before the shuffle, so the copies of a hot key
    are thinned where they are read.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if keep == "last":
        order = [c.desc() for c in order]
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(ranked)).filter(F.col("__rn") == 1).drop("__rn")


def dedup_few(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], keep: str = "first") -> DataFrame:
    """``dedup`` of a stored table in which few keys are expected twice: the same rows, and most of them are not shuffled.

    Keys are counted first, so the keys alone are shuffled. Rows of a key that comes once pass as they are; those of repeated
    keys are ordered, all rows where the list of repeated keys cannot be broadcast.
    """
    if not is_stored(df):
        return dedup(df, keys, order_by, keep)
    names = {k: f"__twice_{n}" for n, k in enumerate(keys)}
    twice = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(
        *[F.col(f"`{k}`").alias(n) for k, n in names.items()]), "repeated-keys")
    if twice.isEmpty():
        return df
    if not fits_broadcast(twice):
        return dedup(df, keys, order_by, keep)
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()])
    once = df.join(F.broadcast(twice), same, "left_anti")
    return once.unionByName(dedup(df.join(F.broadcast(twice), same, "left_semi"), keys, order_by, keep))


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Newest row per key."""
    return dedup(df, keys, order_by, keep="last")


def unseen(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing`` yet.

    A small batch is broadcast against the key columns of the big table first, so the big
    table is scanned but never shuffled.
    """
    keys = list(keys)
    have = existing.select(*keys)
    df = stored(df, "batch")
    batch_keys = df.select(*keys)
    if fits_broadcast(batch_keys):
        have = have.join(F.broadcast(batch_keys), keys, "left_semi")
    return df.join(have, keys, "left_anti")


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` plus the source rows whose key it lacks."""
    return target.unionByName(source.join(target.select(*keys), list(keys), "left_anti").select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overwrite in place, else insert. ``source`` must hold one row per key."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str, nulls_count: bool = False) -> DataFrame:
    """Foreign key values without a dimension row, with the number of fact rows of each.

    Facts are counted per key before the join, so the join sees one row per key value.
    """
    per_key = fact.groupBy(F.col(fk).alias("fk")).agg(F.count(F.lit(1)).alias("rows"))
    if not nulls_count:
        per_key = per_key.filter(F.col("fk").isNotNull())
    return per_key.join(dim.select(F.col(pk).alias("fk")), "fk", "left_anti")


def orphan_count(fact: DataFrame, dim: DataFrame, fk: str, pk: str, nulls_count: bool = False,
                 name: str = "orphans") -> DataFrame:
    found = orphans(fact, dim, fk, pk, nulls_count)
    return found.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def with_current(df: DataFrame, dim: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Join to the current version of a versioned dimension."""
    return spread_joins(df, [current_lookup(dim, keys, columns, how)])


def current_lookup(dim: DataFrame, keys: Sequence[str], columns: Sequence[str], how: str = "inner") -> Lookup:
    """The current version of a versioned dimension as a lookup."""
    return Lookup(dim.filter("is_current").select(*keys, *columns), keys, how)


def tagged_union(parts: dict[str, DataFrame], tag: str = "table_name") -> DataFrame:
    """UNION ALL of frames with the same columns, each row tagged with its part."""
    frames = [df.select(F.lit(name).alias(tag), "*") for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def distinct_union(first: DataFrame, second: DataFrame, name: str) -> DataFrame:
    """Distinct names of both frames; ``priority`` 0 where the first holds it, else 1."""
    both = first.select(F.col(name), F.lit(0).alias("priority")).unionByName(
        second.select(F.col(name), F.lit(1).alias("priority")))
    return both.groupBy(name).agg(F.min("priority").alias("priority"))


def schema_diff(df: DataFrame, old: str, new: str) -> DataFrame:
    """Names added to and removed from an array of column names."""
    return df.withColumns({
        "added": F.array_sort(F.array_except(F.col(new), F.col(old))),
        "removed": F.array_sort(F.array_except(F.col(old), F.col(new))),
    })


def pct_change(df: DataFrame, order_by: str, value: str, name: str) -> DataFrame:
    """Change to the previous row in percent; 0 for the first row and for 0 after 0.

    The window has no partition key: ``df`` must be a daily series, at most one row per day.
    """
    prev = F.lag(F.col(value)).over(Window.orderBy(order_by))
    cur, before = F.col(value).cast("double"), prev.cast("double")
    growth = F.when(before.isNull() | ((before == 0) & (cur == 0)), F.lit(0.0)) \
        .when(before == 0, F.signum(cur) * F.lit(float("inf"))) \
        .otherwise((cur / before - F.lit(1.0)) * F.lit(100.0))
    return df.withColumn(name, growth)
