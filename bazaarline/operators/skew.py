"""Joins and running totals that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

# A key below this many rows is small for one task. At most rows/HOT_ROWS keys can reach it,
# which bounds the hot-key list that is broadcast. A hot key is dealt over rows/HOT_ROWS parts.
HOT_ROWS = 1_000_000
KEY_SLICES = 16_384  # slices of the key's hash in which rows are counted before keys are

# What reads stored data row by row; anything else makes the size of a plan a guess.
_PLAIN = {"Project", "Filter", "Relation", "SubqueryAlias", "View", "LocalRelation", "Range", "LogicalRelation", "ResolvedHint"}


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is a stored table, at most filtered and projected."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().split(" ")[0] not in _PLAIN:
            return False
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return True


def stored(df: DataFrame, label: str = "lookup") -> DataFrame:
    """``df`` with a size that can be trusted: what is more than a stored table is written once."""
    return df if is_stored(df) else materialise(df, label)


def size_bytes(df: DataFrame) -> int:
    """Size of the result as the optimiser knows it (file sizes for stored tables)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the size is within the session's own broadcast limit. ``df`` must be ``stored``:
    the optimiser multiplies the sizes of joined tables."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= size_bytes(df) <= limit


@dataclass
class Lookup:
    """One step of ``spread_joins``: a table joined by equal keys. ``condition`` may use
    ``l.<col>`` and ``r.<col>``; ``drop`` names right columns that only the condition needs."""

    right: DataFrame
    keys: Sequence[str]
    how: str = "inner"
    condition: Column | None = None
    drop: Sequence[str] = ()


def _hot_keys(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """Keys of at least ``limit`` rows with the parts to deal them over; None where no key, and no lack of one, has as many.

    Rows are counted by slices of the key's hash first, a short list per task: only keys of a slice with ``limit`` rows can be
    hot, and only those are counted by value.
    """
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    slices = df.withColumn("__slice", F.when(~no_key, F.pmod(F.xxhash64(*keys), F.lit(KEY_SLICES)))).groupBy("__slice").agg(
        F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= limit).select("__slice").collect()  # at most KEY_SLICES and one
    if not slices:
        return None
    full = [r[0] for r in slices if r[0] is not None]
    in_full = F.pmod(F.xxhash64(*keys), F.lit(KEY_SLICES)).isin(full) if full else F.lit(False)
    return df.dropna(subset=list(keys)).where(in_full).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")) \
        .filter(F.col("__n") >= limit) \
        .select(*keys, F.ceil(F.col("__n") / F.lit(float(limit))).cast("int").alias("__parts"))


def spread_joins(left: DataFrame, lookups: Sequence[Lookup], hot_rows: int | None = None) -> DataFrame:
    """Equi joins of a large ``left`` with several lookups, one after the other (inner or left).

    Right key columns are dropped. A lookup within the broadcast limit is joined in place: nothing
    is shuffled, so no key can be hot. Where one is larger, ``left`` is cut once before the chain,
    and its keys are counted on the stored copy (by slices of their hash first; without a hot key the joins are plain): rows of a hot key are dealt over parts by a hash
    of the row (the same on every retry), as many as the key has ``hot_rows``, and the lookup rows
    of exactly the hot keys are copied once per part. Rows without a key match nothing; they are
    dealt over all tasks.
    """
    limit = hot_rows or HOT_ROWS
    lookups = [replace(x, right=stored(x.right)) for x in lookups]
    large = [not fits_broadcast(x.right) for x in lookups]
    if any(large):
        left = stored(left, "facts")
    lanes = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base, out = left, left
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(2**31 - 1))
    for lookup, is_large in zip(lookups, large):
        keys = list(lookup.keys)
        names = {k: f"__r_{k}" for k in keys}
        right = lookup.right.withColumnsRenamed(names)
        on = [F.col(f"l.`{k}`") == F.col(f"r.`{n}`") for k, n in names.items()]
        if lookup.condition is not None:
            on.append(lookup.condition)
        hot = _hot_keys(base, keys, limit) if is_large else None
        if hot is not None:
            no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
            parts = F.when(no_key, F.lit(lanes)).otherwise(F.coalesce("__parts", F.lit(1)))
            out = out.join(F.broadcast(hot), keys, "left") \
                .withColumn("__salt", F.pmod(dealt, parts).cast("int")).drop("__parts")
            copies = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)
            right = right.join(F.broadcast(hot.withColumnsRenamed(names)), list(names.values()), "left") \
                .withColumn("__rsalt", F.explode(copies)).drop("__parts")
            on.append(F.col("l.__salt") == F.col("r.__rsalt"))
        out = out.alias("l").join(right.alias("r"), reduce(lambda a, b: a & b, on), lookup.how) \
            .drop(*names.values(), "__salt", "__rsalt", *lookup.drop)
    return out.select(*left.columns, *[c for x in lookups for c in x.right.columns if c not in {*x.keys, *x.drop}])


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                condition: Column | None = None, hot_rows: int | None = None) -> DataFrame:
    """``spread_joins`` with one lookup."""
    return spread_joins(left, [Lookup(right, keys, how, condition)], hot_rows)


def running_by_instant(df: DataFrame, keys: Sequence[str], instant: str, sums: Sequence[str]) -> DataFrame:
    """Running totals ``<sum>_before`` (strictly earlier) and ``<sum>_upto`` per key and instant.

    ``df`` must hold one row per key and instant. Two levels keep every window small even for a
    key that owns much of the table: totals per day first, then instants within their day.
    """
    keys = list(keys)
    days = df.withColumn("__day", F.to_date(instant))
    daily = days.groupBy(*keys, "__day").agg(*[F.sum(s).alias(f"__{s}") for s in sums])
    earlier = Window.partitionBy(*keys).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    base = daily.select(*keys, "__day", *[F.coalesce(F.sum(f"__{s}").over(earlier), F.lit(0)).alias(f"__{s}")
                                          for s in sums])
    within = Window.partitionBy(*keys, "__day").orderBy(instant).rowsBetween(Window.unboundedPreceding, 0)
    inner = days.select("*", *[F.sum(s).over(within).alias(f"{s}_upto") for s in sums])
    joined = inner.join(base, [*keys, "__day"])
    out = []
    for s in sums:
        upto = F.col(f"{s}_upto") + F.col(f"__{s}")
        out += [upto.alias(f"{s}_upto"), (upto - F.col(s)).alias(f"{s}_before")]
    return joined.select(*df.columns, *out)
