"""Versioned dimensions: change detection, merge, point-in-time join and overlap audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.numbers import differs
from .asof import asof_merge, widest_history
from .keys import assign_sk
from .rows import dedup
from .skew import Lookup, running_by_instant, spread_joins, stored

# With more versions of one key than this, a point-in-time join is a merge in time, not a test of every version.
WIDE = 64

EFFECTIVE, END, CURRENT = "effective_date", "end_date", "is_current"


def ntz(ts: str | datetime) -> Column:
    return F.lit(str(ts)).cast("timestamp_ntz")


def _changed(old: Mapping[str, Column], new: Mapping[str, Column], tolerance: Mapping[str, float],
             null_safe: bool) -> Column:
    return reduce(lambda a, b: a | b,
                  [differs(old[c], new[c], tolerance.get(c), null_safe) for c in old])


def changed_keys(dim: DataFrame, stg: DataFrame, key: str, compare: Sequence[str],
                 tolerance: Mapping[str, float] | None = None, null_safe: bool = False) -> DataFrame:
    """Keys whose current version differs from staging in a compared column."""
    cur = dim.filter(CURRENT).select(key, *[F.col(c).alias(f"__old_{c}") for c in compare])
    both = cur.join(stg.select(key, *compare), key)
    test = _changed({c: F.col(f"__old_{c}") for c in compare}, {c: F.col(c) for c in compare},
                    tolerance or {}, null_safe)
    return both.filter(test).select(key).distinct()


def with_default(dim: DataFrame, default_row: Mapping, sk: str) -> DataFrame:
    """``dim`` plus the default member, unless its surrogate key is taken."""
    seed = dim.sparkSession.range(1).select(*[
        F.lit(default_row.get(f.name)).cast("string").cast(f.dataType).alias(f.name) for f in dim.schema])
    return dim.unionByName(seed.join(dim.filter(F.col(sk) == default_row[sk]).select(sk), sk, "left_anti").select(*dim.columns))


def scd2_merge(dim: DataFrame, stg: DataFrame, key: str, compare: Sequence[str], load_ts: str | datetime,
               sk: str, tolerance: Mapping[str, float] | None = None, null_safe: bool = False,
               default_row: Mapping | None = None, first_effective: str = schemas.FIRST_EFFECTIVE,
               history_aware: bool = True, start: int | None = None) -> DataFrame:
    """Next snapshot of a Type 2 dimension, or of the part of it that holds the staged keys: new surrogate keys then
    begin after ``start``, the largest of the whole.

    Current versions that differ from staging end at ``load_ts``; their new versions start
    there. Unknown keys start at ``first_effective``, and so do keys without a current version
    when ``history_aware`` is off. Keys absent from staging stay as they are.
    By default a NULL on either side is no change; ``null_safe`` counts it as one.

    A small staging table is broadcast, so the dimension is not shuffled; otherwise both sides
    are hashed on the key once and all steps share that layout.
    """
    tolerance = tolerance or {}
    if default_row is not None:
        dim = with_default(dim, default_row, sk)
    attrs = [c for c in dim.columns if c not in (sk, key, EFFECTIVE, END, CURRENT)]
    staged = dedup(stg.select(key, *attrs), [key], attrs)
    load = ntz(load_ts)

    incoming = staged.select(key, *[F.col(c).alias(f"__new_{c}") for c in compare], F.lit(True).alias("__staged"))
    matched = dim.join(incoming, key, "left")
    test = _changed({c: F.col(c) for c in compare}, {c: F.col(f"__new_{c}") for c in compare},
                    tolerance, null_safe)
    closing = F.col(CURRENT) & F.coalesce(F.col("__staged"), F.lit(False)) & test
    flagged = matched.withColumn("__close", F.coalesce(closing, F.lit(False)))
    kept = flagged.withColumns({
        END: F.when(F.col("__close"), load).otherwise(F.col(END)),
        CURRENT: F.col(CURRENT) & ~F.col("__close"),
    }).select(*dim.columns)

    state = flagged.filter(F.col("__staged")).groupBy(key).agg(
        F.max(F.col(CURRENT) & ~F.col("__close")).alias("__open"), F.max("__close").alias("__closed"))
    fresh = staged.join(state, key, "left").filter(~F.coalesce(F.col("__open"), F.lit(False)))
    known = F.col("__open").isNotNull() if history_aware else F.coalesce(F.col("__closed"), F.lit(False))
    fresh = fresh.select(
        key, *attrs,
        F.when(known, load).otherwise(ntz(first_effective)).alias(EFFECTIVE),
        F.lit(None).cast("timestamp_ntz").alias(END), F.lit(True).alias(CURRENT))
    numbered = assign_sk(fresh, sk, [key, *attrs], start=dim.select(F.max(sk)).scalar() if start is None else start)
    aligned = numbered.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in dim.schema])
    return kept.unionByName(aligned)


def scd2_dirty(dim: DataFrame, stg: DataFrame, key: str, compare: Sequence[str],
               tolerance: Mapping[str, float] | None = None, null_safe: bool = False) -> DataFrame:
    """Staged keys that ``scd2_merge`` gives a new version: changed ones, and those without a current one."""
    new = stg.select(key).join(dim.filter(CURRENT).select(key), key, "left_anti")
    return changed_keys(dim, stg, key, compare, tolerance, null_safe).unionByName(new.distinct())


def asof_lookup(dim: DataFrame, key: str, ts: str, columns: Sequence[str], how: str = "inner",
                as_of: bool = True) -> Lookup:
    """The dimension version valid at ``ts`` (start included, end excluded), as a lookup.

    The business key stays an equality of the join, the interval is a residual test on it.
    ``as_of=False`` takes the current version whatever the date.
    """
    if not as_of:
        return Lookup(dim.filter(CURRENT).select(key, *columns), [key], how)
    versions = dim.select(key, *columns, F.col(EFFECTIVE).alias("__from"), F.col(END).alias("__to"))
    valid = (F.col(f"l.`{ts}`") >= F.col("r.__from")) & (
        F.col("r.__to").isNull() | (F.col(f"l.`{ts}`") < F.col("r.__to")))
    return Lookup(versions, [key], how, valid, ("__from", "__to"))


def asof_join(fact: DataFrame, dim: DataFrame, key: str, ts: str, columns: Sequence[str],
              how: str = "inner", as_of: bool = True, **spread) -> DataFrame:
    """Fact rows with the dimension version of their time (see ``asof_lookup``; ``asof_merge`` for wide histories)."""
    return asof_joins(fact, [(dim, key, ts, columns, how, as_of)], **spread)


def asof_joins(fact: DataFrame, steps: Sequence[tuple], **spread) -> DataFrame:
    """Several joins of ``asof_join`` (dim, key, ts, columns, how, as_of), one after the other.

    Dimensions with few versions a key are joined in one chain; one with wide histories takes a merge of its own.
    """
    chain: list[Lookup] = []
    for dim, key, ts, columns, how, as_of in steps:
        if as_of and widest_history(dim, key) > WIDE:
            fact = spread_joins(fact, chain, **spread) if chain else fact
            fact, chain = asof_merge(fact, dim, key, ts, columns, how, **spread), []
        else:
            chain.append(asof_lookup(dim, key, ts, columns, how, as_of))
    return spread_joins(fact, chain, **spread) if chain else fact


def _micros(ts: Column) -> Column:
    """Microseconds since the year 1, whatever the session's zone."""
    days = F.datediff(F.to_date(ts), F.lit("0001-01-01").cast("date")).cast("bigint")
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    return days * 86_400_000_000 + seconds.cast("bigint") * 1_000_000 + F.floor(F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def _around_inverted(shapes: DataFrame) -> DataFrame:
    """Per key, the pairs of a version that ends before it starts and one that begins before its end and ends after its start.

    These are points (start, end) in a quadrant, counted by merging: starts are written in base 4, a point belongs to
    the block of each of its prefixes, and "starts before" is the sum of at most three blocks a digit. Within a block, ends are
    swept in order of time. Work grows with the versions of keys that have inverted ones, times the digits; other
    keys take none.
    """
    inverted = shapes.filter("s > e")
    points = shapes.filter("s < e").join(inverted.select("k").distinct(), "k", "left_semi").select(
        "k", _micros(F.col("s")).alias("x"), F.col("e").alias("t"), "n", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("level"))
    points = points.select("k", "level", F.expr("shiftright(x, 2 * level)").alias("block"), "t", F.col("n").alias("pts"), F.lit(0).cast("bigint").alias("ask"))
    asked = inverted.select("k", _micros(F.col("e")).alias("x"), F.col("s").alias("t"), "n", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("level")) \
        .withColumn("digit", F.expr("cast(shiftright(x, 2 * level) & 3 as int)")).where("digit > 0") \
        .select("k", "level", "t", "n", F.expr("explode(sequence(0L, digit - 1L))").alias("lower"), F.expr("shiftright(x, 2 * level + 2) * 4").alias("above")) \
        .select("k", "level", (F.col("above") + F.col("lower")).alias("block"), "t", F.lit(0).cast("bigint").alias("pts"), F.col("n").alias("ask"))
    blocks = ["k", "level", "block"]
    points = points.join(asked.select(*blocks).distinct(), blocks, "left_semi")
    instants = points.unionByName(asked).groupBy(*blocks, "t").agg(F.sum("pts").alias("pts"), F.sum("ask").alias("ask"))
    swept = running_by_instant(instants, blocks, "t", ["pts"])
    return swept.groupBy(*blocks).agg((F.sum("ask") * F.sum("pts") - F.sum(F.col("ask") * F.col("pts_upto"))).alias("pairs")) \
        .groupBy("k").agg(F.sum("pairs").alias("pairs"))


def overlap_pairs(dim: DataFrame, key: str, wide: int = WIDE) -> DataFrame:
    """Number of version pairs of one key whose intervals overlap, per key (keys without any left out).

    The versions of a key with at most ``wide`` of them are gathered and compared in place, which costs one shuffle; keys
    with more are counted by ``_swept_pairs``, without pairs and spread over tasks.
    """
    iv = dim.filter(F.col(key).isNotNull() & F.col(EFFECTIVE).isNotNull()).select(
        F.col(key).alias("k"), F.col(EFFECTIVE).alias("s"),
        F.coalesce(F.col(END), ntz(schemas.OPEN_END)).alias("e"))
    large = stored(iv.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > wide).select("k"), "wide-keys")
    some = not large.isEmpty()
    narrow = iv.join(large, "k", "left_anti") if some else iv
    # every version is compared with all of its key: a pair meets twice, and each proper version itself
    twice = narrow.groupBy("k").agg(F.collect_list(F.struct("s", "e")).alias("v")).select("k", F.expr(
        "aggregate(v, 0L, (n, a) -> n + size(filter(v, b -> a.s < b.e and a.e > b.s)) - if(a.s < a.e, 1, 0))").alias("twice"))
    total = twice.unionByName(_swept_pairs(iv.join(large, "k", "left_semi"))) if some else twice
    return total.filter("twice <> 0").select(
        F.col("k").alias(key), F.expr("cast(twice div 2 as bigint)").alias("pairs"))


def _swept_pairs(iv: DataFrame) -> DataFrame:
    """Twice the number of overlapping pairs of the versions (k, s, e), per key.

    The pairs are counted, not built. With starts and ends summed per instant, an interval
    meets every version that starts before its end, less those that ended by its start; zero
    length versions at one instant are put right by a correction. Every step groups by key and
    instant, so a key with very many versions is spread as well. Versions that end before they start are
    counted by ``_around_inverted``, without pairs too.
    """
    shapes = iv.groupBy("k", "s", "e").agg(F.count(F.lit(1)).alias("n"))
    proper = shapes.filter("s <= e")
    ends = F.array(
        F.struct(F.col("s").alias("t"), F.col("n").alias("st"), F.lit(0).cast("bigint").alias("en")),
        F.struct(F.col("e").alias("t"), F.lit(0).cast("bigint").alias("st"), F.col("n").alias("en")))
    instants = proper.select("k", F.inline(ends)).groupBy("k", "t").agg(
        F.sum("st").alias("st"), F.sum("en").alias("en"))
    swept = running_by_instant(instants, ["k"], "t", ["st", "en"])
    met = swept.select("k", (F.col("en") * F.col("st_before") - F.col("st") * F.col("en_upto")).alias("twice"))
    # each proper interval meets itself; zero-length ones at one instant were taken off n*n too often
    selves = proper.select("k", F.when(F.col("s") < F.col("e"), -F.col("n"))
                           .otherwise(F.col("n") * F.col("n")).alias("twice"))
    crossed = _around_inverted(shapes).select("k", (2 * F.col("pairs")).alias("twice"))  # two inverted ones never meet
    return met.unionByName(selves).unionByName(crossed).groupBy("k").agg(F.sum("twice").alias("twice"))


def overlap_count(dim: DataFrame, key: str, name: str = "overlaps") -> DataFrame:
    """Overlapping version pairs of the whole dimension as one row."""
    return overlap_pairs(dim, key).agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("bigint").alias(name))
