"""Point-in-time join over wide histories as an ordered merge.

Facts and versions of a key are put in one order of time and the last version is carried forward to the facts
behind it, so the work is that of sorting both, however many versions a key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .skew import Lookup, spread_joins, stored

EFFECTIVE, END = "effective_date", "end_date"

# A key below this many rows (facts and versions) is one range of time, and so is one with less than a
# thousandth of all rows: at most 1000 keys are cut, into at most RANGES ranges each.
RANGE_ROWS = 1_000_000
RANGES = 256


def widest_history(dim: DataFrame, key: str) -> int:
    """Versions of the key that has most of them."""
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def tangled_keys(versions: DataFrame, key: str) -> DataFrame:
    """Keys with versions that overlap: more than one of them can hold at one time.

    With starts and ends in one order of time, every start of an orderly history finds all earlier versions ended.
    Sums per instant come first; a large key is spread over its days.
    """
    from .skew import running_by_instant

    marks = F.array(F.struct(F.col(EFFECTIVE).alias("t"), F.lit(1).alias("st"), F.lit(0).alias("en")),
                    F.struct(F.col(END).alias("t"), F.lit(0).alias("st"), F.lit(1).alias("en")))
    at = versions.select(key, F.inline(marks)).where("t is not null").groupBy(key, "t").agg(
        F.sum("st").alias("st"), F.sum("en").alias("en"))
    swept = running_by_instant(at, [key], "t", ["st", "en"])
    return swept.where("st > 1 or (st = 1 and st_before > en_upto)").select(key).distinct()


def _cuts(events: DataFrame, key: str, range_rows: int) -> DataFrame:
    """Instants that cut the large keys into ranges of about the same number of rows."""
    sizes = events.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    large = sizes.where(F.col("n") >= max(range_rows, total // 1000)).select(key)
    shares = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    return events.join(F.broadcast(large), key, "left_semi").groupBy(key).agg(
        F.array_sort(F.array_distinct(F.percentile_approx("__t", shares))).alias("__cuts"))


def _range_of(t: Column) -> Column:
    return F.coalesce(F.size(F.filter("__cuts", lambda c: c <= t)), F.lit(0))


def asof_merge(fact: DataFrame, dim: DataFrame, key: str, ts: str, columns: Sequence[str], how: str = "inner",
               range_rows: int | None = None, **spread) -> DataFrame:
    """``fact`` rows with ``columns`` of the version valid at ``ts`` (start included, end excluded; inner or left).

    The same rows as an interval join. Facts and versions are dealt by key and range of time: keys with very many
    rows are cut at quantiles of their instants, and each range starts with the last version before it, taken from one row per
    key and range. Keys whose versions overlap (see ``tangled_keys``), where a fact can have several versions, are left to the
    interval join. Facts without key or time have no version, versions without key or start hold never. Repeated facts stay repeated.
    """
    fact = stored(fact, "facts")
    versions = dim.select(key, *[c for c in columns if c != key], EFFECTIVE, END).where(
        F.col(key).isNotNull() & F.col(EFFECTIVE).isNotNull() & (F.col(END).isNull() | (F.col(END) > F.col(EFFECTIVE))))
    versions = materialise(versions, "versions")
    tangled = materialise(tangled_keys(versions, key), "tangled")
    out_columns = [*fact.columns, *[c for c in columns if c != key]]
    payload = F.struct(*[F.col(f"`{c}`") for c in fact.columns])
    timed = fact.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{ts}`").isNotNull())
    orderly = timed.join(tangled.withColumnRenamed(key, "__key"), F.col(f"`{key}`") == F.col("__key"), "left_anti")
    body = F.struct(F.col(END).alias("__to"), *[F.col(c) for c in columns if c != key])
    facts = orderly.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{ts}`").cast("timestamp_ntz").alias("__t"), F.lit(1).alias("__kind"),
                           payload.alias("__fact"))
    starts = versions.join(tangled, key, "left_anti").select(
        F.col(key).alias("__key"), F.col(EFFECTIVE).alias("__t"), F.lit(0).alias("__kind"), body.alias("__version"))

    both = facts.select("__key", "__t").unionByName(starts.select("__key", "__t"))
    cuts = materialise(_cuts(both, "__key", range_rows or RANGE_ROWS), "cuts")
    dealt = facts.unionByName(starts, allowMissingColumns=True).join(F.broadcast(cuts), "__key", "left") \
        .withColumn("__range", _range_of(F.col("__t")))
    # what a range begins with: the last version of the ranges before it
    last = starts.join(F.broadcast(cuts), "__key").withColumn("__range", _range_of(F.col("__t"))).groupBy("__key", "__range") \
        .agg(F.max_by("__version", "__t").alias("__version"))
    grid = cuts.select("__key", F.explode(F.sequence(F.lit(0), F.size("__cuts"))).alias("__range"))
    before = Window.partitionBy("__key").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # at most RANGES rows
    carried = grid.join(last, ["__key", "__range"], "left").select(
        "__key", "__range", F.last("__version", ignorenulls=True).over(before).alias("__version")).where("__version is not null")
    events = dealt.drop("__cuts").unionByName(carried.withColumn("__kind", F.lit(0)), allowMissingColumns=True)
    so_far = Window.partitionBy("__key", "__range").orderBy(F.col("__t").asc_nulls_first(), "__kind") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = events.withColumn("__version", F.last("__version", ignorenulls=True).over(so_far)).where("__kind = 1")
    holds = F.col("__version").isNotNull() & (F.col("__version.__to").isNull() | (F.col("__t") < F.col("__version.__to")))
    if how == "inner":
        found = found.where(holds)
    merged = found.select("__fact.*", *[F.when(holds, F.col("__version").getField(c)).alias(c) for c in columns if c != key])

    # keys with overlapping versions: every version that holds
    odd_facts = timed.join(tangled.withColumnRenamed(key, "__key"), F.col(f"`{key}`") == F.col("__key"), "left_semi")
    odd = versions.join(tangled, key, "left_semi").withColumnsRenamed({EFFECTIVE: "__from", END: "__to"})
    valid = (F.col(f"l.`{ts}`") >= F.col("r.__from")) & (F.col("r.__to").isNull() | (F.col(f"l.`{ts}`") < F.col("r.__to")))
    parts = [merged.select(*[F.col(f"`{c}`") for c in out_columns])]
    if not tangled.isEmpty():
        parts.append(spread_joins(odd_facts, [Lookup(odd, [key], how, valid, ("__from", "__to"))], **spread))
    if how == "left":
        untimed = fact.where(F.col(f"`{key}`").isNull() | F.col(f"`{ts}`").isNull())
        parts.append(untimed.select("*", *[F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in columns if c != key]))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
