"""Point-in-time joins as a merge in time, against the plain interval join."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bazaarline.operators import asof, scd
from bazaarline.session import materialise
from conftest import rows

DIM = "k long, v string, effective_date timestamp_ntz, end_date timestamp_ntz"
DAY = datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else DAY + timedelta(hours=hours)


def random_tables(spark, seed):
    rng = random.Random(seed)
    dim = []
    for k in range(6):
        t = rng.randint(0, 20)
        for _ in range(rng.choice([1, 5, 60])):
            end = t + rng.randint(1, 9)
            dim.append((k, f"v{len(dim)}", at(t), at(end)))
            t = end + rng.choice([0, 0, 3])
        dim.append((k, "open", at(t), None))
    dim += [(7, "a", at(0), at(50)), (7, "b", at(10), at(20)), (7, "c", at(10), None), (8, "inverted", at(9), at(3)), (8, "empty", at(4), at(4)),
            (None, "no key", at(0), None), (1, "no start", None, None), (9, "never", at(5000), None)]
    facts = [(i, rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 7, 8, 9, 10, None]), at(rng.choice([None, *range(0, 300)]))) for i in range(600)]
    facts += facts[:5]
    return spark.createDataFrame(facts, "i int, k long, t timestamp_ntz").repartition(3), spark.createDataFrame(dim, DIM)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("how", ["inner", "left"])
def test_merge_equals_interval_join(spark, seed, how):
    fact, dim = random_tables(spark, seed)
    plain = fact.alias("l").join(dim.alias("r"), (F.col("l.k") == F.col("r.k")) & (F.col("l.t") >= F.col("effective_date"))
                                 & (F.col("end_date").isNull() | (F.col("l.t") < F.col("end_date"))), how)
    want = rows(plain.select("l.i", "l.k", "l.t", "r.v"))
    for range_rows in (20, 10**6):  # keys cut into ranges, and in one
        got = asof.asof_merge(fact, dim, "k", "t", ["v"], how, range_rows=range_rows)
        assert got.columns == ["i", "k", "t", "v"] and rows(got) == want


def test_empty_sides(spark):
    fact, dim = random_tables(spark, 0)
    assert asof.asof_merge(fact.limit(0), dim, "k", "t", ["v"], "left").count() == 0
    assert asof.asof_merge(fact, dim.limit(0), "k", "t", ["v"]).count() == 0
    assert asof.asof_merge(fact, dim.limit(0), "k", "t", ["v"], "left").where("v is null").count() == fact.count()


def test_one_key_with_very_many_versions_and_facts(spark):
    """10^5 versions and 10^6 facts of one key: 10^11 pairs, were they compared."""
    start = F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).cast("timestamp_ntz")
    dim = materialise(spark.range(100_000).select(F.lit(1).alias("k"), "id", start.alias("effective_date"),
                                                  F.timestamp_seconds(1_700_000_060 + F.col("id") * 60).cast("timestamp_ntz").alias("end_date")), "wide")
    fact = materialise(spark.range(1_000_000).select(F.lit(1).alias("k"), (F.col("id") % 100_000).alias("want"), F.timestamp_seconds(
        1_700_000_000 + (F.col("id") % 100_000) * 60 + F.col("id") % 59).cast("timestamp_ntz").alias("t")), "wide")
    began = time.time()
    got = scd.asof_join(fact, dim, "k", "t", ["id"]).agg(F.count_if(F.col("id") == F.col("want")), F.count(F.lit(1))).first()
    assert tuple(got) == (1_000_000, 1_000_000)
    assert time.time() - began < 120
