"""Suites in one scan, against counts made in plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bazaarline.operators import quality
from conftest import rows


def plain(data, flags, keyed):
    out = {"rows": len(data)}
    out |= {name: sum(1 for r in data if test(r)) for name, test in flags.items()}
    out |= {"dup:" + ",".join(k): sum(n - 1 for n in Counter(tuple(r[c] for c in k) for r in data).values()) for k in keyed}
    return out


def test_one_pass_equals_plain_counts(spark):
    rng = random.Random(3)
    data = [{"a": rng.choice([1, 1, 1, None, rng.randrange(50)]), "b.c": rng.choice(["x", "", None, str(rng.randrange(9))]), "__w0": i % 7}
            for i in range(900)]
    df = spark.createDataFrame([tuple(r.values()) for r in data], "a long, `b.c` string, __w0 long").repartition(5)
    tests = {"no a": (F.col("a").isNull(), lambda r: r["a"] is None),
             "a over 20": (F.col("a") > 20, lambda r: r["a"] is not None and r["a"] > 20),
             "never": (F.lit(False), lambda r: False)}
    tests |= {f"w{i}": (F.col("__w0") == i % 8, lambda r, i=i: r["__w0"] == i % 8) for i in range(130)}  # more flags than a word has bits
    keyed = [("a",), ("b.c",), ("a", "b.c"), ("__w0", "a")]
    got = quality.one_pass(df, {n: c for n, (c, _) in tests.items()}, keyed).first().asDict()
    assert got == plain(data, {n: t for n, (_, t) in tests.items()}, keyed)
    none = quality.one_pass(df.limit(0), {"no a": F.col("a").isNull()}, [("a",)]).first().asDict()
    assert none == {"rows": 0, "no a": 0, "dup:a": 0}
    assert quality.one_pass(df, {}, [("a",)]).first()["dup:a"] == plain(data, {}, [("a",)])["dup:a"]


def test_suite_reads_its_dataset_once(spark, tmp_path):
    path = str(tmp_path / "t")
    nan = float("nan")
    spark.createDataFrame([(1, 0.0), (1, -0.0), (2, nan), (None, nan), (None, None)], "k long, v double").write.parquet(path)
    df = spark.read.parquet(path)
    rules = [quality.Unique(("k",)), quality.Unique(("v",)), quality.DupPct(("k", "v"), 0.0), quality.NullPct("v", 0.5), quality.Between("v", 0, 1)]
    got = quality.run_suite(df, "t", rules)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    found = {r["expectation"]: r["details"] for r in got.collect()}
    assert found["k unique"] == "Found 2 duplicates" and found["v unique"] == "Found 2 duplicates"
    assert "(1 duplicates)" in found["k_v duplicate percent <= 0.0%"] and "(3 nulls)" in found["v null percent <= 50.0%"]


@pytest.mark.parametrize("parts", [1, 40])
def test_hot_key_is_combined_before_the_shuffle(spark, parts):
    df = spark.range(20_000, numPartitions=parts).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    assert rows(quality.one_pass(df, {"hot": F.col("k") == 7}, [("k",)])) == [(20_000, 6668, 6667)]
