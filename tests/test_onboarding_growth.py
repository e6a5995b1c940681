"""Steps of an onboarding whose bytes were found too many: results as before, with fewer rows shuffled and no copies of them."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazaarline import schemas
from bazaarline.operators import clean, profile
from bazaarline.operators.rows import dedup, dedup_few
from bazaarline.plans import gold_deltas, onboarding, warehouse
from bazaarline.plans.gold_deltas import GoldState
from bazaarline.queries.jobs import LOAD_TS
from bazaarline.sources.buckets import BucketTable
from bazaarline.sources.members import LoadedKeys
from conftest import rows

DAY = datetime(2024, 1, 1)
POS = "transaction_id bigint, store_id bigint, product_id bigint, quantity bigint, timestamp timestamp_ntz, sale_amount double"


def kept(spark, tmp_path, data, schema, name="t"):
    path = f"file:{tmp_path / name}"
    spark.createDataFrame(data, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("limit", ["10485760", "-1"])
@pytest.mark.parametrize("keep", ["first", "last"])
def test_few_copies_are_those_of_dedup(spark, tmp_path, limit, keep):
    rng = random.Random(3)
    data = [(rng.choice([None, *range(60)]), rng.choice([None, "a", "b"]), i) for i in range(90)]
    df = kept(spark, tmp_path, data, "`k.1` int, k2 string, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        for keys in (["`k.1`"], ["k2"]):
            df2 = df.withColumnRenamed("k.1", "k1")
            keys = [k.replace("`k.1`", "k1") for k in keys]
            got = dedup_few(df2, keys, ["v"], keep)
            assert rows(got) == rows(dedup(df2, keys, ["v"], keep)) and got.columns == df2.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_without_copies_are_not_ordered(spark, tmp_path):
    df = kept(spark, tmp_path, [(i, -i) for i in range(50)], "k int, v int")
    plan = dedup_few(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    made = df.groupBy("k").agg(F.max("v").alias("v"))  # not stored: ordered at once
    assert "Window" in dedup_few(made, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()


def test_silver_of_few_copies_equals_that_of_many(spark, lake):
    data = [(str(i % 40), "1", "2", "3", "2024-01-05", str(i), "f", 0, i) for i in range(43)] + [(None, "1", "2", "3", None, "x", "f", 0, 50 + i) for i in range(2)]
    bronze = spark.createDataFrame(data, "transaction_id string, store_id string, product_id string, quantity string, timestamp string, "
                                         "sale_amount string, _file string, _block int, _pos int").repartition(3)
    lake.replace_partition(bronze, "bronze", "pos_transactions", "run_id", "r")
    names = [f.name for f in schemas.layout("pos_transactions")]
    clean.to_silver(lake, "pos_transactions", "r")
    want = rows(lake.read("silver", "pos_transactions"), *names)
    clean.to_silver(lake, "pos_transactions", "r", few_copies=True)
    assert rows(lake.read("silver", "pos_transactions"), *names) == want and len(want) == 41


def sales(spark, lake, run, data):
    clean.write_silver(lake, spark.createDataFrame(data, POS), "pos_transactions", run)


def test_first_sums_of_sales_keep_no_copies(spark, lake, monkeypatch):
    labels = []
    monkeypatch.setattr(gold_deltas, "materialise", lambda df, label: labels.append(label) or df)
    monkeypatch.setattr(gold_deltas, "stored", lambda df, label: labels.append(label) or df)
    sales(spark, lake, "a", [(i, i % 3, i % 7, 2, DAY, 1.5) for i in range(60)] + [(99, None, 1, 1, None, None)])
    state = GoldState(lake).refresh(["a"])
    assert labels == ["gold-delta"]  # a row per day; before: all changes and all units too
    units = GoldState(lake).read("units", state)
    assert units.count() == 21 and units.agg(F.sum("total_qty_sold")).first()[0] == 120
    assert units.where("k <> concat(store_id, '|', product_id) or k is null").count() == 0
    log = spark.read.parquet(f"{lake.root}/gold_state/log/pos_transactions")
    assert log.where("run_id = 'a' and (k = transaction_id)").count() == 61


def test_copies_within_a_run_count_once(spark, lake):
    sales(spark, lake, "a", [(1, 1, 1, 2, DAY, 1.0), (1, 1, 1, 5, DAY, 1.0), (None, 1, 1, 7, DAY, 1.0), (None, 1, 1, 8, DAY, 1.0), (2, 1, 1, 3, DAY, 1.0)])
    state = GoldState(lake).refresh(["a"])
    assert [r["total_qty_sold"] for r in GoldState(lake).read("units", state).collect()] == [5 + 8 + 3]


def test_key_is_made_behind_the_shuffle(spark, lake):
    from pyspark.sql.types import StructType

    table = BucketTable(lake, "t", "k", "n", StructType.fromDDL("k string, a bigint, n bigint"), bucket_rows=5)
    data = spark.range(40).select(F.col("id").cast("string").alias("k"), F.col("id").alias("a"), F.lit(1).cast("bigint").alias("n"))
    done = table.replace(data, table.manifest(), [], 4, {"k": F.col("a").cast("string")})
    assert rows(table.read(done)) == rows(data) and done.rows == 40
    some = table.touched(data.where("a = 7"), done)
    assert rows(table.read(done, some).where("a = 7")) == [("7", 7, 1)]


def test_first_load_of_a_fact_notes_no_keys(spark, lake):
    batch = spark.range(9).select(F.col("id").alias("transaction_id"), F.lit(DAY).alias("timestamp"))
    fresh, existing = warehouse._not_loaded(lake, batch, "fact_sales", "transaction_id", "timestamp", 2**40)
    assert existing is None and fresh is batch
    assert not LoadedKeys(lake, "fact_sales", "transaction_id").exists()


def test_uploads_are_profiled_and_scored_as_stored(spark, lake, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "products.csv").write_text("product_id,product_name,category,unit_price\n1,a,x,2.5\n2,b,x,\n2,b,x,\n")
    read = []
    monkeypatch.setattr(onboarding, "profile", lambda df: read.append(df.inputFiles()) or profile.profile(df))
    spark.sql("create database if not exists growth_up")
    got = onboarding.onboard(spark, lake, f"file:{folder}", "r", LOAD_TS, type_override={"products.csv": "Unknown"}, database="growth_up")
    assert [r["rows_count"] for r in got.collect()] == [3]
    assert read and all(p.endswith(".parquet") for files in read for p in files)  # before: the text, parsed once more for each pass
    spark.sql("drop database growth_up cascade")
