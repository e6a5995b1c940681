"""Dimensions in hash buckets: what a merge writes, reads and survives."""

import pytest
from pyspark.sql import functions as F

from bazaarline import schemas
from bazaarline.plans.warehouse import merge_customers, merge_dimension
from bazaarline.session import materialise
from bazaarline.sources.buckets import BucketTable
from conftest import rows

CUST = "customer_id bigint, customer_name string, segment string, acquisition_channel string, signup_date date"


def batch(spark, ids, segment="Retail"):
    return spark.createDataFrame([(i, f"N{i}", segment, "Web", None) for i in ids], CUST)


def table(lake, **options):
    return BucketTable(lake, "dim_customer", "customer_id", "customer_sk", schemas.layout("dim_customer"), **options)


def versions(df):
    return rows(df.drop("customer_sk"))


def test_merges_equal_those_of_the_whole_dimension(spark, lake):
    layout = schemas.layout("dim_customer")
    plain = spark.createDataFrame([], layout)
    loads = [(range(200), "Retail"), (range(50, 60), "SMB"), ([], "none"), (range(195, 230), "SMB"), (range(50, 60), "SMB"), ([7, None], "Retail")]
    for day, (ids, segment) in enumerate(loads, 1):
        stg = batch(spark, ids, segment)
        at = f"2024-01-0{day}"
        plain = materialise(merge_customers(plain, stg, at), "plain")
        merge_dimension(lake, "dim_customer", stg, at, bucket_rows=20)
        assert versions(lake.snapshot("dim_customer", layout)) == versions(plain)
        sks = [r[0] for r in lake.snapshot("dim_customer", layout).select("customer_sk").collect()]
        assert sorted(sks) == list(range(1, len(sks) + 1))


def test_only_touched_buckets_are_written(spark, lake):
    first = merge_dimension(lake, "dim_customer", batch(spark, range(2000)), "2024-01-01", bucket_rows=20)
    assert first.buckets > 90
    # a full delivery with one per cent of the customers changed
    stg = batch(spark, range(2000)).withColumn("segment", F.when(F.col("customer_id") % 100 == 3, "SMB").otherwise(F.col("segment")))
    second = merge_dimension(lake, "dim_customer", stg, "2024-02-01", bucket_rows=20)
    rewritten = {b for b, e in second.entries.items() if e[0] != first.entries.get(b, (None,))[0]}
    assert 0 < len(rewritten) <= 20 and second.rows == first.rows + 20
    # the same once more: nothing to write, not even a list
    assert merge_dimension(lake, "dim_customer", stg, "2024-03-01", bucket_rows=20).version == second.version
    assert table(lake).vacuum() == 0 and lake.snapshot("dim_customer", schemas.layout("dim_customer")).count() == second.rows


@pytest.mark.parametrize("step", ["files", "list", "marker"])
def test_a_crash_leaves_the_last_state(spark, lake, monkeypatch, step):
    merge_dimension(lake, "dim_customer", batch(spark, range(100)), "2024-01-01", bucket_rows=20)
    before = versions(lake.snapshot("dim_customer", schemas.layout("dim_customer")))
    with monkeypatch.context() as patch:
        def crash(*_, **__):
            raise RuntimeError("lost")
        if step == "files":   # some files of the new generation are there
            (path := lake._fs(f"{lake.path('warehouse', 'dim_customer')}/data/g=2/b=0"))[0].mkdirs(path[1])
            patch.setattr(BucketTable, "replace", crash)
        elif step == "list":
            patch.setattr(BucketTable, "_publish", crash)
        else:
            patch.setattr(lake, "MARKER", "nowhere/never")
            patch.setattr(lake, "_fs", lambda p, fs=lake._fs: crash() if p.endswith("never") and "m=2" in p else fs(p.replace("nowhere/never", "_PUBLISHED")))
        with pytest.raises(RuntimeError, match="lost"):
            merge_dimension(lake, "dim_customer", batch(spark, range(50), "SMB"), "2024-02-01", bucket_rows=20)
    layout = schemas.layout("dim_customer")
    assert versions(lake.snapshot("dim_customer", layout)) == before
    merge_dimension(lake, "dim_customer", batch(spark, range(50), "SMB"), "2024-02-01", bucket_rows=20)
    assert lake.snapshot("dim_customer", layout).where("is_current and segment = 'SMB'").count() == 50
    assert table(lake).vacuum() >= 0
    assert lake.snapshot("dim_customer", layout).where("is_current and segment = 'SMB'").count() == 50


def test_buckets_double_as_the_table_grows(spark, lake):
    merge_dimension(lake, "dim_customer", batch(spark, range(30)), "2024-01-01", bucket_rows=20)
    grown = merge_dimension(lake, "dim_customer", batch(spark, range(30, 200)), "2024-02-01", bucket_rows=20)
    assert grown.buckets == 4 and grown.rows == 201 == lake.snapshot("dim_customer", schemas.layout("dim_customer")).count()


def test_a_dimension_of_snapshots_goes_over(spark, lake):
    layout = schemas.layout("dim_customer")
    lake.publish(merge_customers(spark.createDataFrame([], layout), batch(spark, range(10)), "2024-01-01"), "dim_customer")
    merge_dimension(lake, "dim_customer", batch(spark, range(5), "SMB"), "2024-02-01")
    assert lake.snapshot("dim_customer", layout).count() == 16 and table(lake).exists()
