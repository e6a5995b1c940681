import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from bazaarline.operators import clean
from bazaarline.plans.gold_deltas import GoldState, refresh_gold
from bazaarline.plans.warehouse import build_gold
from bazaarline.session import shared_dir
from bazaarline.sources.lake import Lake
from bazaarline import schemas
from conftest import rows

NAMES = ("customer_metrics", "sales_metrics", "inventory_metrics")


def silver(spark, lake, source, run, values):
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.layout(source))
    values = [[float(v) if isinstance(v, Decimal) else v for v in row] for row in values]
    clean.write_silver(lake, spark.createDataFrame(values, fields), source, run)


def gold_rows(lake):
    return {name: rows(lake.read("gold", name)) for name in NAMES if lake.exists("gold", name)}


def same_as_rebuilt(spark, lake, runs, state=None):
    refresh_gold(lake, runs, state)
    got = gold_rows(lake)
    build_gold(lake)
    want = gold_rows(lake)
    assert set(got) == set(want)
    for name in want:
        assert got[name] == want[name], name
    return got


def instant(rng, days=6):
    return None if rng.random() < 0.05 else datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(days * 1440))


def delivery(spark, lake, rng, run):
    some = lambda top: None if rng.random() < 0.08 else rng.randrange(top)
    money = lambda: None if rng.random() < 0.08 else Decimal(rng.randrange(10_000)) / 100
    silver(spark, lake, "erp_orders", run, [[i, some(6), 1, some(9), instant(rng), "N", money()] for i in {some(30) for _ in range(12)}])
    silver(spark, lake, "pos_transactions", run, [[i, some(3), some(3), some(9), instant(rng), money()] for i in {some(30) for _ in range(12)}])
    silver(spark, lake, "crm_customers", run, [[i, f"n{rng.randrange(9)}", "S", None, instant(rng)] for i in {some(8) for _ in range(3)}])
    silver(spark, lake, "inventory", run, [[*k, some(9), some(9), instant(rng)] for k in {(some(3), some(3)) for _ in range(4)}])


def test_deliveries_that_replace_rows_and_runs(spark, lake):
    """Nulls, equal keys, replaced rows, a run delivered again with other rows; buckets and logs that are split and merged."""
    rng, state = random.Random(5), GoldState(lake, block=4, log_rows=10, generations=2)
    for run in ("a", "b", "c"):
        delivery(spark, lake, rng, run)
        same_as_rebuilt(spark, lake, [run], state)
    delivery(spark, lake, rng, "a")  # the first run once more: its old rows go, its new ones are the latest
    got = same_as_rebuilt(spark, lake, ["a"], state)
    assert all(got.values())
    assert same_as_rebuilt(spark, lake, ["a"], state) == got  # repeated as it is: nothing counts twice
    assert state.vacuum() > 0
    assert same_as_rebuilt(spark, lake, [], state) == got


def sale(i, at, amount=1.0):
    return [i, 1, 1, 2, at, amount]


def test_first_and_last_instant_can_be_taken_back(spark, lake):
    day = datetime(2024, 1, 1)
    silver(spark, lake, "inventory", "a", [[1, 1, 10, 5, day]])
    silver(spark, lake, "pos_transactions", "a", [sale(1, day), sale(2, day + timedelta(hours=20)), sale(3, day + timedelta(days=4, hours=1)),
                                                  sale(4, day + timedelta(days=8))])
    assert same_as_rebuilt(spark, lake, ["a"])["inventory_metrics"][0][5] == 1.0  # 8 units in 8 days
    silver(spark, lake, "pos_transactions", "b", [sale(1, day + timedelta(days=2))])  # 20:00 of the first day is the first now
    same_as_rebuilt(spark, lake, ["b"])
    silver(spark, lake, "pos_transactions", "c", [sale(4, day + timedelta(days=3)), sale(2, None)])  # whole days vanish
    got = same_as_rebuilt(spark, lake, ["c"])
    assert len(got["sales_metrics"]) == 3 and got["inventory_metrics"][0][5] == 4.0
    silver(spark, lake, "pos_transactions", "a", [])
    same_as_rebuilt(spark, lake, ["a"])


def test_runs_not_named_are_found_and_failed_updates_are_not_seen(spark, lake, monkeypatch):
    day = datetime(2024, 1, 1)
    silver(spark, lake, "inventory", "a", [[1, 1, 10, 5, day]])
    silver(spark, lake, "pos_transactions", "007", [sale(1, day), sale(2, day)])
    same_as_rebuilt(spark, lake, ["a"])
    silver(spark, lake, "pos_transactions", "7", [sale(2, day, 5.0), sale(3, day + timedelta(days=2))])
    with monkeypatch.context() as patch:
        patch.setattr(GoldState, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_gold(lake, ["7"])
    assert set(GoldState(lake).load().logs["pos_transactions"]) == {"007"}
    got = same_as_rebuilt(spark, lake, [])
    assert [r[1] for r in got["sales_metrics"]] == [6, 1]


def test_a_run_reads_the_buckets_of_its_keys_only(spark, lake):
    state = GoldState(lake, block=10, log_rows=20)
    day = datetime(2024, 1, 1)
    silver(spark, lake, "pos_transactions", "a", [sale(i, day + timedelta(hours=i)) for i in range(400)])
    refresh_gold(lake, ["a"], state)
    silver(spark, lake, "pos_transactions", "b", [sale(i, day + timedelta(hours=i), 3.0) for i in range(395, 410)])
    loaded = state.load()
    asked = []
    real = state.log
    state.log = lambda source, runs, only=None: asked.append(only) or real(source, runs, only)
    refresh_gold(lake, ["b"], state)
    logs = state.load().logs["pos_transactions"]
    read = [set(only) for only in asked if only is not None]
    assert len(loaded.logs["pos_transactions"]["a"].buckets) > 10 and read == [set(logs["b"].buckets)] and len(read[0]) <= 3


def test_empty_lake(spark, tmp_path):
    empty = Lake(spark, f"file:{tmp_path / 'none'}")
    assert refresh_gold(empty, ["r"]) == {} and GoldState(empty).load().version == 0


def test_a_replaced_row_is_shuffled_once_and_no_copy_stays(spark, lake):
    """Old and new rows of a key meet in one shuffle without the text key; what an update writes for itself goes with it."""
    state, day = GoldState(lake), datetime(2024, 1, 1)
    work = os.path.join(shared_dir(spark).removeprefix("file:"), "bazaarline")
    copies = lambda: {f for f in os.listdir(work) if f.startswith("gold-")} if os.path.isdir(work) else set()
    before = copies()
    for run, amount in (("a", 1.0), ("b", 2.0)):
        silver(spark, lake, "pos_transactions", run, [sale(i, day + timedelta(hours=i), amount) for i in range(9)] + [sale(None, day, amount)])
        silver(spark, lake, "inventory", run, [[1, 1, 10, 5, day], [None, 2, 3, 4, day], [None, None, 3, 4, None]])
        same_as_rebuilt(spark, lake, [run], state)
    assert copies() == before
    logs = state.load().logs["pos_transactions"]
    old, new = (state.log("pos_transactions", {run: logs[run]}) for run in ("a", "b"))
    rows_ = state._replaced("pos_transactions", old, new, [])
    plan = rows_._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "concat_ws" not in plan.split("Exchange hashpartitioning")[1]
    assert sorted((r.sign, r.sale_amount) for r in rows_.collect()) == [(-1, Decimal(1))] * 10 + [(1, Decimal(2))] * 10
